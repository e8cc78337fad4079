"""Operators with state of their own in Spark's state store.

Windows that a timer closes, with late rows as a side output; the first row of every key; row-count windows by key. State lies
in RocksDB, so start their queries inside of ``session.rocksdb_state`` or after ``session.tune``. It goes with the query's
checkpoint: a restarted query goes on where it stopped, and a replayed batch starts from the state that it had started from.
Rows travel as JSON text, so any columns that JSON can hold will do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ON_TIME, LATE = "on time", "late"
# Text that loses nothing of a time.
_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# How far behind the watermark a late row may be and still come out as late.
_AGES = 36_500 * 86_400


def _text(columns: Sequence[str]):
    return F.to_json(F.struct(*columns), _FORMATS)


class _ClosingWindows(StatefulProcessor):
    """Counts the rows of one lane by window and key until the watermark passes the window's end."""

    def __init__(self, size_ms: int):
        self.size = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "stop long, name string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed, found = timerValues.getCurrentWatermarkInMs(), {}
        for frame in rows:
            stop = frame["at_ms"] // self.size * self.size + self.size
            late = stop <= closed
            if late.any():
                yield pd.DataFrame({"route": LATE, "name": frame["name"], "stop": stop, "n": 1, "row": frame["row"]})[late]
            for place, n in frame[~late].groupby([stop[~late], frame["name"][~late]]).size().items():
                found[place] = found.get(place, 0) + n
        for (stop, name), n in found.items():
            place = (int(stop), name)
            before = self.counts.getValue(place)
            self.counts.updateValue(place, (int(n) + (before[0] if before else 0),))
        if found:
            self.handle.registerTimer(int(min(stop for stop, _ in found)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A timer closes all windows that are over, and sets the next one for the first window that is not."""
        closed, done, open_ = timerValues.getCurrentWatermarkInMs(), [], []
        for (stop, name), (n,) in self.counts.iterator():
            if stop <= closed:
                done.append((stop, name, n))
            else:
                open_.append(stop)
        if open_:
            self.handle.registerTimer(min(open_))
        for stop, name, _ in done:
            self.counts.removeKey((stop, name))
        if done:
            yield pd.DataFrame([(ON_TIME, name, stop, n, None) for stop, name, n in done], columns=["route", "name", "stop", "n", "row"])

    def close(self) -> None:
        pass


def _clock(ms: Column, delay_ms: int) -> tuple[Column, str]:
    """A clock for the engine's watermark, and its delay.

    The engine drops rows that are older than its watermark, so it is shown a clock that runs ages ahead, with a delay as much
    longer: that watermark is the real one, and no row is older.
    """
    return F.timestamp_millis(ms + _AGES * 1000), f"{_AGES * 1000 + delay_ms} milliseconds"


def windows_and_late_rows(
    stream: DataFrame, ts: str, keys: Sequence[str], *, size_ms: int, delay_ms: int, lanes: int = 64
) -> DataFrame:
    """Rows counted per key in event-time windows, and the rows that came after their window had closed.

    A window closes once the greatest time of the batches before, less the delay, has reached its end. The result is for
    :func:`split_routes` inside of foreachBatch. Rows are dealt to ``lanes`` by a hash of all their columns, so a key with most of
    the rows does not come to one task, and is counted there before it is stored. Rows without a time are left out.
    """
    ms, row = F.unix_millis(F.col(ts).cast("timestamp")), _text(stream.columns)
    clock, delay = _clock(ms, delay_ms)
    laned = stream.filter(ms.isNotNull()).select(
        clock.alias("clock"), ms.alias("at_ms"), F.to_json(F.struct(*keys), _FORMATS).alias("name"), row.alias("row"),
        F.pmod(F.xxhash64(row), F.lit(lanes)).alias("lane"),
    ).withWatermark("clock", delay)
    return laned.groupBy("lane").transformWithStateInPandas(
        _ClosingWindows(size_ms), "route string, name string, stop bigint, n bigint, row string", "Append", "EventTime"
    )


def split_routes(batch: DataFrame, schema: T.StructType, keys: Sequence[str], size_ms: int) -> tuple[DataFrame, DataFrame]:
    """The two routes of a batch: keys, ``window_start``, ``window_end`` and ``n`` of closed windows; and late rows with their
    window, as they came. ``schema`` is that of the stream before. Store the batch first: each route reads it once more."""
    bounds = [F.timestamp_millis(F.col("stop") - size_ms).alias("window_start"), F.timestamp_millis("stop").alias("window_end")]
    named = F.from_json("name", T.StructType([schema[k] for k in keys]), _FORMATS)
    # All lanes close a window in the same batch.
    counts = batch.filter(F.col("route") == ON_TIME).groupBy("name", "stop").agg(F.sum("n").alias("n"))
    counts = counts.select(named.alias("_key"), *bounds, "n").select("_key.*", "window_start", "window_end", "n")
    late = batch.filter(F.col("route") == LATE).select(F.from_json("row", schema, _FORMATS).alias("_row"), *bounds)
    return counts, late.select("_row.*", "window_start", "window_end")


@dataclass(frozen=True)
class Expiry:
    """State of a key is given up ``after_ms`` of event time behind its latest row, once the watermark has got there."""

    ts: str
    after_ms: int
    delay_ms: int


def _laid(stream: DataFrame, keys: Sequence[str], order: Sequence[str], expiry: Expiry | None) -> tuple[GroupedData, list[str]]:
    """The rows by key, each as text and with its order columns under plain names, as they arrive in Python as fields of tuples."""
    key_names, order_names = [f"key_{n}" for n in range(len(keys))], [f"order_{n}" for n in range(len(order))]
    named = [F.col(c).alias(n) for c, n in zip([*keys, *order], [*key_names, *order_names])]
    if expiry is None:
        return stream.select(*named, _text(stream.columns).alias("row")).groupBy(*key_names), order_names
    ms = F.unix_millis(F.col(expiry.ts).cast("timestamp"))
    clock, delay = _clock(ms, expiry.delay_ms)
    laid = stream.select(*named, _text(stream.columns).alias("row"), clock.alias("clock"), ms.alias("at_ms"))
    return laid.withWatermark("clock", delay).groupBy(*key_names), order_names


class _Expiring(StatefulProcessor):
    """Clears a key's state when its last timer is over."""

    def __init__(self, expiry: Expiry | None):
        self.expiry = expiry

    def live_on(self, frames: list[pd.DataFrame]) -> None:
        if self.expiry is not None:
            latest = max((f["at_ms"].max() for f in frames if f["at_ms"].notna().any()), default=None)
            if latest is not None:
                self.handle.registerTimer(int(latest) + self.expiry.after_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not any(at > expiredTimerInfo.getExpiryTimeInMs() for at in self.handle.listTimers()):
            self.forget()
        return iter(())

    def close(self) -> None:
        pass


class _First(_Expiring):
    def __init__(self, order: Sequence[str], expiry: Expiry | None):
        super().__init__(expiry)
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "yes boolean")

    def forget(self) -> None:
        self.seen.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, best = self.seen.exists(), None
        for frame in rows:
            self.live_on([frame])
            if not known:
                best = frame if best is None else pd.concat([best, frame])
                best = best.sort_values(self.order, kind="stable").head(1)
        if best is not None:
            self.seen.update((True,))
            yield best[["row"]]


def first_per_key(stream: DataFrame, keys: Sequence[str], order: Sequence[str], *, expiry: Expiry | None = None) -> DataFrame:
    """The first row of every key over all batches: of the batch that meets the key first, the least by ``order``.

    With ``expiry`` a key that has given no row for so long is forgotten, so state does not grow with all keys there ever were; its
    next row is a first one again. Only a flag is kept for a key; of its rows in a batch few are held at a time.
    """
    grouped, order_names = _laid(stream, keys, order, expiry)
    found = grouped.transformWithStateInPandas(_First(order_names, expiry), "row string", "Append", "EventTime" if expiry else "None")
    return found.select(F.from_json("row", stream.schema, _FORMATS).alias("_row")).select("_row.*")


class _CountWindows(_Expiring):
    def __init__(self, n: int, order: Sequence[str], expiry: Expiry | None):
        super().__init__(expiry)
        self.n, self.order = n, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rest, self.windows = handle.getListState("rest", "row string"), handle.getValueState("windows", "n long")

    def forget(self) -> None:
        self.rest.clear()
        self.windows.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        self.live_on(frames)
        fresh = pd.concat(frames).sort_values(self.order, kind="stable")["row"].tolist()
        held = [row[0] for row in self.rest.get()] + fresh
        number = self.windows.get()[0] if self.windows.exists() else 0
        full = len(held) // self.n
        if full:
            places = range(full * self.n)
            yield pd.DataFrame({
                "row": held[: full * self.n], "window_no": [number + k // self.n for k in places], "window_pos": [k % self.n for k in places],
            })
            self.windows.update((number + full,))
        if full * self.n < len(held):
            self.rest.put([(row,) for row in held[full * self.n:]])
        else:
            self.rest.clear()


def count_windows_by_key(
    stream: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], *, expiry: Expiry | None = None
) -> DataFrame:
    """Full windows of ``n`` rows of a key over all batches, with ``window_no`` (per key) and ``window_pos``, both from 0.

    A batch's rows of a key come in the order of ``order``, behind what the batches before left over, which is fewer than
    ``n`` rows. One task holds the rows that one batch has of a key; for keys that may have very many of them, or for windows
    without a key, there is :class:`~millrace.streaming.counts.CountWindowStream`. With ``expiry`` the rows of a key that wait for
    more of it are given up after so long, and its numbers begin anew.
    """
    grouped, order_names = _laid(stream, keys, order, expiry)
    found = grouped.transformWithStateInPandas(
        _CountWindows(n, order_names, expiry), "row string, window_no bigint, window_pos int", "Append", "EventTime" if expiry else "None"
    )
    return found.select(F.from_json("row", stream.schema, _FORMATS).alias("_row"), "window_no", "window_pos").select("_row.*", "window_no", "window_pos")
