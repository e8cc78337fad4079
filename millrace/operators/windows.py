"""Event-time windows, row-count windows and late rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..constants import DATE_FORMAT, DATETIME_FORMAT
from ..functions.dates import millis_timestamp
from ..session import materialize
from .joins import sized_join


def tumbling_count(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] | Mapping[str, str],
    *,
    size: str = "5 seconds",
    delay: str = "3 seconds",
    counts: Sequence[str] = ("n",),
) -> DataFrame:
    """Count rows per key in epoch-aligned event-time windows.

    ``keys`` may map output names to input columns. Every name in ``counts`` holds the same count. ``data_dt`` is the
    date of the window start. On a stream a window is emitted once, when the greatest event time less ``delay`` has
    passed its end, and later rows of it are dropped; on a batch ``delay`` has no effect. Rows are counted before the
    shuffle, so a popular key costs one row per task and window.
    """
    named = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    grouped = df.withWatermark(ts, delay).groupBy(
        F.window(ts, size).alias("_window"), *[F.col(source).alias(name) for name, source in named.items()]
    )
    counted = grouped.agg(F.count(F.lit(1)).alias("_n"))
    return counted.select(
        *named,
        *[F.col("_n").alias(c) for c in counts],
        F.date_format("_window.start", DATE_FORMAT).alias("data_dt"),
        F.date_format("_window.start", DATETIME_FORMAT).alias("window_start"),
        F.date_format("_window.end", DATETIME_FORMAT).alias("window_end"),
    )


def event_time(millis: str = "time") -> Column:
    """Null for a value beyond Spark's clock; a window never takes such a row."""
    return millis_timestamp(F.col(millis))


def _in_order(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``df`` as a stored table with ``_pos``: the partition in the upper bits, the row in it in the lower 33.

    Partitions are ranges of ``order``, so ``_pos`` sorts like ``order`` over the whole table although no task saw
    more than one range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn("_pos", F.monotonically_increasing_id()), label)


def _part(pos: str = "_pos") -> Column:
    return F.shiftright(F.col(pos), 33)


def arrival_positions(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Add ``_seq``, the 0-based rank by ``order`` within each key, and ``_total``, the rows of that key.

    ``order`` has to identify a row, as a record's partition and offset do. Works in two passes over range partitions:
    one counts rows per key and partition, the other adds the counts of the partitions before. A key or the whole
    table is never ranked in one task.
    """
    keys = list(keys)
    stored = _in_order(df, [*keys, *order], "positions")
    marked = stored.withColumns({"_part": _part(), "_key": F.struct(F.lit(0).alias("_all"), *keys)})
    segments = marked.groupBy("_key", "_part").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per key and partition is left, so these windows are short: at most as many rows as there are partitions.
    of_key = Window.partitionBy("_key")
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select(
        "_key", "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(of_key).alias("_total"),
    )
    # Without keys that is one row per partition of the stored table. A left key has at most one partition's rows.
    placed = sized_join(marked, starts, ["_key", "_part"], "inner", small=None if keys else True, skewed=False)
    return placed.select(*df.columns, (F.col("_pos") + F.col("_shift")).alias("_seq"), "_total")


def full_and_rest(placed: DataFrame, n: int, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split ranked rows into those of full windows and those after the last full window."""
    number = F.expr(f"_seq div {int(n)}")
    is_full = (number + 1) * n <= F.col("_total")
    full = placed.filter(is_full).select(
        *columns, number.alias("window_no"), F.pmod("_seq", F.lit(n)).cast("int").alias("window_pos")
    )
    return full, placed.filter(~is_full).select(*columns)


def count_window(df: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows of full windows of ``n`` consecutive rows, with ``window_no`` and ``window_pos`` (both from 0).

    Without ``keys`` the windows run over the whole input. The rows after the last full window are left out.
    """
    return full_and_rest(arrival_positions(df, order, keys), n, df.columns)[0]


def count_window_rest(df: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The rows after the last full window: fewer than ``n`` per key."""
    return full_and_rest(arrival_positions(df, order, keys), n, df.columns)[1]


def apply_windows(
    windows: DataFrame, fn: Callable, schema, keys: Sequence[str] = (), *, per_group: int = 10_000
) -> DataFrame:
    """Run ``fn(pandas frame) -> pandas frame`` on whole windows of :func:`count_window`.

    A frame holds many windows, told apart by ``window_no`` and the keys, each in window order; it holds about an Arrow batch
    of rows, so there is no call per window. ``per_group`` consecutive windows of a key stay in one task.
    """
    names = [*keys, "window_no"]

    def run(frames):
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            # The last window may go on in the next batch.
            last = (frame[names].fillna("") == frame[names].iloc[-1].fillna("")).all(axis=1).to_numpy()
            cut = len(frame) - int(last[::-1].argmin() if not last.all() else len(frame))
            held = frame.iloc[cut:]
            if cut:
                yield fn(frame.iloc[:cut].reset_index(drop=True))
        if held is not None and len(held):
            yield fn(held.reset_index(drop=True))

    group = F.expr(f"window_no div {int(per_group)}")
    dealt = windows.repartition(*keys, group).sortWithinPartitions(*names, "window_pos")
    return dealt.mapInPandas(run, schema)


def mark_late(df: DataFrame, ts: str, order: Sequence[str], size_ms: int, delay_ms: int) -> DataFrame:
    """Add ``late``: true where the row's window had closed before the row arrived.

    Rows arrive by ``order``, which has to identify a row. A window is closed once the greatest event time of the rows
    before, less the delay, reaches its last millisecond. The greatest time so far is found like the ranks above: per
    range partition first, then carried over from the partitions before.
    """
    millis = F.unix_millis(F.col(ts))
    stored = _in_order(df.withColumn("_ms", millis), order, "arrivals").withColumn("_part", _part())
    peaks = stored.groupBy("_part").agg(F.max("_ms").alias("_peak"))
    # One row per partition of the stored table, here and in the broadcast below.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = peaks.select("_part", F.max("_peak").over(earlier).alias("_carried"))
    within = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.greatest(F.max("_ms").over(within), F.col("_carried"))
    last_ms = F.col("_ms") - F.pmod("_ms", F.lit(size_ms)) + size_ms - 1
    late = F.coalesce(last_ms <= seen - delay_ms, F.lit(False))
    return sized_join(stored, carried, ["_part"], "inner", small=True).select(*df.columns, late.alias("late"))


def mark_late_by_source(
    df: DataFrame, ts: str, order: Sequence[str], source: str, size_ms: int, delay_ms: int, idle_rows: int | None = None
) -> DataFrame:
    """Add ``late`` as :func:`mark_late`, by a watermark that is the least of the source partitions' own greatest times.

    ``source`` names the partition a row came from. One that has not given a row yet holds the watermark back, as does a slow
    one; with ``idle_rows`` one that gave none of the last so many rows does not. The watermark never goes back.

    The greatest times per source partition are found like the ranks above: per range partition first, then carried over from
    the partitions before, one row per source and range partition. A task holds one number per source partition.
    """
    columns = df.columns
    stored = _in_order(df.withColumn("_ms", F.unix_millis(ts)), order, "arrivals").withColumns({"_part": _part(), "_source": F.col(source)})
    own = stored.groupBy("_part", "_source").agg(F.max("_ms").alias("_ms"), F.max("_pos").alias("_last"), F.count(F.lit(1)).alias("_n"))
    own = materialize(own, "sources")
    counts = dict(own.groupBy("_part").agg(F.sum("_n")).collect())  # one number per range partition
    if not counts:
        return df.withColumn("late", F.lit(False))
    parts = sorted(counts)
    shift = dict(zip(parts, np.cumsum([0, *(counts[p] for p in parts)]).tolist()))
    grid = own.select("_source").distinct().withColumn("_part", F.explode(F.lit(parts)))
    same = F.col("g._source").eqNullSafe(F.col("o._source")) & (F.col("g._part") == F.col("o._part"))
    every = grid.alias("g").join(own.alias("o"), same, "left").select("g._source", "g._part", "_ms", "_last")
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("_source", "_part", F.max("_ms").over(before).alias("_ms"), F.max("_last").over(before).alias("_last"), F.lit(True).alias("_carried"))
    rows = stored.select(*columns, "_source", "_part", "_pos", "_ms").unionByName(carried.withColumn("_pos", F.lit(-1).cast("bigint")), allowMissingColumns=True)

    def run(batches):
        watch = _Watch(shift, idle_rows, CELLS)
        for batch in batches:
            mark = watch.before(batch)
            wanted = pc.invert(pc.fill_null(batch.column("_carried"), False))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(np.maximum(mark, _NEVER), pa.int64())], names=[*names, "_seen"]
            ).filter(wanted)

    names = [*columns, "_part", "_pos", "_ms"]
    dealt = rows.repartition("_part").sortWithinPartitions("_part", "_pos")
    seen = dealt.mapInArrow(run, T.StructType([*(rows.schema[n] for n in names), T.StructField("_seen", T.LongType())]))
    if idle_rows is not None:
        # A source that comes back may be behind; then the watermark stays where it was.
        seen = materialize(seen, "watermarks")
        peaks = seen.groupBy("_part").agg(F.max("_seen").alias("_peak"))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        highest = peaks.select("_part", F.max("_peak").over(earlier).alias("_highest"))  # one row per range partition
        within = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        seen = sized_join(seen, highest, ["_part"], "inner", small=True).withColumn(
            "_seen", F.greatest(F.max("_seen").over(within), F.col("_highest")))
    last_ms = F.col("_ms") - F.pmod("_ms", F.lit(size_ms)) + size_ms - 1
    late = F.coalesce((F.col("_seen") > _NEVER) & (last_ms <= F.col("_seen") - delay_ms), F.lit(False))
    return seen.select(*columns, late.alias("late"))


_NEVER = -(1 << 62)  # the time of a source that has given no row
CELLS = 2_000_000  # rows by sources that are looked at in one piece


class _Watch:
    """Follows the greatest time of every source through the rows of a task, range partition after range partition."""

    def __init__(self, shift: dict[int, int], idle_rows: int | None, cells: int):
        self.shift, self.idle, self.cells, self.part = shift, idle_rows, cells, None
        self.names, self.peak, self.last = pa.nulls(0), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def before(self, batch: pa.RecordBatch) -> np.ndarray:
        """The watermark (without its delay) that each row met."""
        part, pos = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("_part", "_pos"))
        ms = pc.fill_null(batch.column("_ms"), _NEVER).to_numpy(zero_copy_only=False)
        last = pc.fill_null(batch.column("_last"), -1).to_numpy(zero_copy_only=False)
        result = np.full(len(part), _NEVER)
        cuts = np.flatnonzero((np.diff(part) != 0) | ((pos[1:] < 0) != (pos[:-1] < 0))) + 1
        for a, b in zip([0, *cuts], [*cuts, len(part)]):
            if a == b:
                continue
            names = batch.column("_source").slice(a, b - a)
            if pos[a] < 0:  # carried over from the range partitions before
                fresh = part[a] != self.part
                self.part = part[a]
                self.names = names if fresh else pa.concat_arrays([self.names, names])
                lasts = np.where(last[a:b] < 0, -1, [self.shift[int(v) >> 33] + (int(v) & ((1 << 33) - 1)) if v >= 0 else -1 for v in last[a:b]])
                self.peak = ms[a:b].copy() if fresh else np.append(self.peak, ms[a:b])
                self.last = lasts if fresh else np.append(self.last, lasts)
                continue
            code = pc.index_in(names, value_set=self.names).to_numpy(zero_copy_only=False).astype(np.int64)
            seq = self.shift[int(part[a])] + (pos[a:b] & ((1 << 33) - 1))
            step = max(1, self.cells // max(1, len(self.peak)))
            for c in range(0, b - a, step):
                result[a + c: min(a + c + step, b)] = self._follow(code[c: c + step], ms[a + c: min(a + c + step, b)], seq[c: c + step])
        return result

    def _follow(self, code: np.ndarray, ms: np.ndarray, seq: np.ndarray) -> np.ndarray:
        rows = np.arange(1, len(code) + 1)
        peaks = np.full((len(code) + 1, len(self.peak)), _NEVER)
        peaks[0] = self.peak
        peaks[rows, code] = ms
        np.maximum.accumulate(peaks, axis=0, out=peaks)
        self.peak, found = peaks[-1].copy(), peaks[:-1]
        if self.idle is not None:
            last = np.full(peaks.shape, -1)
            last[0] = self.last
            last[rows, code] = seq
            np.maximum.accumulate(last, axis=0, out=last)
            self.last = last[-1].copy()
            idle = seq[:, None] - last[:-1] > self.idle
            found = np.where(idle, -_NEVER, found)
            return np.where(idle.all(axis=1), _NEVER, found.min(axis=1))
        return found.min(axis=1)


def late_rows(df: DataFrame, ts: str, order: Sequence[str], size_ms: int, delay_ms: int) -> DataFrame:
    return mark_late(df, ts, order, size_ms, delay_ms).filter("late").drop("late")


def on_time_rows(df: DataFrame, ts: str, order: Sequence[str], size_ms: int, delay_ms: int) -> DataFrame:
    return mark_late(df, ts, order, size_ms, delay_ms).filter(~F.col("late")).drop("late")
