"""The nine jobs of the warehouse, each one streaming query.

A job reads one topic and writes topics, dimension snapshots or a mart. Its checkpoint folder makes it restartable.
Without ``every`` a job works through what is there and stops; with it (for example "10 seconds") it goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..operators import cdc, geo, lookup, marts, parse, routing
from ..operators.windows import event_time
from ..session import materialize, rocksdb_state, scratch
from ..sources.config import ConfigHistory, ConfigLoader
from ..sources.offsets import GroupOffsets
from ..streaming import keyed
from ..streaming.dimensions import DimensionStore
from ..streaming.rollups import SummedMart


def _start(writer, every: str | None) -> StreamingQuery:
    return writer.trigger(processingTime=every).start() if every else writer.trigger(availableNow=True).start()


def _each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, every: str | None):
    def scoped(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):  # what a batch stores on its way goes with the batch
            work(batch, batch_id)

    return _start(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(scoped), every)


def _malformed(batch: DataFrame) -> DataFrame:
    """The records whose text is not a JSON object, for the topic ``malformed``."""
    found = parse.parse_json(batch, cdc.ENVELOPE, number_default=None, malformed="_text").filter(F.col("_text").isNotNull())
    return found.select(F.lit(None).cast("string").alias("key"), F.col("_text").alias("value"), F.lit(routing.MALFORMED).alias("topic"))


def malformed_records(
    source: DataFrame, sink, checkpoint: str, *, name: str = "malformed", every: str | None = None
) -> StreamingQuery:
    """Records that are no JSON object -> topic ``malformed``; beside the heat and revenue jobs, which leave them out."""
    return _start(sink.write_stream(_malformed(source), name, checkpoint), every)


def _well_formed(source: DataFrame, schema: T.StructType) -> DataFrame:
    return parse.parse_json(source, schema, malformed="_text").filter(F.col("_text").isNull()).drop("_text")


def user_log_to_dwd(
    source: DataFrame, sink, checkpoint: str, *,
    routes: Sequence[routing.Route] = routing.THREE_WAY, name: str = "dwd_user_log", every: str | None = None,
    group: GroupOffsets | None = None,
) -> StreamingQuery:
    """User log -> plays, logins and the rest, keyed records on one topic per route.

    With a ``group`` each batch commits how far the source was read; give the same one to the topic's ``read_stream``.
    """
    if group:
        def work(batch: DataFrame, batch_id: int) -> None:
            sink.write_batch(routing.route_events(batch, routes), name, batch_id)

        return _each_batch(source, group.tracked(work), checkpoint, every)
    return _start(sink.write_stream(routing.route_events(source, routes), name, checkpoint), every)


def cdc_to_dwd(
    source: DataFrame, load_config: ConfigLoader, sink, checkpoint: str, *,
    flat: bool = False, fact_ops: Sequence[str] | None = None, name: str = "dwd_changes", every: str | None = None,
    history: ConfigHistory | None = None,
) -> StreamingQuery:
    """Database changes -> fact and dimension records, by a configuration that is read anew for every batch.

    With a ``history`` rows that have left the configuration stay in force, and a replayed batch meets the configuration that
    it met before.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        config = load_config(spark)
        matched = cdc.classify(cdc.parse_changes(batch), history.at(config, batch_id) if history else config)
        wanted = cdc.wanted_kinds(matched, fact_ops)
        good = cdc.flat_records(wanted) if flat else cdc.records(wanted)
        sink.write_batch(good.unionByName(_malformed(batch)), name, batch_id)

    return _each_batch(source, work, checkpoint, every)


def dim_upsert(
    source: DataFrame, store: DimensionStore, checkpoint: str, *, flat: bool = False, every: str | None = None
) -> StreamingQuery:
    """Dimension records -> cleansed snapshots, last change per key. ``flat`` reads what ``cdc_to_dwd(flat=True)`` writes.

    All changes of a table in a batch are merged at once, whatever columns each of them is configured to give.
    """
    table = "phoenix_table_name" if flat else "phoenix_tbl_name"
    extra = [T.StructField(n, T.StringType()) for n in ("pk_col", "cols", table)]
    fields = T.StructType([*cdc.ENVELOPE.fields, *extra])

    def work(batch: DataFrame, batch_id: int) -> None:
        arrival = [c for c in cdc.ARRIVAL if c in batch.columns]
        changes = parse.parse_json(batch, fields, number_default=None, keep=[*arrival, F.col("value").alias("_text")])
        if flat:
            changes = changes.withColumn("data", F.col("_text")).withColumnRenamed(table, "phoenix_tbl_name")
        changes = changes.drop("_text").filter("phoenix_tbl_name IS NOT NULL AND pk_col IS NOT NULL AND cols IS NOT NULL")
        changes = materialize(changes, "changes")
        # As many rows as the configuration has dimension tables and column lists.
        targets: dict[tuple[str, str], set[str]] = {}
        for name, pk, cols in cdc.wanted_ops(changes).select("phoenix_tbl_name", "pk_col", "cols").distinct().collect():
            targets.setdefault((name, pk), set()).add(cols)
        for (name, pk), cols in sorted(targets.items()):
            store.upsert(changes, name, pk, cols, batch_id)

    return _each_batch(source, work, checkpoint, every)


def _enrich(source, schema, widen, added, sink, name, topic, checkpoint, every) -> StreamingQuery:
    """Put the ``added`` columns of the widened rows into each record's text; its other fields stay as they are."""
    def work(batch: DataFrame, batch_id: int) -> None:
        parsed = parse.parse_json(batch, schema, number_default=None, keep=[F.col("value").alias("_text")], malformed="_bad")
        wide = widen(parsed.filter(F.col("_bad").isNull()).drop("_bad"))
        good = wide.select(
            F.lit(None).cast("string").alias("key"), parse.put_fields(F.col("_text"), **{c: F.col(c) for c in added}).alias("value"),
            F.lit(topic).alias("topic"),
        )
        sink.write_batch(good.unionByName(_malformed(batch)), name, batch_id)

    return _each_batch(source, work, checkpoint, every)


def song_play_wide(
    source: DataFrame, store: DimensionStore, sink, checkpoint: str, *,
    columns: Sequence[str] = ("singer_info",), name: str = "dws_song_play", every: str | None = None,
) -> StreamingQuery:
    """Plays -> plays with song information from the newest snapshot."""
    def widen(plays: DataFrame) -> DataFrame:
        songs = store.read(C.DIM_SONG, ["source_id", *columns])
        return lookup.song_play_wide(plays, songs, columns, unique=True, small=store.is_small(C.DIM_SONG))

    return _enrich(source, C.PLAY_SCHEMA, widen, columns, sink, name, C.DWS_PLAY, checkpoint, every)


def login_wide(
    source: DataFrame, index: geo.PointIndex, sink, checkpoint: str, *,
    name: str = "dws_login", every: str | None = None,
) -> StreamingQuery:
    """Logins -> logins with the place of their coordinates."""
    def widen(logins: DataFrame) -> DataFrame:
        return geo.reverse_geocode(logins, index)

    return _enrich(source, C.LOGIN_SCHEMA, widen, geo.PLACE_COLUMNS, sink, name, C.DWS_LOGIN, checkpoint, every)


def order_wide(
    source: DataFrame, store: DimensionStore, sink, checkpoint: str, *,
    strict: bool = False, location_columns: Sequence[str] = tuple(C.LOCATION_COLUMNS), name: str = "dws_order",
    every: str | None = None,
) -> StreamingQuery:
    """Orders -> orders with the place and contract of their machine."""
    def widen(orders: DataFrame) -> DataFrame:
        small = store.is_small(C.DIM_MACHINE_LOCAL) and store.is_small(C.DIM_MACHINE_ADMIN)
        return lookup.order_wide(
            orders,
            store.read(C.DIM_MACHINE_LOCAL, ["mid", *location_columns]),
            store.read(C.DIM_MACHINE_ADMIN, ["machine_num", *C.CONTRACT_COLUMNS]),
            location_columns=location_columns, strict=strict, unique=True, small=small or None,
        )

    return _enrich(source, C.ORDER_SCHEMA, widen, [*location_columns, *C.CONTRACT_COLUMNS], sink, name, C.DWS_ORDER, checkpoint, every)


def _millis(interval: str) -> int:
    """A length such as "5 seconds"."""
    number, unit = interval.split()
    return int(number) * {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def _heat(rows, keys, counts, table, size, delay, mart, late, name, checkpoint, every) -> StreamingQuery:
    """Windows of ``rows`` by their time ``_ts`` into the mart, and late rows into the topic ``late``, in one query."""
    schema, width = rows.schema, _millis(size)
    found = keyed.windows_and_late_rows(rows, "_ts", list(keys.values()), size_ms=width, delay_ms=_millis(delay))

    def work(batch: DataFrame, batch_id: int) -> None:
        closed, behind = keyed.split_routes(materialize(batch, "routes"), schema, list(keys.values()), width)
        data_dt = F.date_format("window_start", C.DATE_FORMAT).alias("data_dt")
        mart.write_batch(closed.select(*[F.col(c).alias(n) for n, c in keys.items()], *[F.col("n").alias(c) for c in counts], data_dt), table, batch_id)
        late.write_batch(parse.to_records(behind.drop("_ts"), topic=keyed.LATE), name, batch_id)

    with rocksdb_state(rows.sparkSession):
        return _each_batch(found, work, checkpoint, every)


def song_hot(
    source: DataFrame, mart, checkpoint: str, *,
    size: str = "5 seconds", delay: str = "3 seconds", every: str | None = None, late=None, name: str = "song_hot_late",
) -> StreamingQuery:
    """Wide plays -> plays per song and window. ``late`` is a sink for the plays that come after their window has closed."""
    plays = _well_formed(source, C.PLAY_WIDE_SCHEMA)
    if late:
        timed = plays.withColumn("_ts", event_time("time"))
        counts = ("song_playtimes", "singer_playtimes")
        return _heat(timed, marts.SONG_KEYS, counts, C.MART_SONG_HOT, size, delay, mart, late, name, checkpoint, every)
    rows = marts.song_heat(plays, size=size, delay=delay).drop("window_start", "window_end")
    return _each_batch(rows, lambda df, i: mart.write_batch(df, C.MART_SONG_HOT, i), checkpoint, every)


def login_hot(
    source: DataFrame, mart, checkpoint: str, *,
    keys: Sequence[str] = marts.LOGIN_KEYS, size: str = "5 seconds", delay: str = "3 seconds", every: str | None = None, late=None,
    name: str = "login_hot_late",
) -> StreamingQuery:
    """Wide logins -> logins per place and window. ``late`` is a sink for the logins that come after their window has closed."""
    logins = _well_formed(source, C.LOGIN_WIDE_SCHEMA)
    if late:
        timed = logins.withColumn("_ts", event_time("login_dt"))
        return _heat(timed, {k: k for k in keys}, ("login_times",), C.MART_LOGIN, size, delay, mart, late, name, checkpoint, every)
    rows = marts.login_heat(logins, keys=keys, size=size, delay=delay).drop("window_start", "window_end")
    return _each_batch(rows, lambda df, i: mart.write_batch(df, C.MART_LOGIN, i), checkpoint, every)


def order_revenue(
    source: DataFrame, mart, checkpoint: str, *, dt_from: str = "bill_date", address_from: str = "contract",
    every: str | None = None,
) -> StreamingQuery:
    """Wide orders -> the four parties' revenue, row by row."""
    schema = C.ORDER_WIDE_SCHEMA if address_from == "contract" else T.StructType([*C.ORDER_WIDE_SCHEMA, T.StructField("address", T.StringType())])
    revenue = marts.order_revenue(_well_formed(source, schema), dt_from=dt_from, address_from=address_from)
    return _each_batch(revenue, lambda df, i: mart.write_batch(df, C.MART_ORDER, i), checkpoint, every)


def daily_sums(source: DataFrame, mart: SummedMart, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Rows of a mart -> their daily sums, which each batch adds to."""
    return _each_batch(source, lambda df, i: mart.write_batch(df, i), checkpoint, every)
