"""The same results from streams, each run to the end of its input.

The test tables are read as file streams; tables that a stream writes go below the shared scratch folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import constants as C
from ..fs import SharedFiles
from ..operators import lookup, marts, parse, routing
from ..plans import jobs
from ..session import materialize, rocksdb_state, scratch, scratch_path
from ..sources.config import ConfigHistory, config_from_rows
from ..sources.marts import ParquetMarts
from ..sources.topics import FolderTopics
from ..streaming import keyed
from ..streaming.counts import CountWindowStream
from ..streaming.dimensions import DimensionStore
from ..streaming.once import data_files, read_committed, write_batch_once
from ..streaming.rollups import SummedMart
from .inputs import (
    CHANGES_SQL, CONFIG_ROWS, MACHINES_SQL, REVENUE_SQL, WIDE_SQL, change_log, contract_dim, location_dim, log_text,
    order_changes, point_index, song_dim,
)
from .logs import _KINDS
from .ordered import _gaps
from .registry import check, load
from .warehouse import _ORDER_COLUMNS, _REVENUE_COLUMNS, _WIDE_LOGINS, _WIDE_PLAYS, login_heat_sql, song_heat_sql, wide_plays


def stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    schema = load(spark, sf_dir, table).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_text(stream(spark, sf_dir, "events"))


def _closed(sql: str, source: str, delay: str) -> str:
    """Only windows that the end of the stream closes."""
    return f"""WITH heat AS ({sql}), ends AS ({source})
SELECT * EXCLUDE (window_start, window_end) FROM heat
WHERE CAST(window_end AS TIMESTAMP) <= (SELECT max(at_ts) FROM ends) - INTERVAL '{delay}'"""


@check(f"WITH {_WIDE_PLAYS}" + _closed(song_heat_sql("plays_wide", "1 hour"), "SELECT at_ts FROM plays", "3 hours").replace("WITH heat", ", heat", 1))
def stream_song_hot(spark, sf_dir):
    """Log text -> route -> lookup -> windows -> mart, in one streaming query."""
    root = scratch_path(spark, "song-hot")
    plays = routing.only(routing.route_events(log_stream(spark, sf_dir)), "play")
    wide = lookup.song_play_wide(parse.parse_json(plays, C.PLAY_SCHEMA), song_dim(spark, sf_dir))
    mart = ParquetMarts(f"{root}/mart")
    jobs.song_hot(
        parse.to_records(wide, topic=C.DWS_PLAY), mart, f"{root}/checkpoint", size="1 hour", delay="3 hours"
    ).awaitTermination()
    return mart.read(spark, C.MART_SONG_HOT)


@check(f"WITH {_WIDE_LOGINS}" + _closed(login_heat_sql("province, city, district, lng, lat", "1 hour"), "SELECT at_ts FROM logins", "3 hours").replace("WITH heat", ", heat", 1))
def stream_login_loc(spark, sf_dir):
    """Three jobs hand logins on: the router, the geocoder and the counter."""
    root = scratch_path(spark, "login-loc")
    topics, mart = FolderTopics(f"{root}/topics"), ParquetMarts(f"{root}/mart")
    jobs.user_log_to_dwd(log_stream(spark, sf_dir), topics, f"{root}/c1").awaitTermination()
    logins = topics.read_stream(spark, C.DWD_LOGIN, "dwd_user_log")
    jobs.login_wide(logins, point_index(spark, sf_dir, stored=True), topics, f"{root}/c2").awaitTermination()
    wide = topics.read_stream(spark, C.DWS_LOGIN, "dws_login")
    jobs.login_hot(wide, mart, f"{root}/c3", size="1 hour", delay="3 hours").awaitTermination()
    return mart.read(spark, C.MART_LOGIN)


@check(f"""WITH {_KINDS}
SELECT route, CASE route WHEN 'play' THEN '{C.DWD_PLAY}' WHEN 'login' THEN '{C.DWD_LOGIN}' WHEN 'other' THEN '{C.DWD_OTHER}' ELSE 'malformed' END AS topic,
       count(*) AS n FROM kinds GROUP BY ALL""".replace("SELECT route, CASE", "SELECT CASE"))
def stream_user_log_routes(spark, sf_dir):
    root = scratch_path(spark, "routes")
    topics = FolderTopics(root)
    jobs.user_log_to_dwd(log_stream(spark, sf_dir), topics, f"{root}/checkpoint").awaitTermination()
    written = spark.read.parquet(topics.path("dwd_user_log"))
    return written.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


# About what a file of a batch holds: a task reads one or a few of them.
_FILE_BYTES = 8 * 1024 * 1024


def _dealt(df: DataFrame, number: Column) -> tuple[DataFrame, int]:
    """``df`` stored by the number of the batch that each row belongs to, and the files that the largest batch needs."""
    path = scratch_path(df.sparkSession, "batches")
    stored = materialize(df.withColumn("_number", number.cast("bigint")), "batches", partition_by=["_number"], path=path)
    sizes: dict[str, int] = {}
    for name, size in SharedFiles(df.sparkSession).files(path).items():
        sizes[name.split("/")[0]] = sizes.get(name.split("/")[0], 0) + size
    return stored, max(1, math.ceil(max(sizes.values(), default=0) / _FILE_BYTES))


def _put(stored: DataFrame, k: int, files: int, root: str) -> None:
    """Batch ``k`` as exactly so many files, newer than those of the batches before; some are empty if rows are few."""
    path, spark = f"{root}/in/batch={k}", stored.sparkSession
    rows = stored.filter(F.col("_number") == k).drop("_number")
    (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.parquet(path)
    for _ in range(files - len(data_files(SharedFiles(spark), path))):
        spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)


def _incoming(df: DataFrame, root: str, **options) -> DataFrame:
    return df.sparkSession.readStream.schema(df.schema).options(**options).parquet(f"{root}/in/batch=*")


def in_batches(df: DataFrame, number: Column, batches: int, root: str) -> DataFrame:
    """A stream over ``df`` with one micro-batch per value of ``number`` from 0 on."""
    stored, files = _dealt(df, number)
    for k in range(batches):
        _put(stored, k, files, root)
    return _incoming(df, root, maxFilesPerTrigger=files)


_BATCHES = 4


@check(f"""WITH ranked AS (
  SELECT *, row_number() OVER (ORDER BY event_id % {_BATCHES}, ts, event_id) - 1 AS seq, count(*) OVER () AS total FROM events)
SELECT first_value(event_id) OVER (PARTITION BY seq // 7 ORDER BY seq) AS first_event, event_id, CAST(seq % 7 AS INTEGER) AS window_pos
FROM ranked WHERE (seq // 7 + 1) * 7 <= total""")
def stream_count_window(spark, sf_dir):
    """Row-count windows over several micro-batches, with the rest of each carried into the next."""
    root = scratch_path(spark, "count-window")
    work = CountWindowStream(spark, f"{root}/out", 7, ["ts", "event_id"])
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    ordered = in_batches(events, F.col("event_id") % _BATCHES, _BATCHES, root)
    batches = ordered.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    # What a batch carries over comes before its own rows, whatever the times.
    batches.foreachBatch(lambda df, k: CountWindowStream(
        spark, work.root, 7, ["arrived", "ts", "event_id"])(df.withColumn("arrived", F.lit(k)), k)).start().awaitTermination()
    window = Window.partitionBy("batch", "window_no").orderBy("window_pos")
    return work.windows().select(F.first("event_id").over(window).alias("first_event"), "event_id", "window_pos")


@check(f"""WITH ranked AS (
  SELECT *, row_number() OVER (ORDER BY event_id % {_BATCHES}, ts, event_id) - 1 AS seq, count(*) OVER () AS total FROM events)
SELECT event_id, first_value(event_id) OVER (PARTITION BY seq // 10 ORDER BY seq) AS first_event, rank() OVER (PARTITION BY seq // 10 ORDER BY value) AS value_rank
FROM ranked WHERE (seq // 10 + 1) * 10 <= total""")
def stream_count_window_apply(spark, sf_dir):
    """A function on every row-count window of a stream, over several micro-batches."""
    root = scratch_path(spark, "count-apply")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    ordered = in_batches(events, F.col("event_id") % _BATCHES, _BATCHES, root)
    work = CountWindowStream(
        spark, f"{root}/out", 10, ["arrived", "ts", "event_id"], fn=_gaps, schema="window_no long, event_id long, first_event long, value_rank long")
    batches = ordered.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    batches.foreachBatch(lambda df, k: work(df.withColumn("arrived", F.lit(k)), k)).start().awaitTermination()
    return work.windows().select("event_id", "first_event", "value_rank")


@check(f"""WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % {_BATCHES}, ts, event_id) - 1 AS seq, count(*) OVER (PARTITION BY user_id) AS total
  FROM events)
SELECT user_id, event_id, seq // 5 AS window_no, CAST(seq % 5 AS INTEGER) AS window_pos FROM ranked WHERE (seq // 5 + 1) * 5 <= total""")
def stream_count_window_keyed(spark, sf_dir):
    """Row-count windows by key, in operator state over several micro-batches."""
    root = scratch_path(spark, "count-keyed")
    events = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    ordered = in_batches(events, F.col("event_id") % _BATCHES, _BATCHES, root)
    return _written(keyed.count_windows_by_key(ordered, 5, ["user_id"], ["ts", "event_id"]), root).drop("ts", "batch")


@check(f"""SELECT event_id, user_id, epoch_us(ts) AS micros FROM (
  SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id % {_BATCHES}, ts, event_id) AS k FROM events) WHERE k = 1""")
def stream_first_per_key(spark, sf_dir):
    """The first event of every user over several micro-batches."""
    root = scratch_path(spark, "first")
    events = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    ordered = in_batches(events, F.col("event_id") % _BATCHES, _BATCHES, root)
    found = _written(keyed.first_per_key(ordered, ["user_id"], ["ts", "event_id"]), root)
    return found.select("event_id", "user_id", F.unix_micros("ts").alias("micros"))


@check(f"""WITH {_WIDE_PLAYS}
SELECT strftime(at_ts, '%Y-%m-%d') AS data_dt, songid AS song_id, songname AS song_name, singer_info AS singer_name,
       count(*) AS song_playtimes, count(*) AS singer_playtimes FROM plays_wide GROUP BY ALL""")
def stream_rollup_song_daily(spark, sf_dir):
    """Daily sums kept up by six micro-batches of hourly heat, with dates that are summed up on the way."""
    root = scratch_path(spark, "daily")
    heat = marts.song_heat(wide_plays(spark, sf_dir), size="1 hour").drop("window_start", "window_end")
    mart = SummedMart(spark, f"{root}/mart", list(marts.SONG_KEYS), ["song_playtimes", "singer_playtimes"], delta_files=2)
    hourly = in_batches(heat, F.pmod(F.xxhash64("song_id", "data_dt"), F.lit(6)), 6, root)
    jobs.daily_sums(hourly, mart, f"{root}/checkpoint").awaitTermination()
    return mart.read()


_ROUNDS = 3


@check(f"""WITH {CHANGES_SQL}, known AS (SELECT *, (xid % {_ROUNDS})::INTEGER AS round FROM changes JOIN conf USING (tbl))
SELECT CASE WHEN kind = 'dim' AND round = 2 THEN sink_topic || '_2' ELSE sink_topic END AS topic, count(*) AS n
FROM known WHERE kind = 'dim' OR round > 0 GROUP BY ALL""")
def cdc_classify_config_history(spark, sf_dir):
    """Facts are configured from the second of three batches on; then the dimensions leave the table, and come back with another topic."""
    root = scratch_path(spark, "history")
    rows = [dict(zip(C.CONFIG_SCHEMA.names, r)) for r in CONFIG_ROWS]
    facts, dims = ([r for r in rows if (r["tbl_type"] == "dim") == wanted] for wanted in (False, True))
    moved = [{**r, "sink_topic": r["sink_topic"] + "_2"} for r in dims]
    tables = iter([dims, facts, moved])
    topics = FolderTopics(f"{root}/topics")
    log = change_log(spark, sf_dir).withColumn("xid", F.coalesce(F.get_json_object("value", "$.xid").cast("bigint"), F.lit(0)))
    changes = in_batches(log, F.pmod("xid", F.lit(_ROUNDS)), _ROUNDS, root).select("value")
    jobs.cdc_to_dwd(
        changes, lambda s: config_from_rows([tuple(r.values()) for r in next(tables)])(s), topics, f"{root}/c1",
        history=ConfigHistory(f"{root}/history"),
    ).awaitTermination()
    written = read_committed(spark, topics.path("dwd_changes"), C.RECORD_SCHEMA)
    return written.filter("topic <> 'malformed'").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def _written(stream: DataFrame, root: str) -> DataFrame:
    """All rows that a stream with state of its own gives, each of its batches written once."""
    query = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    query = query.foreachBatch(lambda df, k: write_batch_once(df, f"{root}/out", k))
    with rocksdb_state(stream.sparkSession):
        running = query.start()
    running.awaitTermination()
    return read_committed(spark=stream.sparkSession, path=f"{root}/out", schema=stream.schema)


_HOUR = 3_600_000
_ARRIVED_SQL = f"""arrived AS (SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms,
    epoch_us(ts) // 1000 + (event_id * 7919 % 10) * {_HOUR} AS arrival FROM events),
spread AS (SELECT min(arrival) AS low, max(arrival) AS high FROM arrived),
dealt AS (SELECT *, (arrival - low) * 6 // (high - low + 1) AS batch, (ms // {_HOUR} + 1) * {_HOUR} AS stop FROM arrived, spread),
peaks AS (SELECT batch, max(ms) AS peak FROM dealt GROUP BY batch),
clocks AS (SELECT batch, max(peak) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_HOUR} AS clock FROM peaks),
judged AS (SELECT *, coalesce(stop <= clock, false) AS late FROM dealt JOIN clocks USING (batch))"""


@check(f"""WITH {_ARRIVED_SQL}
SELECT 'late' AS route, event_type, stop, count(*) AS n FROM judged WHERE late GROUP BY ALL
UNION ALL SELECT 'on time', event_type, stop, count(*) FROM judged WHERE NOT late AND stop <= (SELECT max(peak) - {_HOUR} FROM peaks) GROUP BY ALL""")
def stream_late_rows(spark, sf_dir):
    """Hourly counts of a stream in six batches, and how many rows of each window came too late for it."""
    root = scratch_path(spark, "late")
    events = load(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    arrival = F.unix_millis("ts") + F.pmod(F.col("event_id") * 7919, F.lit(10)) * _HOUR
    low, high = events.agg(F.min(arrival), F.max(arrival)).first()
    number = F.floor((arrival - low) * 6 / (high - low + 1)).cast("int")
    ordered = in_batches(events, number, 6, root)
    found = keyed.windows_and_late_rows(ordered, "ts", ["event_type"], size_ms=_HOUR, delay_ms=_HOUR, lanes=8)

    def split(batch: DataFrame, k: int) -> None:
        with scratch(spark):
            counts, late = keyed.split_routes(materialize(batch), ordered.schema, ["event_type"], _HOUR)
            write_batch_once(counts, f"{root}/counts", k)
            write_batch_once(late, f"{root}/late", k)

    query = found.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(split)
    with rocksdb_state(spark):
        running = query.start()
    running.awaitTermination()
    stop = F.unix_millis("window_end").alias("stop")
    counts = read_committed(spark, f"{root}/counts").select(F.lit(keyed.ON_TIME).alias("route"), "event_type", stop, "n")
    late = read_committed(spark, f"{root}/late").groupBy("event_type", stop).agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(late.select(F.lit(keyed.LATE).alias("route"), "event_type", "stop", "n"))


@check(f"WITH {CHANGES_SQL}, {MACHINES_SQL} SELECT mid, province, city, address FROM machine_dim")
def stream_dim_upsert(spark, sf_dir):
    """Change log -> dimension records -> snapshots merged batch by batch, in two jobs over the whole log."""
    return _dim_stream(spark, sf_dir)


@check(f"WITH {CHANGES_SQL}, {MACHINES_SQL} SELECT mid, province, city, address FROM machine_dim")
def stream_dim_upsert_flat(spark, sf_dir):
    """The same through flat records. These carry no transaction, so the changes that are drafts of one stay out."""
    return _dim_stream(spark, sf_dir, flat=True)


@check(f"WITH {CHANGES_SQL}, {MACHINES_SQL} SELECT mid, province, city, address FROM machine_dim")
def stream_dim_upsert_deltas(spark, sf_dir):
    """The same in eight batches into a store that is made to merge deltas and to split buckets on the way."""
    return _dim_stream(spark, sf_dir, batches=8, bucket_bytes=20_000, delta_bytes=2_000, delta_files=2)


def _dim_stream(spark: SparkSession, sf_dir: str, flat: bool = False, batches: int = 3, **options) -> DataFrame:
    root = scratch_path(spark, "dim-upsert")
    topics, store = FolderTopics(f"{root}/topics"), DimensionStore(spark, f"{root}/dims", **options)
    # In the order of time, so that the last arrival is the latest change.
    log = change_log(spark, sf_dir)
    if flat:
        log = log.filter(~F.col("value").contains('"xoffset":0,"data":{"mid"'))
    timed = materialize(log.withColumn("ts", F.get_json_object("value", "$.ts").cast("bigint")), "log")
    bounds = timed.filter("ts > 0").agg(F.percentile_approx("ts", [k / batches for k in range(1, batches)], 100)).first()[0]
    number = sum((F.coalesce(F.col("ts") > b, F.lit(False)).cast("int") for b in bounds), F.lit(0))
    stored, files = _dealt(timed, number)
    for k in range(batches):
        # Both jobs come to the end of each batch, so the second one takes a batch whole, however many files it is in.
        _put(stored, k, files, root)
        changes = _incoming(timed, root).select("value")
        jobs.cdc_to_dwd(changes, config_from_rows(CONFIG_ROWS), topics, f"{root}/c1", flat=flat).awaitTermination()
        jobs.dim_upsert(topics.read_stream(spark, C.DWD_DIM, "dwd_changes"), store, f"{root}/c2", flat=flat).awaitTermination()
    return store.read(C.DIM_MACHINE_LOCAL).select("mid", "province", "city", "address")


@check(f"""WITH {_KINDS} SELECT 'user log' AS job, count(*) AS n FROM kinds WHERE route = 'malformed' HAVING count(*) > 0
UNION ALL SELECT 'changes', count(*) FROM kinds WHERE route = 'malformed' HAVING count(*) > 0
UNION ALL SELECT 'heat', count(*) FROM kinds WHERE route = 'malformed' HAVING count(*) > 0""")
def stream_malformed_routes(spark, sf_dir):
    """Text that is no JSON object comes out of every job on a route of its own."""
    root = scratch_path(spark, "malformed")
    topics = FolderTopics(root)
    jobs.user_log_to_dwd(log_stream(spark, sf_dir), topics, f"{root}/c1", name="user log").awaitTermination()
    jobs.cdc_to_dwd(log_stream(spark, sf_dir), config_from_rows(CONFIG_ROWS), topics, f"{root}/c2", name="changes").awaitTermination()
    jobs.malformed_records(log_stream(spark, sf_dir), topics, f"{root}/c3", name="heat").awaitTermination()
    found = [topics.read(spark, routing.MALFORMED, job).select(F.lit(job).alias("job")) for job in ("user log", "changes", "heat")]
    return found[0].unionByName(found[1]).unionByName(found[2]).groupBy("job").agg(F.count(F.lit(1)).alias("n"))


def _save_dim(spark: SparkSession, df: DataFrame, root: str, table: str) -> None:
    DimensionStore(spark, root).put(df, table, {C.DIM_SONG: "source_id", C.DIM_MACHINE_LOCAL: "mid"}.get(table, "machine_num"))


@check(f"WITH {_WIDE_PLAYS} SELECT session_id, songid, singer_info FROM plays_wide")
def stream_song_play_wide(spark, sf_dir):
    root = scratch_path(spark, "song-wide")
    topics, store = FolderTopics(f"{root}/topics"), DimensionStore(spark, f"{root}/dims")
    _save_dim(spark, song_dim(spark, sf_dir), store.root, C.DIM_SONG)
    plays = routing.only(routing.route_events(log_stream(spark, sf_dir)), "play")
    jobs.song_play_wide(plays, store, topics, f"{root}/checkpoint").awaitTermination()
    wide = parse.parse_json(topics.read(spark, C.DWS_PLAY, "dws_song_play"), C.PLAY_WIDE_SCHEMA)
    return wide.select("session_id", "songid", "singer_info")


def _order_stream(spark: SparkSession, sf_dir: str, root: str) -> FolderTopics:
    """Fact changes of all orders, enriched with the two machine dimensions."""
    topics, store = FolderTopics(f"{root}/topics"), DimensionStore(spark, f"{root}/dims")
    _save_dim(spark, location_dim(spark, sf_dir), store.root, C.DIM_MACHINE_LOCAL)
    _save_dim(spark, contract_dim(spark, sf_dir), store.root, C.DIM_MACHINE_ADMIN)
    log = order_changes(stream(spark, sf_dir, "orders"))
    jobs.cdc_to_dwd(log, config_from_rows(CONFIG_ROWS), topics, f"{root}/c1").awaitTermination()
    facts = topics.read_stream(spark, C.DWD_ORDER, "dwd_changes")
    jobs.order_wide(facts, store, topics, f"{root}/c2").awaitTermination()
    return topics


@check(f"WITH {WIDE_SQL} SELECT {', '.join(_ORDER_COLUMNS)} FROM wide")
def stream_order_wide(spark, sf_dir):
    topics = _order_stream(spark, sf_dir, scratch_path(spark, "order-wide"))
    wide = parse.parse_json(topics.read(spark, C.DWS_ORDER, "dws_order"), C.ORDER_WIDE_SCHEMA, number_default=None)
    return wide.select(_ORDER_COLUMNS)


@check(f"WITH {REVENUE_SQL} SELECT {_REVENUE_COLUMNS}, data_dt FROM revenue")
def stream_order_revenue(spark, sf_dir):
    root = scratch_path(spark, "order-revenue")
    # The orders span years of bill dates in one batch.
    topics, mart = _order_stream(spark, sf_dir, root), ParquetMarts(f"{root}/mart", date_folders=False)
    wide = topics.read_stream(spark, C.DWS_ORDER, "dws_order")
    jobs.order_revenue(wide, mart, f"{root}/c3").awaitTermination()
    return mart.read(spark, C.MART_ORDER)
