"""Parsing, routing and change records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import constants as C
from ..operators import cdc, parse, routing
from .inputs import CHANGES_SQL, LOGINS_SQL, MACHINES_SQL, PLAYS_SQL, change_log, config, user_log
from .registry import check, load

_KINDS = """kinds AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN 'play' WHEN 'signup' THEN 'login' WHEN 'error' THEN 'malformed' ELSE 'other' END AS route,
         user_id FROM events)"""


def routed(spark: SparkSession, sf_dir: str, routes=routing.THREE_WAY) -> DataFrame:
    return routing.route_events(user_log(spark, sf_dir), routes)


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_json(routing.only(routed(spark, sf_dir), "play"), C.PLAY_SCHEMA)


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_json(routing.only(routed(spark, sf_dir), "login"), C.LOGIN_SCHEMA)


@check(f"""WITH {PLAYS_SQL}
SELECT songid, songname, '' AS order_id, uid, mid, session_id, '100' AS pkg_id, CAST(NULL AS VARCHAR) AS optrate_type,
       CAST(NULL AS VARCHAR) AS consume_type, dur_time, play_time, time FROM plays""")
def parse_events_json(spark, sf_dir):
    return plays(spark, sf_dir)


@check(f"WITH {_KINDS} SELECT route, count(*) AS n FROM kinds GROUP BY route")
def route_user_log_counts(spark, sf_dir):
    return routed(spark, sf_dir).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@check(f"WITH {PLAYS_SQL} SELECT songid, uid, session_id, time FROM plays")
def route_user_log_play(spark, sf_dir):
    body = routing.only(routed(spark, sf_dir), "play")
    return body.select(
        *[F.get_json_object("value", f"$.{name}").alias(name) for name in ("songid", "uid", "session_id")],
        F.get_json_object("value", "$.time").cast("bigint").alias("time"),
    )


@check(f"""WITH {LOGINS_SQL}
SELECT uid, mid, lng, lat, login_dt, CAST(NULL AS VARCHAR) AS event_type FROM logins_text""")
def route_user_log_login(spark, sf_dir):
    fields = T.StructType([*C.LOGIN_SCHEMA.fields, T.StructField("event_type", T.StringType())])
    return parse.parse_json(routing.only(routed(spark, sf_dir), "login"), fields)


@check("""SELECT event_id, CASE event_type WHEN 'view' THEN 'PAGE_VIEW' END AS event_type, CAST(user_id + 80000 AS VARCHAR) AS mid
FROM events WHERE event_type IN ('view', 'purchase')""")
def route_user_log_other(spark, sf_dir):
    raw = routing.only(routed(spark, sf_dir), "other")
    event_id = F.coalesce(F.get_json_object("value", "$.event_content.event_id"), F.get_json_object("value", "$.event_id"))
    return raw.select(
        event_id.cast("bigint").alias("event_id"), F.get_json_object("value", "$.event_type").alias("event_type"),
        F.get_json_object("value", "$.mid").alias("mid"),
    )


@check(f"""WITH {_KINDS}
SELECT route, CASE route WHEN 'play' THEN CAST(user_id AS VARCHAR) WHEN 'login' THEN CAST(user_id + 80000 AS VARCHAR) END AS key,
       count(*) AS n FROM kinds GROUP BY ALL""")
def route_user_log_keyed(spark, sf_dir):
    return routed(spark, sf_dir).groupBy("route", "key").agg(F.count(F.lit(1)).alias("n"))


@check(f"""WITH {_KINDS}
SELECT CASE route WHEN 'login' THEN 'other' ELSE route END AS route,
       CASE route WHEN 'play' THEN CAST(user_id + 80000 AS VARCHAR) END AS key, count(*) AS n FROM kinds GROUP BY ALL""")
def route_user_log_two_way(spark, sf_dir):
    return routed(spark, sf_dir, routing.TWO_WAY).groupBy("route", "key").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- changes


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.parse_changes(change_log(spark, sf_dir))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.classify(changes(spark, sf_dir), config(spark))


@check(f"WITH {CHANGES_SQL} SELECT tbl AS \"table\", type, xid FROM changes WHERE tbl <> 'nation'")
def cdc_configured_only(spark, sf_dir):
    return cdc.configured_only(changes(spark, sf_dir), config(spark)).select("table", "type", "xid")


@check(f"""WITH {CHANGES_SQL}
SELECT tbl AS "table", kind, type, sink_topic, phoenix_tbl_name, pk_col, count(*) AS n, CAST(sum(xid) AS BIGINT) AS xids
FROM changes JOIN conf USING (tbl) GROUP BY ALL""")
def cdc_classify(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("table", "kind", "type", "sink_topic", "phoenix_tbl_name", "pk_col").agg(
        F.count(F.lit(1)).alias("n"), F.sum("xid").alias("xids")
    )


@check(f"""WITH {CHANGES_SQL}
SELECT '{C.DWD_ORDER}' AS topic, CAST(NULL AS VARCHAR) AS key, o_orderkey AS id, o_custkey AS mid,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount, strftime(o_orderdate, '%Y%m%d') AS bill_date, '' AS trade_no,
       CAST(ts AS VARCHAR) AS ts FROM order_log""")
def cdc_fact_records(spark, sf_dir):
    records = cdc.fact_records(classified(spark, sf_dir))
    data = parse.parse_json(records, C.ORDER_SCHEMA, number_default=None, keep=["topic", "key"])
    return data.select("topic", "key", "id", "mid", "amount", "bill_date", "trade_no", "ts")


@check(f"""WITH {CHANGES_SQL}
SELECT '{C.DWD_DIM}' AS topic, 'sales' || tbl AS key, tbl AS "table", type, ts, xid, pk_col, phoenix_tbl_name, sink_topic
FROM changes JOIN conf USING (tbl) WHERE kind = 'dim'""")
def cdc_dim_records(spark, sf_dir):
    records = cdc.dim_records(classified(spark, sf_dir))
    texts = [T.StructField(n, T.StringType()) for n in ("table", "type", "pk_col", "phoenix_tbl_name", "sink_topic")]
    longs = [T.StructField(n, T.LongType()) for n in ("ts", "xid")]
    return parse.parse_json(records, T.StructType(texts + longs), number_default=None, keep=["topic", "key"])


@check(f"""WITH {CHANGES_SQL},
flat AS (
  SELECT 'orders' AS tbl, CAST(o_orderkey AS VARCHAR) AS pk, type, ts FROM order_log
  UNION ALL SELECT 'machine', CAST(o_custkey AS VARCHAR), type, ts FROM order_log, (VALUES (1), (2))
  UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), 'bootstrap-insert', 0 FROM part)
SELECT sink_topic AS topic, type, CAST(ts AS VARCHAR) AS ts, pk_col, phoenix_tbl_name AS phoenix_table_name, pk
FROM flat JOIN conf USING (tbl)""")
def cdc_flat_records(spark, sf_dir):
    records = cdc.flat_records(classified(spark, sf_dir))
    names = ("type", "ts", "pk_col", "phoenix_table_name", "id", "mid", "source_id")
    flat = parse.parse_json(records, T.StructType([T.StructField(n, T.StringType()) for n in names]), keep=["topic"])
    pk = F.when(F.col("pk_col") == "id", F.col("id")).when(F.col("pk_col") == "mid", F.col("mid")).otherwise(F.col("source_id"))
    return flat.select("topic", "type", "ts", "pk_col", "phoenix_table_name", pk.alias("pk"))


@check(f"""WITH {CHANGES_SQL}
SELECT tbl AS "table", type, count(*) AS n FROM changes
WHERE type IN ('insert', 'update', 'bootstrap-insert') GROUP BY ALL""")
def cdc_op_filter(spark, sf_dir):
    return cdc.wanted_ops(changes(spark, sf_dir)).groupBy("table", "type").agg(F.count(F.lit(1)).alias("n"))


@check(f"WITH {CHANGES_SQL}, {MACHINES_SQL} SELECT mid, province, city, address FROM machine_dim")
def dim_upsert_latest(spark, sf_dir):
    dims = cdc.dim_changes(classified(spark, sf_dir))
    return cdc.latest_dim_rows(dims, C.DIM_MACHINE_LOCAL, "mid", "mid,province,city,address")


# Numbers as a log may spell them, in Spark SQL; the twin knows what they mean.
_ODD_NUMBER = """CASE CAST(event_id % 5 AS INTEGER) WHEN 0 THEN '"' || event_id || '"' WHEN 1 THEN event_id || '.75'
  WHEN 2 THEN event_id || 'e1' WHEN 3 THEN '"none"' ELSE '' || event_id END"""


@check("""SELECT event_id, CASE event_id % 5 WHEN 2 THEN event_id * 10 WHEN 3 THEN 0 ELSE event_id END AS time,
  CASE WHEN event_id % 2 = 0 THEN 0 ELSE user_id END AS uid FROM events""")
def parse_events_odd_numbers(spark, sf_dir):
    """Quoted numbers, fractions and exponents; unreadable and missing ones become 0."""
    uid = "CASE WHEN event_id % 2 = 0 THEN '' ELSE ',\"uid\":' || user_id END"
    text = f"""'{{"event_id":' || event_id || ',"time":' || {_ODD_NUMBER} || {uid} || '}}'"""
    odd = load(spark, sf_dir, "events").select(F.expr(text).alias("value"))
    return parse.parse_json(odd, T.StructType([T.StructField(n, T.LongType()) for n in ("event_id", "time", "uid")]))


@check("""SELECT event_id, event_id + 1 AS twice, event_id / 4.0 AS quarter, 'new' AS ts FROM events""")
def cdc_put_fields_edge(spark, sf_dir):
    """Fields put into objects with repeated names, nulls and numbers of many spellings."""
    quarter = "CAST(event_id / 4 AS DECIMAL(20, 4))"
    text = f"""'{{"event_id":' || event_id || ',"twice":0,"twice":' || (event_id + 1) || ',"quarter":' || {quarter}
      || CASE CAST(event_id % 3 AS INTEGER) WHEN 0 THEN ',"gone":null' WHEN 1 THEN ',"ts":"old"' ELSE '' END || '}}'"""
    odd = load(spark, sf_dir, "events").select(F.expr(text).alias("value"))
    put = odd.select(parse.put_fields(F.col("value"), ts=F.lit("new")).alias("value"))
    fields = [T.StructField("event_id", T.LongType()), T.StructField("twice", T.LongType()), T.StructField("quarter", T.DoubleType()), T.StructField("ts", T.StringType())]
    return parse.parse_json(put, T.StructType(fields))
