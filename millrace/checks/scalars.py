"""Cleansing functions and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import address, cleansing, dates, money, text
from ..operators import cdc
from .inputs import ADDRESSES_SQL, RAW_SONGS_SQL, addresses, raw_songs, song_changes, config
from .registry import check, load


@check(f"WITH {ADDRESSES_SQL} SELECT mid, found_province AS province FROM places")
def clean_province(spark, sf_dir):
    return addresses(spark, sf_dir).select("mid", address.province(F.col("address")).alias("province"))


@check(f"WITH {ADDRESSES_SQL} SELECT mid, found_city AS city FROM places")
def clean_city(spark, sf_dir):
    return addresses(spark, sf_dir).select("mid", address.city(F.col("address")).alias("city"))


@check(f"""WITH {ADDRESSES_SQL}
SELECT mid, address, CASE WHEN province = '无信息' THEN found_province ELSE province END AS province,
       CASE WHEN city = '无信息' THEN found_city ELSE city END AS city FROM places""")
def clean_machine_local(spark, sf_dir):
    return cleansing.clean_machine_local(addresses(spark, sf_dir))


@check(f"WITH {RAW_SONGS_SQL} SELECT source_id, singer_info FROM cleansed")
def clean_singer(spark, sf_dir):
    return raw_songs(spark, sf_dir).select("source_id", cleansing.singer_name(F.col("singer_info")).alias("singer_info"))


@check(f"WITH {RAW_SONGS_SQL} SELECT source_id, album FROM cleansed")
def clean_album(spark, sf_dir):
    return raw_songs(spark, sf_dir).select("source_id", cleansing.album_name(F.col("album")).alias("album"))


@check(f"WITH {RAW_SONGS_SQL} SELECT source_id, authorized_company FROM cleansed")
def clean_company(spark, sf_dir):
    company = cleansing.company_name(F.col("authorized_company"))
    return raw_songs(spark, sf_dir).select("source_id", company.alias("authorized_company"))


@check(f"WITH {RAW_SONGS_SQL} SELECT source_id, post_time FROM cleansed")
def clean_format_date(spark, sf_dir):
    return raw_songs(spark, sf_dir).select("source_id", dates.format_date(F.col("post_time")).alias("post_time"))


@check("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events""")
def clean_format_date_short(spark, sf_dir):
    """Dates and times without leading zeros."""
    short = F.date_format("ts", "yyyy-M-d H:m:s")
    return load(spark, sf_dir, "events").select("event_id", dates.format_date(short).alias("stamp"))


@check(f"WITH {RAW_SONGS_SQL} SELECT * FROM cleansed")
def clean_song_dim(spark, sf_dir):
    """Through the change records, as the dimension job does it."""
    songs = song_changes(raw_songs(spark, sf_dir))
    dims = cdc.dim_changes(cdc.classify(cdc.parse_changes(songs), config(spark)))
    cols = "source_id,name,album,singer_info,post_time,authorized_company"
    return cdc.latest_dim_rows(dims, "DIM_SONG", "source_id", cols)


@check("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def fn_epoch_date(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return load(spark, sf_dir, "events").select("event_id", dates.epoch_date(millis).alias("day"))


@check("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second FROM events")
def fn_epoch_datetime(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return load(spark, sf_dir, "events").select("event_id", dates.epoch_datetime(millis).alias("second"))


def _sparse_text():
    """Events with a text that is null, empty, an empty list or a number."""
    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.lit("")).when(kind == "view", F.lit("[]"))
        .when(kind == "purchase", F.col("user_id").cast("string")).when(kind == "error", F.lit("none"))
    )


_SPARSE_SQL = """texts AS (SELECT *, CASE event_type WHEN 'click' THEN '' WHEN 'view' THEN '[]'
  WHEN 'purchase' THEN CAST(user_id AS VARCHAR) WHEN 'error' THEN 'none' END AS txt FROM events)"""


@check(f"WITH {_SPARSE_SQL} SELECT event_id, CASE WHEN coalesce(txt, '') IN ('', '[]') THEN '无信息' ELSE txt END AS txt FROM texts")
def fn_check_string(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", text.check_string(_sparse_text()).alias("txt"))


@check(f"WITH {_SPARSE_SQL} SELECT event_id, coalesce(txt, '') = '' AS empty FROM texts")
def fn_is_empty(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", text.is_empty(_sparse_text()).alias("empty"))


@check(f"WITH {_SPARSE_SQL} SELECT event_id, CASE WHEN coalesce(txt, '') = '' THEN 0 ELSE TRY_CAST(txt AS INTEGER) END AS number FROM texts")
def fn_str_to_int(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", text.str_to_int(_sparse_text()).alias("number"))


@check("""SELECT p_partkey, CAST(3 AS INTEGER) AS n, p_brand AS second FROM part""")
def fn_split_cols(spark, sf_dir):
    parts = text.split_cols(F.concat_ws(",", "p_name", "p_brand", "p_type"))
    return load(spark, sf_dir, "part").select(
        "p_partkey", F.size(parts).alias("n"), F.get(parts, F.lit(1)).alias("second")
    )


@check("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END || CASE WHEN c_acctbal > 5000 THEN '' ELSE c_name END AS address
FROM customer""")
def fn_join_address(spark, sf_dir):
    scene, ground = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")), F.when(F.col("c_acctbal") <= 5000, F.col("c_name"))
    return load(spark, sf_dir, "customer").select("c_custkey", text.join_address(scene, ground).alias("address"))


@check("""SELECT c_custkey, CAST(CASE WHEN c_acctbal < 0 THEN 0 ELSE (40 + c_nationkey) * CAST(0.01 AS DECIMAL(3,2)) END AS DECIMAL(13,6)) AS fraction
FROM customer""")
def fn_percent_fraction(spark, sf_dir):
    rate = F.when(F.col("c_acctbal") < 0, F.lit("none")).otherwise((F.col("c_nationkey") + 40).cast("string"))
    return load(spark, sf_dir, "customer").select("c_custkey", money.fraction(rate).cast("decimal(13,6)").alias("fraction"))
