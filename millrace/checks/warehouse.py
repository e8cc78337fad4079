"""Enriched facts, marts and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators import geo, lookup, marts
from .inputs import (
    GEO_SQL, LOGINS_SQL, PLAYS_SQL, REVENUE_SQL, SONGS_SQL, WIDE_SQL, contract_dim, location_dim, order_facts,
    point_index, song_dim,
)
from .logs import logins, plays
from .registry import check, load

_WIDE_PLAYS = f"""{PLAYS_SQL}, {SONGS_SQL},
plays_wide AS (
  SELECT p.*, CASE WHEN s.known THEN s.singer_info ELSE '{C.NO_INFO}' END AS singer_info,
         CASE WHEN s.known THEN s.name ELSE '{C.NO_INFO}' END AS name, CASE WHEN s.known THEN s.album ELSE '{C.NO_INFO}' END AS album,
         CASE WHEN s.known THEN s.post_time ELSE '{C.NO_INFO}' END AS post_time,
         CASE WHEN s.known THEN s.authorized_company ELSE '{C.NO_INFO}' END AS authorized_company
  FROM plays p LEFT JOIN songs s ON p.songid = s.source_id)"""
_WIDE_LOGINS = f"{LOGINS_SQL}, {GEO_SQL}"


def song_heat_sql(source: str, bucket: str) -> str:
    return f"""SELECT songid AS song_id, songname AS song_name, singer_info AS singer_name, count(*) AS song_playtimes,
       count(*) AS singer_playtimes, strftime(time_bucket(INTERVAL '{bucket}', at_ts), '%Y-%m-%d') AS data_dt,
       strftime(time_bucket(INTERVAL '{bucket}', at_ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL '{bucket}', at_ts) + INTERVAL '{bucket}', '%Y-%m-%d %H:%M:%S') AS window_end
FROM {source} GROUP BY songid, songname, singer_info, time_bucket(INTERVAL '{bucket}', at_ts)"""


def login_heat_sql(keys: str, bucket: str, source: str = "logins_wide") -> str:
    return f"""SELECT {keys}, count(*) AS login_times, strftime(time_bucket(INTERVAL '{bucket}', at_ts), '%Y-%m-%d') AS data_dt,
       strftime(time_bucket(INTERVAL '{bucket}', at_ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL '{bucket}', at_ts) + INTERVAL '{bucket}', '%Y-%m-%d %H:%M:%S') AS window_end
FROM {source} GROUP BY {keys}, time_bucket(INTERVAL '{bucket}', at_ts)"""


def wide_plays(spark: SparkSession, sf_dir: str, columns=("singer_info",)) -> DataFrame:
    return lookup.song_play_wide(plays(spark, sf_dir), song_dim(spark, sf_dir), columns)


def wide_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.reverse_geocode(logins(spark, sf_dir), point_index(spark, sf_dir))


def wide_orders(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return lookup.order_wide(
        order_facts(load(spark, sf_dir, "orders")), location_dim(spark, sf_dir), contract_dim(spark, sf_dir), **options
    )


@check(f"WITH {_WIDE_PLAYS} SELECT songid, songname, uid, mid, session_id, dur_time, play_time, time, singer_info FROM plays_wide")
def dws_song_play_wide(spark, sf_dir):
    wide = wide_plays(spark, sf_dir)
    return wide.select("songid", "songname", "uid", "mid", "session_id", "dur_time", "play_time", "time", "singer_info")


@check(f"WITH {_WIDE_PLAYS} SELECT session_id, songid, name, album, singer_info, post_time, authorized_company FROM plays_wide")
def dws_song_play_all_columns(spark, sf_dir):
    columns = ("name", "album", "singer_info", "post_time", "authorized_company")
    return wide_plays(spark, sf_dir, columns).select("session_id", "songid", *columns)


_ORDER_COLUMNS = ["id", "mid", "amount", "pkg_name", "bill_date", *C.LOCATION_COLUMNS, *C.CONTRACT_COLUMNS]


@check(f"WITH {WIDE_SQL} SELECT {', '.join(_ORDER_COLUMNS)} FROM wide")
def dws_order_wide(spark, sf_dir):
    return wide_orders(spark, sf_dir).select(_ORDER_COLUMNS)


@check(f"WITH {WIDE_SQL} SELECT {', '.join(_ORDER_COLUMNS)} FROM wide WHERE placed AND contracted")
def dws_order_wide_strict(spark, sf_dir):
    return wide_orders(spark, sf_dir, strict=True).select(_ORDER_COLUMNS)


@check(f"WITH {_WIDE_LOGINS} SELECT uid, mid, lng, lat, login_dt, province, city, district, address FROM logins_wide")
def geo_nearest(spark, sf_dir):
    return wide_logins(spark, sf_dir)


@check(f"WITH {_WIDE_LOGINS} SELECT uid, mid, lng, lat, login_dt, province, city, district, address FROM logins_wide")
def geo_nearest_large(spark, sf_dir):
    """The same as if no point table could be broadcast."""
    index = point_index(spark, sf_dir, broadcast_bytes=0, stored=True)
    return geo.reverse_geocode(logins(spark, sf_dir), index)


@check(f"WITH {_WIDE_PLAYS} {song_heat_sql('plays_wide', '1 hour')}")
def dm_song_hot(spark, sf_dir):
    return marts.song_heat(wide_plays(spark, sf_dir), size="1 hour")


@check(f"WITH {_WIDE_PLAYS} {song_heat_sql('plays_wide', '5 seconds')}")
def dm_song_hot_5s(spark, sf_dir):
    return marts.song_heat(wide_plays(spark, sf_dir))


@check(f"WITH {_WIDE_LOGINS} {login_heat_sql('province, city, district, lng, lat', '1 hour')}")
def dm_login_loc(spark, sf_dir):
    return marts.login_heat(wide_logins(spark, sf_dir), size="1 hour")


@check(f"WITH {_WIDE_LOGINS} {login_heat_sql('province, city, district', '10 seconds')}")
def dm_login_region_10s(spark, sf_dir):
    return marts.login_heat(
        wide_logins(spark, sf_dir), keys=("province", "city", "district"), size="10 seconds", delay="5 seconds"
    )


_REVENUE_COLUMNS = "province, city, address, mid, machine_name, pkg_name, amount, inv_rev, age_rev, com_rev, par_rev"


@check(f"WITH {REVENUE_SQL} SELECT {_REVENUE_COLUMNS}, data_dt FROM revenue")
def dm_order_revenue(spark, sf_dir):
    return marts.order_revenue(wide_orders(spark, sf_dir))


@check(f"WITH {REVENUE_SQL} SELECT {_REVENUE_COLUMNS}, action_dt AS data_dt FROM revenue")
def dm_order_revenue_by_action_time(spark, sf_dir):
    return marts.order_revenue(wide_orders(spark, sf_dir), dt_from="action_time")


@check(f"""WITH {REVENUE_SQL}
SELECT province, city, {', '.join(f'CAST(sum({m}) AS DECIMAL(18,2)) AS {m}' for m in ('amount', 'inv_rev', 'age_rev', 'com_rev', 'par_rev'))}
FROM revenue GROUP BY province, city""")
def revenue_by_region(spark, sf_dir):
    return marts.revenue_by_region(marts.order_revenue(wide_orders(spark, sf_dir)))


@check(f"""WITH {_WIDE_PLAYS}
SELECT strftime(at_ts, '%Y-%m-%d') AS data_dt, songid AS song_id, songname AS song_name, singer_info AS singer_name,
       count(*) AS song_playtimes, count(*) AS singer_playtimes FROM plays_wide GROUP BY ALL""")
def rollup_song_daily(spark, sf_dir):
    return marts.song_daily(marts.song_heat(wide_plays(spark, sf_dir), size="1 hour"))


@check(f"""WITH {_WIDE_PLAYS}
SELECT strftime(at_ts, '%Y-%m-%d') AS data_dt, singer_info AS singer_name, count(*) AS singer_playtimes
FROM plays_wide GROUP BY ALL""")
def rollup_singer_daily(spark, sf_dir):
    return marts.singer_daily(marts.song_heat(wide_plays(spark, sf_dir), size="1 hour"))


@check(f"""WITH {_WIDE_LOGINS}
SELECT strftime(at_ts, '%Y-%m-%d') AS data_dt, province, city, district, lng, lat, count(*) AS login_times
FROM logins_wide GROUP BY ALL""")
def rollup_login_daily(spark, sf_dir):
    return marts.login_daily(marts.login_heat(wide_logins(spark, sf_dir), size="1 hour"))
