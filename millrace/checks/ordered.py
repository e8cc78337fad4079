"""Row-count windows and late rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..operators import enrich_rows, windows
from .registry import check, load

_ORDER = ["ts", "event_id"]


def _events(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value"
    )


def _ranked(partition: str) -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER ({partition} ORDER BY ts, event_id) - 1 AS seq, count(*) OVER ({partition}) AS total FROM events)"""


@check(f"""WITH {_ranked('')}
SELECT event_id, seq // 10 AS window_no, CAST(seq % 10 AS INTEGER) AS window_pos FROM ranked WHERE (seq // 10 + 1) * 10 <= total""")
def count_window_full(spark, sf_dir):
    return windows.count_window(_events(spark, sf_dir), 10, _ORDER).select("event_id", "window_no", "window_pos")


@check(f"""WITH {_ranked('PARTITION BY event_type')}
SELECT event_type, event_id, seq // 3 AS window_no, CAST(seq % 3 AS INTEGER) AS window_pos
FROM ranked WHERE (seq // 3 + 1) * 3 <= total""")
def count_window_keyed(spark, sf_dir):
    found = windows.count_window(_events(spark, sf_dir), 3, _ORDER, ["event_type"])
    return found.select("event_type", "event_id", "window_no", "window_pos")


@check(f"""WITH {_ranked('PARTITION BY event_type')}
SELECT event_type, event_id FROM ranked WHERE seq >= total - total % 10""")
def count_window_left_over(spark, sf_dir):
    return windows.count_window_rest(_events(spark, sf_dir), 10, _ORDER, ["event_type"]).select("event_type", "event_id")


def _gaps(windows_: pd.DataFrame) -> pd.DataFrame:
    """Every row with its window's first event and the rank of its value in the window."""
    by_window = windows_.groupby("window_no")
    return pd.DataFrame({
        "window_no": windows_["window_no"], "event_id": windows_["event_id"],
        "first_event": by_window["event_id"].transform("first"),
        "value_rank": by_window["value"].rank(method="min").astype("int64"),
    })


@check(f"""WITH {_ranked('')}
SELECT seq // 10 AS window_no, event_id, first_value(event_id) OVER (PARTITION BY seq // 10 ORDER BY seq) AS first_event,
       rank() OVER (PARTITION BY seq // 10 ORDER BY value) AS value_rank
FROM ranked WHERE (seq // 10 + 1) * 10 <= total""")
def count_window_apply(spark, sf_dir):
    full = windows.count_window(_events(spark, sf_dir), 10, _ORDER).select("window_no", "window_pos", "event_id", "value")
    return windows.apply_windows(full, _gaps, "window_no long, event_id long, first_event long, value_rank long")


@check("""WITH arrived AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ms, (epoch_us(ts) // 1000) + (event_id * 7919 % 10) * 3600000 AS arrival FROM events),
seen AS (
  SELECT *, max(ms) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM arrived)
SELECT event_id, ms, coalesce((ms // 3600000 + 1) * 3600000 - 1 <= before - 10800000, false) AS late FROM seen""")
def late_data_drop(spark, sf_dir):
    ms = F.unix_millis("ts")
    arrived = _events(spark, sf_dir).select(
        "event_id", "ts", ms.alias("ms"), (ms + F.pmod(F.col("event_id") * 7919, F.lit(10)) * 3600000).alias("arrival")
    )
    return windows.mark_late(arrived, "ts", ["arrival", "event_id"], 3600000, 10800000).select("event_id", "ms", "late")


_SOURCES = 4
_BY_SOURCE = ", ".join(
    f"max(CASE WHEN user_id % {_SOURCES} = {k} THEN ms END) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m{k}"
    for k in range(_SOURCES))
_NAMES = [f"m{k}" for k in range(_SOURCES)]


@check(f"""WITH arrived AS (
  SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms,
    (epoch_us(ts) // 1000) + (event_id * 7919 % 10 + user_id % {_SOURCES} * 20) * 3600000 AS arrival FROM events),
seen AS (SELECT *, {_BY_SOURCE} FROM arrived)
SELECT event_id, ms, CASE WHEN {" OR ".join(n + " IS NULL" for n in _NAMES)} THEN false
  ELSE (ms // 3600000 + 1) * 3600000 - 1 <= least({", ".join(_NAMES)}) - 3600000 END AS late FROM seen""")
def late_data_by_partition(spark, sf_dir):
    """Four source partitions, each 20 hours behind the one before: the slowest one says what is late."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    behind = F.pmod(F.col("event_id") * 7919, F.lit(10)) + F.pmod(F.col("user_id"), F.lit(_SOURCES)) * 20
    arrived = load(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), ms.alias("ms"), (ms + behind * 3600000).alias("arrival"), F.pmod(F.col("user_id"), F.lit(_SOURCES)).alias("source")
    )
    marked = windows.mark_late_by_source(arrived, "ts", ["arrival", "event_id"], "source", 3600000, 3600000)
    return marked.select("event_id", "ms", "late")


def _grade(frame: pd.DataFrame, edges: list[float]) -> pd.DataFrame:
    grades = pd.Series(edges).searchsorted(frame["value"], side="right")
    return pd.DataFrame({"event_id": frame["event_id"], "grade": grades.astype("int64")})


@check("""SELECT event_id, CAST((value >= 10)::INT + (value >= 20)::INT + (value >= 40)::INT AS BIGINT) AS grade FROM events""")
def enrich_with_resource(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "value")
    return enrich_rows(events, _grade, "event_id long, grade long", open_resource=lambda: [10.0, 20.0, 40.0])
