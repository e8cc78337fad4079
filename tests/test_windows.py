"""Windows against straightforward Python."""

import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import (
    apply_windows, arrival_positions, count_window, count_window_rest, late_rows, login_heat, mark_late, mark_late_by_source, on_time_rows,
    song_heat, tumbling_count,
)
from millrace.operators import marts, windows as windows_module


@pytest.fixture
def arrivals(rows):
    """2,000 rows in random order; a third shares one key, some have none."""
    rng = random.Random(5)
    data = [(i, rng.randrange(5000), rng.choice(["hot", None, "a", "b"]) if i % 3 else "hot", f"text {i}") for i in range(2000)]
    rng.shuffle(data)
    return data, rows(data, "id int, at int, k string, t string").repartition(11)


def ranked(data, keyed):
    groups = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[1], r[0])):
        groups[row[2] if keyed else 0].append(row[0])
    return groups


@pytest.mark.parametrize("keyed", [False, True])
def test_positions(arrivals, keyed):
    data, df = arrivals
    got = arrival_positions(df, ["at", "id"], ["k"] if keyed else [])
    want = {i: (n, len(ids)) for ids in ranked(data, keyed).values() for n, i in enumerate(ids)}
    assert {r["id"]: (r["_seq"], r["_total"]) for r in got.collect()} == want


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("n", [1, 7, 10, 2001])
def test_count_windows(arrivals, keyed, n):
    data, df = arrivals
    keys = ["k"] if keyed else []
    full, rest = {}, set()
    for ids in ranked(data, keyed).values():
        whole = len(ids) // n * n
        full.update({i: (p // n, p % n) for p, i in enumerate(ids[:whole])})
        rest.update(ids[whole:])
    assert {r["id"]: (r["window_no"], r["window_pos"]) for r in count_window(df, n, ["at", "id"], keys).collect()} == full
    assert {r["id"] for r in count_window_rest(df, n, ["at", "id"], keys).collect()} == rest


def test_positions_use_many_tasks(spark, arrivals):
    _, df = arrivals
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = arrival_positions(df, ["at", "id"])
        parts = placed.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_partitions_give_the_same_ranks(spark, arrivals):
    data, df = arrivals
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["id"]: r["_seq"] for r in arrival_positions(df, ["at", "id"], ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: n for ids in ranked(data, True).values() for n, i in enumerate(ids)}


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_apply_windows_sees_whole_windows_in_order(spark, arrivals, batch):
    data, df = arrivals
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)

    def summary(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.groupby("window_no", as_index=False, sort=False).agg(ids=("id", lambda x: ",".join(map(str, x))))

    got = apply_windows(count_window(df, 10, ["at", "id"]), summary, "window_no long, ids string")
    ids = ranked(data, False)[0]
    want = {n: ",".join(map(str, ids[n * 10:n * 10 + 10])) for n in range(len(ids) // 10)}
    rows = got.collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(rows) == len(want) and {r["window_no"]: r["ids"] for r in rows} == want


def brute_late(times, size, delay):
    late, peak = [], None
    for ms in times:
        end = ms // size * size + size
        late.append(peak is not None and end - 1 <= peak - delay)
        peak = ms if peak is None else max(peak, ms)
    return late


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_late_rows(spark, rows, coalesce):
    rng = random.Random(11)
    times = [max(0, n * 400 - rng.randrange(15000)) for n in range(3000)]
    df = rows([(n, ms) for n, ms in enumerate(times)], "n int, ms long").withColumn("ts", F.timestamp_millis("ms")).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        marked = {r["n"]: r["late"] for r in mark_late(df, "ts", ["n"], 5000, 3000).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = brute_late(times, 5000, 3000)
    assert [marked[n] for n in range(3000)] == want and 0 < sum(want) < 3000
    assert late_rows(df, "ts", ["n"], 5000, 3000).count() == sum(want)
    assert on_time_rows(df, "ts", ["n"], 5000, 3000).count() == 3000 - sum(want)


def test_window_edges_and_null_times(rows):
    df = rows([("a", 4999), ("a", 5000), ("a", 9999), ("b", 5000), (None, 5000), (None, 5001)], "k string, ms long")
    counted = tumbling_count(df.withColumn("ts", F.timestamp_millis("ms")), "ts", ["k"], counts=["n", "m"])
    got = sorted((str(r["k"]), r["window_start"][-8:], r["window_end"][-8:], r["n"], r["m"]) for r in counted.collect())
    assert got == [
        ("None", "00:00:05", "00:00:10", 2, 2), ("a", "00:00:00", "00:00:05", 1, 1), ("a", "00:00:05", "00:00:10", 2, 2),
        ("b", "00:00:05", "00:00:10", 1, 1),
    ]


def test_a_colon_in_a_name_does_not_shift_fields(rows):
    df = rows([("s", "a:b", "x:y", 0)], "songid string, songname string, singer_info string, time long")
    row = song_heat(df).first()
    assert (row["song_id"], row["song_name"], row["singer_name"], row["data_dt"]) == ("s", "a:b", "x:y", "1970-01-01")


def test_counting_combines_before_the_shuffle(rows):
    df = rows([("s", "n", "x", 0)], "songid string, songname string, singer_info string, time long")
    assert "partial_count" in song_heat(df)._jdf.queryExecution().executedPlan().toString()


def test_rollups_of_windows_are_daily_counts(rows):
    rng = random.Random(3)
    plays = [(str(rng.randrange(4)), "n", rng.choice("xy"), rng.randrange(3 * 86400000)) for _ in range(3000)]
    heat = song_heat(rows(plays, "songid string, songname string, singer_info string, time long"))
    songs, singers = Counter(), Counter()
    for song, _, singer, ms in plays:
        day = f"1970-01-0{ms // 86400000 + 1}"
        songs[day, song, singer] += 1
        singers[day, singer] += 1
    assert {(r["data_dt"], r["song_id"], r["singer_name"]): r["song_playtimes"] for r in marts.song_daily(heat).collect()} == songs
    assert {(r["data_dt"], r["singer_name"]): r["singer_playtimes"] for r in marts.singer_daily(heat).collect()} == singers


def test_login_keys_are_a_parameter(rows):
    df = rows(
        [("p", "c", "d", "1", "2", 0), ("p", "c", "d", "3", "4", 1)],
        "province string, city string, district string, lng string, lat string, login_dt long",
    )
    assert login_heat(df).count() == 2
    assert login_heat(df, keys=("province", "city", "district")).first()["login_times"] == 2


@pytest.mark.parametrize("idle,cells", [(None, 2_000_000), (None, 7), (6, 2_000_000), (40, 10)])
def test_late_rows_by_source(spark, rows, monkeypatch, idle, cells):
    """The least of the sources' greatest times, against a plain pass over the rows; more sources than some ranges hold."""
    rng = random.Random(idle or cells)
    monkeypatch.setattr(windows_module, "CELLS", cells)
    names = ["a", "b", None, "c"]
    data = [(n, rng.choice(names[: 2 + n // 80]), None if rng.random() < 0.03 else n * 300 + rng.randrange(-9000, 9000) + 100_000) for n in range(260)]
    want, peak, last, highest = [], {s: None for _, s, _ in data}, {}, None
    for n, source, ms in data:
        active = [peak[s] for s in peak if idle is None or n - last.get(s, -1) <= idle]
        combined = min(active) if active and None not in active else None
        if combined is not None and (highest is None or combined > highest):
            highest = combined
        seen = highest if idle else combined
        want.append(seen is not None and ms is not None and ms // 5000 * 5000 + 4999 <= seen - 2000)
        last[source] = n
        if ms is not None:
            peak[source] = max(ms, peak[source]) if peak[source] is not None else ms
    df = rows(data, "n int, source string, ms long").selectExpr("n", "source", "timestamp_millis(ms) AS ts").repartition(5)
    got = {r["n"]: r["late"] for r in mark_late_by_source(df, "ts", ["n"], "source", 5000, 2000, idle).collect()}
    assert [got[n] for n in range(260)] == want and 0 < sum(want) < 260
    assert mark_late_by_source(df.limit(0), "ts", ["n"], "source", 5000, 2000, idle).collect() == []
