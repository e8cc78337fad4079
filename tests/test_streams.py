"""Jobs, snapshots and sinks over several micro-batches, with replays."""

import json
import random

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.checks import ORACLES, QUERIES, streams
from millrace.fs import SharedFiles
from millrace.operators import PointIndex, cdc
from millrace.plans import jobs
from millrace.session import materialize, scratch_path, scratch_root
from millrace.sources.config import ConfigHistory, config_from_jdbc, config_from_parquet, config_from_rows, jdbc_options
from millrace.sources.marts import ConsoleMarts, JdbcMarts, ParquetMarts
from millrace.sources.offsets import GroupOffsets
from millrace.sources.topics import ConsoleTopics, FolderTopics, KafkaTopics
from millrace.streaming.counts import CountWindowStream
from millrace.streaming import log as log_module
from millrace.streaming.dimensions import DimensionStore, _twin, bucket_of
from millrace.streaming.log import CommitLog, ConcurrentWrite, LostFiles
from millrace.streaming.rollups import SummedMart
from millrace.streaming.once import read_committed, write_batch_once


@pytest.fixture
def topic(spark, tmp_path):
    """A topic that is filled file by file, so that each file is one micro-batch."""
    folder, topics = tmp_path / "in", FolderTopics(str(tmp_path), max_files_per_trigger=1)
    count = iter(range(1000))

    def put(*values, name="in"):
        texts = [(None, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False), name) for v in values]
        df = spark.createDataFrame(texts, C.RECORD_SCHEMA).coalesce(1)
        df.write.partitionBy("topic").parquet(str(folder / f"batch={next(count)}"))

    put.stream = lambda: topics.read_stream(spark, "in")
    return put


def values(df):
    return sorted((json.loads(r["value"]) for r in df.collect()), key=lambda d: json.dumps(d, sort_keys=True))


# ---------------------------------------------------------------- writing once


def test_a_batch_is_written_once(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_batch_once(spark.range(3), path, 0)
    assert not write_batch_once(spark.range(99), path, 0)
    assert write_batch_once(spark.range(2), path, 1)
    assert spark.read.parquet(path).groupBy("batch").count().orderBy("batch").collect() == [(0, 3), (1, 2)]


def test_left_over_staging_files_do_not_count(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.range(50).write.parquet(f"{path}/_staging/0")  # what a failed attempt leaves
    assert write_batch_once(spark.range(3), path, 0)
    assert spark.read.parquet(path).count() == 3


def test_scratch_lies_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert base is None or scratch_root(spark).startswith(base.rstrip("/"))
    stored = materialize(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert stored.count() == 5 and stored.columns == ["id", "x"]


# ---------------------------------------------------------------- dimension snapshots

SONGS = ("source_id", "source_id,name")


def songs(rows, *changes):
    data = [(json.dumps({"source_id": k, "name": n}), "update", C.DIM_SONG, ts, 1, 0) for k, n, ts in changes]
    return rows(data, "data string, type string, phoenix_tbl_name string, ts long, xid long, xoffset long")


def stored(store):
    return {r["source_id"]: r["name"] for r in store.read(C.DIM_SONG).collect()}


def test_snapshots(spark, rows, tmp_path):
    store = DimensionStore(spark, str(tmp_path), keep_seconds=0, delta_files=1)
    assert store.read(C.DIM_SONG, ["source_id", "name"]).count() == 0 and store.is_small(C.DIM_SONG)
    store.upsert(songs(rows, ("a", "1", 1), ("a", "2", 2), ("b", "1", 1)), C.DIM_SONG, *SONGS, 0)
    assert stored(store) == {"a": "2", "b": "1"}
    # The last arrival wins, also with an earlier change time.
    assert store.upsert(songs(rows, ("b", "9", 0), ("c", None, 5)), C.DIM_SONG, *SONGS, 1)
    assert stored(store) == {"a": "2", "b": "9", "c": None}
    assert not store.upsert(songs(rows, ("a", "wrong", 99)), C.DIM_SONG, *SONGS, 1)
    assert stored(store) == {"a": "2", "b": "9", "c": None}
    store.upsert(songs(rows, ("d", "1", 1)), C.DIM_SONG, *SONGS, 5)
    # Version 3 merged the two deltas with the first base; what it replaced goes with the next batch.
    assert store.state(C.DIM_SONG)["base"] == {"0": [3, *store.state(C.DIM_SONG)["base"]["0"][1:]]} and len(stored(store)) == 4
    store.upsert(songs(rows, ("e", "1", 1)), C.DIM_SONG, *SONGS, 6)
    assert store.versions(C.DIM_SONG) == [3, 4] and len(stored(store)) == 5


def test_a_new_checkpoint_appends(spark, rows, tmp_path):
    """Batch ids begin anew with a new checkpoint; nothing may be taken for a replay then."""
    path = str(tmp_path / "out")
    assert write_batch_once(spark.range(3), path, 7, job="old")
    assert write_batch_once(spark.range(10), path, 0, job="new") and not write_batch_once(spark.range(9), path, 0, job="new")
    assert not write_batch_once(spark.range(9), path, 7, job="old")
    assert spark.read.parquet(path).count() == 13
    store = DimensionStore(spark, str(tmp_path / "dims"), keep_seconds=0)
    for batch in (41, 42):
        assert store.upsert(songs(rows, ("a", str(batch), 1)), C.DIM_SONG, *SONGS, batch, job="old")
    assert store.upsert(songs(rows, ("b", "new", 1)), C.DIM_SONG, *SONGS, 0, job="new")
    assert stored(store) == {"a": "42", "b": "new"}


def test_a_batch_counts_with_its_entry(spark, tmp_path):
    path, schema = str(tmp_path / "out"), spark.range(1).schema
    write_batch_once(spark.range(3), path, 0)
    spark.range(4).write.parquet(f"{path}/batch=1")  # what a crash leaves
    assert read_committed(spark, path, schema).count() == 3
    assert write_batch_once(spark.range(5).repartition(2), path, 1)
    assert read_committed(spark, path, schema).count() == 8


def test_a_lost_file_is_an_error_that_only_the_batchs_own_replay_mends(spark, tmp_path):
    path, schema = str(tmp_path / "out"), spark.range(1).schema
    write_batch_once(spark.range(3), path, 0, job="a")
    write_batch_once(spark.range(5).repartition(2), path, 1, job="a")
    (next((tmp_path / "out" / "batch=1").glob("part-*.parquet"))).unlink()
    with pytest.raises(LostFiles):
        read_committed(spark, path, schema)
    assert write_batch_once(spark.range(2), path, 0, job="b")  # another job goes on, and takes nothing away
    with pytest.raises(LostFiles):
        read_committed(spark, path, schema)
    assert write_batch_once(spark.range(5), path, 1, job="a")
    assert read_committed(spark, path, schema).count() == 10 and not (tmp_path / "out" / "batch=1").exists()
    assert not write_batch_once(spark.range(5), path, 1, job="a")


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """Both see the same newest version; each gets a version of its own."""
    path, schema = str(tmp_path / "out"), spark.range(1).schema
    write_batch_once(spark.range(1), path, 0, job="a")
    seen = CommitLog(spark, path).state()
    assert write_batch_once(spark.range(10), path, 1, job="a")
    monkeypatch.setattr(CommitLog, "state", lambda self: json.loads(json.dumps(seen)))
    assert write_batch_once(spark.range(100), path, 0, job="b")
    monkeypatch.undo()
    assert read_committed(spark, path, schema).count() == 111
    # One that claimed a version and stopped leaves a gap, which its replay fills.
    assert CommitLog(spark, path).claim(CommitLog(spark, path).state(), "c", 7) == 3
    assert write_batch_once(spark.range(1000), path, 1, job="b") and read_committed(spark, path, schema).count() == 1111
    assert write_batch_once(spark.range(10000), path, 7, job="c") and read_committed(spark, path, schema).count() == 11111
    assert CommitLog(spark, path).state()["ranges"] == [[0, 4]]


class Counted(SharedFiles):
    """Counts what is opened and listed."""

    calls: list = []

    def read_text(self, path):
        Counted.calls.append(path)
        return super().read_text(path)

    def names(self, path):
        found = super().names(path)
        Counted.calls.extend([path] * (1 + len(found)))
        return found


def test_the_log_costs_the_same_at_any_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log_module, "SharedFiles", Counted)
    log, costs = CommitLog(spark, str(tmp_path), every=4), []
    for number in range(60):
        Counted.calls = []
        version = log.claim(log.state(), "job", number)
        log.publish(version, {"job": "job", "batch": number, "files": {"a": 1, "b": 2}, "drops": [[number - 1, 2]] if number % 10 == 5 else []})
        costs.append(len(Counted.calls))
    assert max(costs[40:]) <= max(costs[8:24]) and max(costs) < 30
    state = CommitLog(spark, str(tmp_path), every=4).state()
    gone = [k - 1 for k in range(60) if k % 10 == 5]
    assert [v for a, b in state["ranges"] for v in range(a, b + 1)] == [v for v in range(60) if v not in gone]
    assert state["files"] == 2 * (60 - len(gone)) and state["jobs"] == {"job": [59, 59]}
    # The entries alone tell the same.
    for head in (tmp_path / "_log" / "heads").iterdir():
        head.unlink()
    assert CommitLog(spark, str(tmp_path), every=4).state() == state


def test_stored_columns_survive_a_narrower_configuration(spark, rows, tmp_path):
    store = DimensionStore(spark, str(tmp_path))
    store.upsert(songs(rows, ("a", "1", 1), ("b", "2", 1)), C.DIM_SONG, *SONGS, 0)
    store.upsert(songs(rows, ("a", "ignored", 2), ("c", "ignored", 2)), C.DIM_SONG, "source_id", "source_id", 1)
    assert stored(store) == {"a": "1", "b": "2", "c": None}


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())


def test_an_upsert_writes_its_own_rows(spark, tmp_path):
    """A thousand keys into many: under a hundredth of the table is written, and nothing of it is read."""
    store = DimensionStore(spark, str(tmp_path), bucket_bytes=12_000_000, keep_seconds=0)
    many = spark.range(1_000_000).select(F.col("id").cast("string").alias("source_id"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    store.put(many, C.DIM_SONG, "source_id")
    before = store.read(C.DIM_SONG)
    state, total = store.state(C.DIM_SONG), size_of(tmp_path / C.DIM_SONG)
    assert state["facts"]["count"] > 8 and len(state["base"]) == state["facts"]["count"]
    some = spark.range(0, 2_000_000, 2000).select(F.col("id").cast("string").alias("source_id"), F.lit("new").alias("name"))
    store.put(some, C.DIM_SONG, "source_id", 1)
    assert size_of(tmp_path / C.DIM_SONG) - total < total / 100
    now = store.read(C.DIM_SONG)
    assert now.count() == now.select("source_id").distinct().count() == 1_000_500 and now.filter("name = 'new'").count() == 1000
    assert before.count() == 1_000_000 and before.filter("name = 'new'").count() == 0  # a reader of the version before
    # The base is not shuffled to be merged with a few changes.
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_merging_and_splitting_against_a_plain_table(spark, rows, tmp_path):
    """Random batches with narrow and wide rows, replays and new columns, in a store that merges and splits often."""
    rng, want, counts = random.Random(3), {}, []
    store = DimensionStore(spark, str(tmp_path), keep_seconds=0, bucket_bytes=2_500, delta_bytes=1_500, delta_share=0.3, delta_files=2)
    for batch in range(12):
        columns = [["name"], ["name", "album"], ["album", "note"]][rng.randrange(3)]
        given = {f"k{rng.randrange(40 * (batch + 1))}": [rng.choice(["x", "y", None, f"v{batch}"]) for _ in columns] for _ in range(30)}
        frame = rows([(k, *v) for k, v in given.items()], "source_id string, " + ", ".join(f"{c} string" for c in columns))
        assert store.put(frame, C.DIM_SONG, "source_id", batch) and not store.put(frame.limit(1), C.DIM_SONG, "source_id", batch)
        for key, values in given.items():
            want.setdefault(key, {}).update(zip(columns, values))
        state = store.state(C.DIM_SONG)
        counts.append(state["facts"]["count"])
        assert all(len(p) <= 2 for p in state["deltas"].values()) and all(int(b) < state["facts"]["count"] for b in (*state["base"], *state["deltas"]))
    got = {r["source_id"]: r.asDict() for r in store.read(C.DIM_SONG).collect()}
    names = store.state(C.DIM_SONG)["facts"]["columns"]
    assert set(names) == {"source_id", "name", "album", "note"}
    assert got == {k: {"source_id": k, **{c: v.get(c) for c in ("name", "album", "note")}} for k, v in want.items()}
    assert counts[-1] > 2 and counts == sorted(counts)
    there = {int(f.name.removeprefix("batch=")) for f in (tmp_path / C.DIM_SONG).glob("batch=*")}
    assert there == set(store.versions(C.DIM_SONG))  # nothing else is left


def test_small_buckets_share_files(spark, tmp_path):
    """Hundreds of buckets lie in two files, and one of them is still merged alone."""
    options = {"keep_seconds": 0, "delta_bytes": 10 ** 9, "delta_files": 1}
    small, large = (DimensionStore(spark, str(tmp_path), bucket_bytes=n, **options) for n in (40_000, 16_000_000))
    many = spark.range(120_000).select(F.col("id").cast("string").alias("source_id"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    small.put(many, C.DIM_SONG, "source_id")
    files = lambda: list((tmp_path / C.DIM_SONG).glob("batch=*/bucket=*/part-*.parquet"))
    state = small.state(C.DIM_SONG)
    count = state["facts"]["count"]
    assert 209 < count == len(state["base"]) and len(files()) == 2
    sizes, written = [p[1] for p in state["base"].values()], sum(f.stat().st_size for f in files())
    assert written - count < sum(sizes) <= written and max(sizes) < 3 * min(sizes)
    some = lambda n: spark.createDataFrame([("7", f"new {n}"), ("8", None), (f"key {n}", "x")], "source_id string, name string")
    # Small files and files of one bucket each lie side by side; then the buckets with two deltas are merged, and nothing else.
    small.put(some(1), C.DIM_SONG, "source_id", 1)
    assert len(files()) <= 4
    large.put(some(2), C.DIM_SONG, "source_id", 2)
    state = small.state(C.DIM_SONG)
    moved = {b for b, part in state["base"].items() if part[0] != 0}
    assert 1 <= len(moved) <= 2 and len(state["base"]) == count and not moved & {b for b, p in state["deltas"].items() if p}
    for store in (small, large):
        got = store.read(C.DIM_SONG)
        assert got.count() == got.select("source_id").distinct().count() == 120_002
        assert {tuple(r) for r in got.join(many, ["source_id", "name"], "left_anti").collect()} == {("7", "new 2"), ("8", None), ("key 1", "x"), ("key 2", "x")}
    next((tmp_path / C.DIM_SONG).glob("batch=0/bucket=0/part-*.parquet")).unlink()
    with pytest.raises(LostFiles):
        small.read(C.DIM_SONG)


def test_rows_find_the_bucket_they_were_written_to(spark):
    """A split moves rows of one bucket only, and into its twin."""
    hashed = spark.range(500).select(F.xxhash64("id").alias("h"))
    for count in range(1, 20):
        for old, new in hashed.select(bucket_of(F.col("h"), count), bucket_of(F.col("h"), count + 1)).collect():
            assert 0 <= old < count and new in (old, count) and (new == old or old == _twin(count))


def test_a_writer_that_was_given_up_fails(spark, rows, tmp_path):
    store = DimensionStore(spark, str(tmp_path))
    store.upsert(songs(rows, ("a", "1", 1)), C.DIM_SONG, *SONGS, 0, job="old")
    log = store.parts(C.DIM_SONG).log()
    slow = log.claim(log.state(), "old", 1, alone=True)
    assert store.upsert(songs(rows, ("a", "2", 1)), C.DIM_SONG, *SONGS, 0, job="new")
    with pytest.raises(ConcurrentWrite):
        log.publish(slow, {"job": "old", "batch": 1})
    assert stored(store) == {"a": "2"}
    next((tmp_path / C.DIM_SONG).glob("batch=*/bucket=*/part-*.parquet")).unlink()
    with pytest.raises(LostFiles):
        store.read(C.DIM_SONG)


def test_batches_leave_no_scratch(spark, rows, tmp_path, monkeypatch):
    from millrace import session

    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "scratch"))
    DimensionStore(spark, str(tmp_path / "dims")).upsert(songs(rows, ("a", "1", 1)), C.DIM_SONG, *SONGS, 0)
    CountWindowStream(spark, str(tmp_path / "w"), 2, ["n"])(rows([(k,) for k in range(5)], "n int"), 0)
    assert (tmp_path / "scratch").exists() and not list((tmp_path / "scratch").iterdir())


def test_a_snapshot_gains_a_configured_column(spark, rows, tmp_path):
    store = DimensionStore(spark, str(tmp_path))
    store.upsert(songs(rows, ("a", "1", 1)), C.DIM_SONG, "source_id", "source_id", 0)
    store.upsert(songs(rows, ("b", "2", 1)), C.DIM_SONG, "source_id", "source_id,name", 1)
    assert stored(store) == {"a": None, "b": "2"}


# ---------------------------------------------------------------- summed marts, kept configuration, group offsets


def test_a_summed_mart_against_its_rows(spark, rows, tmp_path):
    """Dates come and go over the batches; some are summed up on the way, and a replay adds nothing."""
    rng, want = random.Random(8), {}
    mart = SummedMart(spark, str(tmp_path / "mart"), ["song"], ["n", "m"], keep_seconds=0, delta_files=2)
    with pytest.raises(ValueError):
        mart.read()
    for batch in range(7):
        data = [(rng.choice(["2024-01-01", "2024-01-02", f"day {batch}", None]), rng.choice(["a", "b", None]), rng.randrange(9), None if rng.random() < 0.1 else 1)
                for _ in range(25)]
        frame = rows(data, "data_dt string, song string, n long, m int").repartition(3)
        assert mart.write_batch(frame, batch) and not mart.write_batch(frame, batch)
        for day, song, n, m in data:
            held = want.setdefault((day, song), [0, None])
            held[0] += n
            held[1] = held[1] if m is None else m + (held[1] or 0)
        assert all(len(p) <= 2 for p in mart.parts.state()["deltas"].values())
    assert {(r["data_dt"], r["song"]): [r["n"], r["m"]] for r in mart.read().collect()} == want
    touched = {f.name for f in (tmp_path / "mart" / f"batch={max(mart.parts.versions())}").glob("data_dt=*")}
    assert touched and "data_dt=day 0" not in touched
    assert {int(f.name.removeprefix("batch=")) for f in (tmp_path / "mart").glob("batch=*")} == set(mart.parts.versions())


def test_configuration_is_kept(spark, rows, tmp_path):
    history = ConfigHistory(str(tmp_path / "history"))

    def at(batch, *table, job="j"):
        found = history.at(rows([(n, "db", "dim", "id", "id", "T", topic) for n, topic in table], C.CONFIG_SCHEMA), batch, job=job)
        return sorted((r["tbl_name"], r["sink_topic"]) for r in found.collect())

    assert at(0) == []
    assert at(1, ("a", "x"), ("b", "y")) == [("a", "x"), ("b", "y")]
    assert at(2, ("b", "z")) == [("a", "x"), ("b", "z")]  # a row that left stays, a changed one changes
    assert at(2, ("b", "changed since"), ("c", "new")) == [("a", "x"), ("b", "z")]  # a replay meets what the batch met
    assert at(3, ("a", "x"), ("b", "z")) == [("a", "x"), ("b", "z")]
    assert at(4, ("b", "y"), ("b", "w")) == [("a", "x"), ("b", "y")]  # two rows for one table: the same one on every run
    assert at(0, ("c", "n"), job="new checkpoint") == [("a", "x"), ("b", "y"), ("c", "n")]
    with pytest.raises(ValueError):
        at(2, job="j")


def test_a_new_checkpoint_starts_where_the_group_is(spark, rows, tmp_path):
    inner, out, group = FolderTopics(str(tmp_path / "in")), FolderTopics(str(tmp_path / "out")), GroupOffsets(str(tmp_path / "groups"), "g")

    def put(batch, *texts):
        inner.write_batch(rows([(None, t, "log") for t in texts], C.RECORD_SCHEMA), "log", batch)

    def run(name):
        source = inner.read_stream(spark, "log", group=group)
        jobs.user_log_to_dwd(source, out, str(tmp_path / name), group=group, name="r").awaitTermination()
        return out.read(spark, "malformed", "r").count()

    assert group.positions(spark) == {} and group.starting(spark, "log") is None
    put(0, "one")
    put(1, "two", "three")
    assert run("c1") == 3 and group.positions(spark) == {"log": {0: 2}}
    put(2, "four")
    assert run("c2") == 4  # a new checkpoint takes only what is new
    assert run("c1") == 4  # nor does the old one do again what the group has done
    assert run("c3") == 4
    assert group.starting(spark, "log") == '{"log": {"0": 3}}'
    kafka = rows([("t", 0, 7), ("t", 1, 3), ("t", 0, 9)], "topic string, partition int, offset long")
    assert group.commit(kafka, 50) and group.starting(spark, "t") == '{"t": {"0": 10, "1": 4}}'
    assert KafkaTopics("h").source_options("t", group.starting(spark, "t"))["startingOffsets"] == '{"t": {"0": 10, "1": 4}}'


# ---------------------------------------------------------------- count windows over a stream


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_count_windows_run_across_batches(spark, rows, tmp_path, keys):
    work = CountWindowStream(spark, str(tmp_path), 4, ["n"], keys)
    data = [(n, "ab"[n % 3 == 0]) for n in range(31)]
    bounds = [0, 3, 3, 11, 24, 31]
    for batch_id, (start, end) in enumerate(zip(bounds, bounds[1:])):
        batch = rows(data[start:end], "n int, k string")
        work(batch, batch_id)
        work(batch, batch_id)  # a replay
    got = {}
    for r in work.windows().orderBy("batch", "window_no", "window_pos").collect():
        got.setdefault(r["k"] if keys else 0, []).append(r["n"])
    groups = {}
    for n, k in data:
        groups.setdefault(k if keys else 0, []).append(n)
    assert got == {k: ns[: len(ns) // 4 * 4] for k, ns in groups.items()}


# ---------------------------------------------------------------- jobs

CONFIG = [
    ("orders", "db", "fact", "id", "id", "", C.DWD_ORDER),
    ("song", "db", "dim", "source_id", "source_id,name,singer_info", C.DIM_SONG, C.DWD_DIM),
    ("local", "db", "dim", "mid", "mid,province,city,address", C.DIM_MACHINE_LOCAL, C.DWD_DIM),
]


def change(table, data, kind="insert", ts=1, xid=1):
    return {"database": "db", "table": table, "type": kind, "ts": ts, "xid": xid, "xoffset": 0, "data": data}


def test_log_to_heat(spark, rows, topic, tmp_path):
    """Play path end to end: router, song lookup with a dimension that the change path fills, heat."""
    out, store, mart = FolderTopics(str(tmp_path / "out")), DimensionStore(spark, str(tmp_path / "dims")), ParquetMarts(str(tmp_path / "mart"))

    def play(song, ms):
        return {"event_type": C.PLAY_EVENT, "event_content": {"songid": song, "songname": f"n{song}", "uid": 1, "time": ms}}

    topic(play("s1", 1000), play("s1", 4999), {"event_type": C.LOGIN_EVENT, "mid": 5}, "broken")
    topic(play("s1", 5000), play("s2", 2000), change("song", {}))
    topic(play("s1", 60000))
    jobs.user_log_to_dwd(topic.stream(), out, str(tmp_path / "c1")).awaitTermination()
    assert out.read(spark, C.DWD_PLAY, "dwd_user_log").count() == 5
    assert [r["key"] for r in out.read(spark, C.DWD_LOGIN, "dwd_user_log").collect()] == ["5"]
    assert out.read(spark, "malformed", "dwd_user_log").count() == 1

    store.upsert(
        cdc.classify(cdc.parse_changes(rows([(json.dumps(change("song", {"source_id": "s1", "singer_info": '[{"name":"甲"}]'})),)], "value string")), rows(CONFIG, C.CONFIG_SCHEMA)),
        C.DIM_SONG, "source_id", "source_id,name,singer_info", 0,
    )
    jobs.song_play_wide(out.read_stream(spark, C.DWD_PLAY, "dwd_user_log"), store, out, str(tmp_path / "c2")).awaitTermination()
    jobs.song_hot(out.read_stream(spark, C.DWS_PLAY, "dws_song_play"), mart, str(tmp_path / "c3")).awaitTermination()
    got = sorted(tuple(r) for r in mart.read(spark, C.MART_SONG_HOT).select("song_id", "singer_name", "song_playtimes", "data_dt").collect())
    # The window of the last play stays open.
    assert got == [("s1", "甲", 1, "1970-01-01"), ("s1", "甲", 2, "1970-01-01"), ("s2", C.NO_INFO, 1, "1970-01-01")]


def test_changes_to_dimensions_and_facts(spark, topic, tmp_path):
    out, store = FolderTopics(str(tmp_path / "out")), DimensionStore(spark, str(tmp_path / "dims"))
    config = str(tmp_path / "config")
    spark.createDataFrame(CONFIG[:2], C.CONFIG_SCHEMA).write.parquet(config)
    topic(change("song", {"source_id": "a", "name": "1", "singer_info": "[]"}), change("orders", {"id": 1}, ts=7), change("local", {"mid": "m"}))
    jobs.cdc_to_dwd(topic.stream(), config_from_parquet(config), out, str(tmp_path / "c1")).awaitTermination()
    spark.createDataFrame(CONFIG[2:], C.CONFIG_SCHEMA).write.mode("append").parquet(config)
    topic(change("song", {"source_id": "a", "name": "2"}, "update", 2), change("song", {"source_id": "b", "name": "x"}, "delete"))
    topic(change("local", {"mid": "m", "province": C.NO_INFO, "city": C.NO_INFO, "address": "湖南省长沙市"}), change("orders", {"id": 2}, "delete"))
    jobs.cdc_to_dwd(topic.stream(), config_from_parquet(config), out, str(tmp_path / "c1")).awaitTermination()
    assert values(out.read(spark, C.DWD_ORDER, "dwd_changes")) == [{"id": 1, "ts": "7"}, {"id": 2, "ts": "1"}]

    for _ in range(2):  # the second run finds nothing new
        jobs.dim_upsert(out.read_stream(spark, C.DWD_DIM, "dwd_changes"), store, str(tmp_path / "c2")).awaitTermination()
    assert [tuple(r) for r in store.read(C.DIM_SONG).collect()] == [("a", "2", C.UNKNOWN_SINGER)]
    assert [tuple(r) for r in store.read(C.DIM_MACHINE_LOCAL).collect()] == [("m", "湖南", "长沙", "湖南省长沙市")]


def test_two_column_lists_in_one_batch(spark, topic, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "dims"))

    def record(key, cols, ts, **data):
        return {**change("song", {"source_id": key, **data}, "update", ts), "pk_col": "source_id", "cols": cols, "phoenix_tbl_name": C.DIM_SONG}

    topic(record("a", "source_id,name", 1, name="1", album="no"), record("a", "source_id,album", 2, name="no", album="《x》"), record("b", "source_id,name", 1, name="2"))
    jobs.dim_upsert(topic.stream(), store, str(tmp_path / "c")).awaitTermination()
    assert {r["source_id"]: (r["name"], r["album"]) for r in store.read(C.DIM_SONG).collect()} == {"a": ("1", "《x》"), "b": ("2", None)}


def test_flat_changes_reach_the_dimension(spark, topic, tmp_path):
    out, store = FolderTopics(str(tmp_path / "out")), DimensionStore(spark, str(tmp_path / "dims"))
    topic(change("song", {"source_id": "a", "name": "1"}), change("song", {"source_id": "a", "name": "2"}, "update", 2), "broken")
    jobs.cdc_to_dwd(topic.stream(), config_from_rows(CONFIG), out, str(tmp_path / "c1"), flat=True).awaitTermination()
    jobs.dim_upsert(out.read_stream(spark, C.DWD_DIM, "dwd_changes"), store, str(tmp_path / "c2"), flat=True).awaitTermination()
    assert stored(store) == {"a": "2"}
    assert [r["value"] for r in out.read(spark, "malformed", "dwd_changes").collect()] == ["broken"]


def test_enriched_records_keep_fields_and_odd_records_do_not_end_a_job(spark, topic, tmp_path):
    out, store, mart = FolderTopics(str(tmp_path / "out")), DimensionStore(spark, str(tmp_path / "dims")), ParquetMarts(str(tmp_path / "mart"))
    store.put(spark.createDataFrame([("s", "甲")], "source_id string, singer_info string"), C.DIM_SONG, "source_id")
    topic({"songid": "s", "songname": "n", "time": "1000", "ui_version": "1.50", "new": {"a": 1}}, "junk",
          '{"songid":"s","songid":"t","songname":"n","time":99999999999999999}', {"songid": "s", "songname": "n", "time": 2000.0})
    topic({"songid": "s", "songname": "n", "time": 60000})
    jobs.song_play_wide(topic.stream(), store, out, str(tmp_path / "c1")).awaitTermination()
    wide = values(out.read(spark, C.DWS_PLAY, "dws_song_play"))
    assert {"songid": "s", "songname": "n", "time": "1000", "ui_version": "1.50", "new": {"a": 1}, "singer_info": "甲"} in wide and len(wide) == 4
    assert [r["value"] for r in out.read(spark, "malformed", "dws_song_play").collect()] == ["junk"]
    jobs.song_hot(topic.stream(), mart, str(tmp_path / "c2")).awaitTermination()
    assert [r["song_playtimes"] for r in mart.read(spark, C.MART_SONG_HOT).collect()] == [2]
    jobs.malformed_records(topic.stream(), out, str(tmp_path / "c3")).awaitTermination()
    assert [r["value"] for r in out.read(spark, "malformed", "malformed").collect()] == ["junk"]


def test_flat_changes(spark, topic, tmp_path):
    out = FolderTopics(str(tmp_path / "out"))
    topic(change("orders", {"id": 1}, ts=7))
    jobs.cdc_to_dwd(topic.stream(), config_from_rows(CONFIG), out, str(tmp_path / "c"), flat=True).awaitTermination()
    assert values(out.read(spark, C.DWD_ORDER, "dwd_changes"))[0]["type"] == "insert"


def test_orders_to_revenue(spark, topic, tmp_path):
    out, store, mart = FolderTopics(str(tmp_path / "out")), DimensionStore(spark, str(tmp_path / "dims")), ParquetMarts(str(tmp_path / "mart"))
    store.put(spark.createDataFrame([("5", "湖南", "长沙")], "mid string, province string, city string"), C.DIM_MACHINE_LOCAL, "mid")
    contract = [("5", "m", "p", "40.0", "30", "20", "10", "scene", None)]
    store.put(spark.createDataFrame(contract, "machine_num string, " + ", ".join(f"{c} string" for c in C.CONTRACT_COLUMNS)), C.DIM_MACHINE_ADMIN, "machine_num")
    topic({"id": 1, "mid": 5, "amount": 300, "pkg_name": "单曲", "bill_date": "20200105"})
    topic({"id": 2, "mid": 6, "amount": 10.55, "bill_date": "20200106"})
    jobs.order_wide(topic.stream(), store, out, str(tmp_path / "c1")).awaitTermination()
    jobs.order_revenue(out.read_stream(spark, C.DWS_ORDER, "dws_order"), mart, str(tmp_path / "c2")).awaitTermination()
    got = {r["mid"]: (r["province"], r["address"], *(str(r[c]) for c in ("amount", "inv_rev", "age_rev", "com_rev", "par_rev")), r["data_dt"])
           for r in mart.read(spark, C.MART_ORDER).collect()}
    assert got == {
        "5": ("湖南", "scene", "300.00", "120.00", "90.00", "60.00", "30.00", "20200105"),
        "6": (C.NO_INFO, C.NO_INFO * 2, "10.55", "10.55", "0.00", "0.00", "0.00", "20200106"),
    }


def test_logins_to_heat(spark, topic, tmp_path):
    out, mart = FolderTopics(str(tmp_path / "out")), ParquetMarts(str(tmp_path / "mart"))
    geo = spark.createDataFrame([(1, 1_500_000, 1_500_000, "p", "[]", "d", "a")], "geo_id long, lng_e6 long, lat_e6 long, province string, city string, district string, address string")
    topic({"uid": "1", "mid": "1", "lng": "1.4", "lat": "1.6", "login_dt": 1000}, {"lng": "50", "lat": "50", "login_dt": 2000})
    topic({"lng": "1.4", "lat": "1.6", "login_dt": 3000}, {"lng": "1.4", "lat": "1.6", "login_dt": 100000})
    jobs.login_wide(topic.stream(), PointIndex.build(geo, 1_000_000, stored=True), out, str(tmp_path / "c1")).awaitTermination()
    jobs.login_hot(out.read_stream(spark, C.DWS_LOGIN, "dws_login"), mart, str(tmp_path / "c2")).awaitTermination()
    got = sorted(tuple(r) for r in mart.read(spark, C.MART_LOGIN).select("province", "city", "lng", "login_times").collect())
    assert got == [("p", C.NO_INFO, "1.4", 2), (C.NO_INFO, C.NO_INFO, "50", 1)]


def test_late_plays_of_a_later_batch_are_dropped(spark, topic, tmp_path):
    mart = ParquetMarts(str(tmp_path / "mart"))

    def wide(ms):
        return {"songid": "s", "songname": "n", "singer_info": "x", "time": ms}

    topic(wide(1000), wide(20000))
    topic(wide(21000))  # emits the first window
    topic(wide(2000), wide(22000))  # 2000 belongs to an emitted window
    topic(wide(90000))
    jobs.song_hot(topic.stream(), mart, str(tmp_path / "c")).awaitTermination()
    counts = sorted(r["song_playtimes"] for r in mart.read(spark, C.MART_SONG_HOT).collect())
    assert counts == [1, 3]


def test_late_plays_come_out_on_their_own_topic(spark, topic, tmp_path):
    """The same heat as above, and the play that came too late as it was."""
    mart, out = ParquetMarts(str(tmp_path / "mart")), FolderTopics(str(tmp_path / "out"))

    def wide(ms, song="s"):
        return {"songid": song, "songname": "n", "singer_info": "x", "time": ms}

    topic(wide(1000), wide(20000))
    topic(wide(21000), wide(1001, "t"))  # the first window is closed
    topic(wide(90000))
    jobs.song_hot(topic.stream(), mart, str(tmp_path / "c"), late=out).awaitTermination()
    got = sorted(tuple(r) for r in mart.read(spark, C.MART_SONG_HOT).select("song_id", "song_playtimes", "singer_playtimes", "data_dt").collect())
    assert got == [("s", 1, 1, "1970-01-01"), ("s", 2, 2, "1970-01-01")]
    late = values(out.read(spark, "late", "song_hot_late"))
    assert [(v["songid"], v["time"], v["window_end"][:19]) for v in late] == [("t", 1001, "1970-01-01T00:00:05")]


# ---------------------------------------------------------------- options of outside systems


def test_kafka_options():
    topics = KafkaTopics("h:9092", from_earliest=False, max_per_trigger=10, options={"kafka.security.protocol": "SSL"})
    assert topics.source_options("t") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "10",
        "kafka.security.protocol": "SSL",
    }
    assert KafkaTopics("h").source_options("t")["startingOffsets"] == "earliest"
    assert topics.sink_options() == {"kafka.bootstrap.servers": "h:9092", "kafka.security.protocol": "SSL"}


def test_jdbc_options():
    mart = JdbcMarts("jdbc:x", "driver.Class", properties={"user": "u"})
    assert mart.options("t") == {
        "url": "jdbc:x", "driver": "driver.Class", "dbtable": "t", "batchsize": "50", "numPartitions": "16", "user": "u",
    }
    assert callable(config_from_jdbc(jdbc_options("jdbc:x", "u", "p")))
    assert jdbc_options("jdbc:x", "u", "p")["dbtable"] == "tbl_config_info"


def test_console(spark, rows, capsys):
    df = rows([("k", "v", "t")], C.RECORD_SCHEMA)
    ConsoleTopics("log ").write_batch(df, "name", 3)
    ConsoleMarts().write_batch(df, "table", 4)
    printed = capsys.readouterr().out
    assert "log name batch 3" in printed and "table batch 4" in printed and "|-- key: string" in printed


def test_file_names(spark, tmp_path):
    files = SharedFiles(spark)
    assert files.names(str(tmp_path / "none")) == [] and not files.exists(str(tmp_path / "none"))
    with pytest.raises(OSError):
        files.rename(str(tmp_path / "none"), str(tmp_path / "other"))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_scratch_can_be_dropped(spark, tmp_path, monkeypatch):
    from millrace import session

    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "scratch"))
    session.materialize(spark.range(3))
    assert (tmp_path / "scratch").exists()
    session.drop_scratch(spark)
    assert not (tmp_path / "scratch").exists()


def test_a_large_batch_is_in_several_files_and_still_one_batch(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "_FILE_BYTES", 4000)
    monkeypatch.setattr(streams, "scratch_path", lambda _, label: str(tmp_path / label))
    data = [(n, n % 3 if n % 50 else 3, f"text {n * n}") for n in range(1, 3000)]  # the last batch has few rows
    df = rows([*data, (0, None, "in no batch")], "n int, k int, text string").repartition(3)
    stream, seen = streams.in_batches(df, F.col("k"), 5, str(tmp_path)), []
    batches = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    batches.foreachBatch(lambda batch, k: seen.append(sorted(map(tuple, batch.collect())))).start().awaitTermination()
    assert seen == [sorted(r for r in data if r[1] == k) for k in range(5)]
    files = [len(list((tmp_path / "in" / f"batch={k}").glob("*.parquet"))) for k in range(5)]
    assert len(set(files)) == 1 and files[0] > 2


def test_changes_in_several_files_are_merged_in_their_order(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "_FILE_BYTES", 2000)
    orders = rows(
        [(n, n % 5, "FOP"[n % 3], n * 1.5, n * 86400 % 999_983, "1-URGENT") for n in range(400)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, s long, o_orderpriority string",
    ).withColumn("o_orderdate", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    rows([(1, "a", "b", "PROMO", 5)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    rows([(0, "x", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    db = duckdb.connect()
    for table in ("orders", "part", "nation"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    assert differences(QUERIES["stream_dim_upsert"](spark, str(tmp_path)), db, ORACLES["stream_dim_upsert"]) == ""
