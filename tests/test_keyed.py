"""Operators with state of their own: several batches, restarts and replays."""

from collections import Counter

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.checks import ORACLES, QUERIES
from millrace.plans import jobs
from millrace.session import STATE_STORE, materialize
from millrace.sources.marts import ParquetMarts
from millrace.sources.topics import FolderTopics
from millrace.streaming import keyed
from millrace.streaming.once import read_committed, write_batch_once

SCHEMA = "n int, k string, at timestamp, note string"
PLAIN = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture
def feed(spark, rows, tmp_path):
    """A stream that is given batch by batch; ``run`` goes on from its checkpoint and gives all that was written so far."""
    count = iter(range(1000))

    def put(*data):
        made = rows([(n, k, ms, note) for n, k, ms, note in data], "n int, k string, ms long, note string")
        made.selectExpr("n", "k", "timestamp_millis(ms) AS at", "note").coalesce(1).write.parquet(str(tmp_path / "in" / f"batch={next(count)}"))

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "batch=*")).drop("batch")

    def run(work, each=None):
        found = work(stream())
        each = each or (lambda df, k: write_batch_once(df, str(tmp_path / "out"), k))
        query = found.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
        query.foreachBatch(each).start().awaitTermination()
        return read_committed(spark, str(tmp_path / "out"), found.schema).collect() if each.__name__ == "<lambda>" else None

    put.run, put.stream, put.path = run, stream, str(tmp_path)
    return put


def test_windows_close_by_timer_and_late_rows_come_out(spark, feed):
    """Every row is either counted on time, or comes out late, or waits in a window that is still open."""
    batches = [
        [(1, "a", 1000, "x"), (2, None, 2000, None), (3, "a", 12_000, "ä")],  # the watermark becomes 9,000
        [(4, "a", 4999, "late"), (5, "b", 8000, "b"), (6, "a", 31_000, "")],  # 4999 is late; 8000 is not
        [(7, None, -70_000, "ages"), (8, "a", 20_001, "late again"), (9, "c", 60_000, "c")],
    ]

    def split(df, k):
        counts, late = keyed.split_routes(materialize(df), feed.stream().schema, ["k"], 5000)
        write_batch_once(counts, f"{feed.path}/counts", k)
        write_batch_once(late, f"{feed.path}/late", k)

    def work(stream):
        return keyed.windows_and_late_rows(stream, "at", ["k"], size_ms=5000, delay_ms=3000, lanes=3)

    for batch in batches:  # the query is started anew for every batch
        feed(*batch)
        feed.run(work, split)
    late = read_committed(spark, f"{feed.path}/late").withColumn("stop", F.unix_millis("window_end"))
    got = sorted((r["n"], r["k"], r["note"], r["stop"]) for r in late.select("n", "k", "note", "stop").collect())
    assert got == [(4, "a", "late", 5000), (7, None, "ages", -65_000), (8, "a", "late again", 25_000)]
    counts = read_committed(spark, f"{feed.path}/counts").withColumn("stop", F.unix_millis("window_end")).collect()
    assert Counter({(r["k"], r["stop"]): r["n"] for r in counts}) == Counter(
        {("a", 5000): 1, (None, 5000): 1, ("a", 15_000): 1, ("b", 10_000): 1, ("a", 35_000): 1})
    assert sum(r["n"] for r in counts) + len(got) + 1 == sum(map(len, batches))  # the last one's window is open


def test_the_first_row_of_a_key_over_restarts(feed):
    feed((2, "a", 2000, "second"), (1, "a", 1000, "first"), (3, None, 1500, "none"))
    assert sorted(r["n"] for r in feed.run(lambda s: keyed.first_per_key(s, ["k"], ["at", "n"]))) == [1, 3]
    feed((0, "a", 500, "older, but later"), (4, "b", 100, "b"), (5, None, 1, "again"))
    got = feed.run(lambda s: keyed.first_per_key(s, ["k"], ["at", "n"]))
    assert sorted((r["n"], r["k"], r["note"], r["at"].microsecond) for r in got if r["k"]) == [(1, "a", "first", 0), (4, "b", "b", 100_000)]
    assert len(got) == 3


def test_a_key_is_forgotten_after_its_time(feed):
    expiry = keyed.Expiry("at", 10_000, 1000)
    for batch in (
        [(1, "a", 1000, ""), (2, "b", 1000, "")], [(3, "a", 9000, ""), (4, "c", 13_000, "")],  # the watermark becomes 12,000
        [(5, "b", 14_000, ""), (6, "a", 14_500, "")],  # b was last seen at 1,000 and begins anew; a was seen at 9,000
    ):
        feed(*batch)
        got = feed.run(lambda s: keyed.first_per_key(s, ["k"], ["at", "n"], expiry=expiry))
    assert sorted(r["n"] for r in got) == [1, 2, 4, 5]


@pytest.mark.parametrize("expiry", [None, keyed.Expiry("at", 10**9, 0)])
def test_row_count_windows_by_key_over_restarts(feed, expiry):
    data = [(n, "ab"[n % 3 == 0], n * 10, None) for n in range(31)]
    for start, end in zip([0, 3, 11, 24], [3, 11, 24, 31]):
        feed(*data[start:end][::-1])
        got = feed.run(lambda s: keyed.count_windows_by_key(s, 4, ["k"], ["n"], expiry=expiry))
    for key in "ab":
        mine = [n for n, k, _, _ in data if k == key]
        found = sorted((r["window_no"], r["window_pos"], r["n"]) for r in got if r["k"] == key)
        assert found == [(j // 4, j % 4, n) for j, n in enumerate(mine[: len(mine) // 4 * 4])]


def test_a_replayed_batch_changes_nothing(spark, feed):
    """The sink fails after writing; the batch is run again from the state it had started from."""
    feed((1, "a", 1, ""), (2, "a", 2, ""), (3, "a", 3, ""))
    feed((4, "a", 4, ""), (5, "a", 5, ""))
    failed = []

    def fail_once(df, k):
        write_batch_once(df, f"{feed.path}/out", k)
        if k == 1 and not failed:
            failed.append(k)
            raise RuntimeError("lost")

    def work(stream):
        return keyed.count_windows_by_key(stream, 2, ["k"], ["n"])

    with pytest.raises(Exception):  # noqa: B017
        feed.run(work, fail_once)
    got = feed.run(work)
    assert failed and sorted((r["window_no"], r["window_pos"], r["n"]) for r in got) == [(0, 0, 1), (0, 1, 2), (1, 0, 3), (1, 1, 4)]


@pytest.fixture
def plain_store(spark):
    """A session that nobody tuned: Spark's own state store, which cannot hold what these operators keep."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, PLAIN)
    yield
    spark.conf.set(STATE_STORE, before)


@pytest.mark.parametrize("name", ["stream_count_window_keyed", "stream_first_per_key", "stream_late_rows"])
def test_queries_with_state_need_no_tuned_session(spark, rows, tmp_path, plain_store, name):
    made = rows([(n, n * 1_234_567, n % 7, "ab"[n % 2]) for n in range(100)], "event_id long, ms long, user_id long, event_type string")
    made = made.selectExpr("event_id", "CAST(timestamp_millis(ms) AS timestamp_ntz) AS ts", "user_id", "event_type")
    made.write.parquet(str(tmp_path / "events.parquet"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert differences(QUERIES[name](spark, str(tmp_path)), db, ORACLES[name]) == ""
    assert spark.conf.get(STATE_STORE) == PLAIN


def test_heat_with_late_rows_needs_no_tuned_session(spark, rows, tmp_path, plain_store):
    text = '{{"songid":"s","songname":"n","singer_info":"x","time":{}}}'
    for k, ms in enumerate([1000, 60_000, 2000]):  # the last play comes after its window has closed
        rows([(text.format(ms),)], "value string").coalesce(1).write.parquet(str(tmp_path / "in" / f"batch={k}"))
    source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "batch=*"))
    mart, late = ParquetMarts(str(tmp_path / "mart")), FolderTopics(str(tmp_path / "topics"))
    jobs.song_hot(source, mart, str(tmp_path / "c"), late=late).awaitTermination()
    assert [r["song_playtimes"] for r in mart.read(spark, C.MART_SONG_HOT).collect()] == [1]
    assert late.read(spark, keyed.LATE, "song_hot_late").count() == 1
