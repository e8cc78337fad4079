from collections import Counter, defaultdict

import pytest
from edge import empty_docs, edge_docs
from pyspark.sql import functions as F

from millrace.llm import mixing, sharding

WEIGHTS = (3, 1, 2)


def plain_targets(sizes):
    """Water filling, one cap after the other."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    left, rest, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while rest:
        share = left / sum(weight[s] for s in rest)
        over = [s for s in rest if share * weight[s] > 2 * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in rest}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
            rest.remove(s)
    return target


@pytest.mark.parametrize("range_rows", [20_000, 10])
def test_shares_and_order(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    counts = {"b": 200, "a": 3, "B": 50, "ä": 120, None: 20, "z": 1}
    rows = [(f"{s}{k}", "w " * (k % 17), s) for s, n in counts.items() for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string").repartition(5)
    got = mixing.schedule(docs).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    want = plain_targets(sizes)
    taken = Counter()
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"] and sum(r["passes"]) == r["taken"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) < 1 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.schedule(docs.repartition(3)).collect()))


def test_mix_is_in_order_of_finish(spark):
    docs = spark.createDataFrame([(k, "w " * (k % 9 + 1), "ab"[k % 2]) for k in range(300)], "doc_id long, text string, source string")
    passes = {r["id"]: sum(2 * p >= r["size"] for p in r["passes"]) for r in mixing.schedule(docs).collect()}
    mixed = [r["doc_id"] for r in mixing.mix(docs).collect()]
    assert Counter(mixed) == Counter({k: n for k, n in passes.items() if n})
    # Both sources are served all along.
    half = Counter(k % 2 for k in mixed[: len(mixed) // 2])
    assert half[0] > half[1] > 0


def test_mixing_edges(spark):
    docs = edge_docs(spark)
    got = mixing.schedule(docs).collect()
    assert len(got) == docs.count() and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.schedule(empty_docs(spark)).count() == 0 and mixing.mix(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in mixing.schedule(blank).collect()] == [(0, 0.0)] * 2


def shards_of(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    return slots


@pytest.mark.parametrize("bucket_bytes", [1 << 24, 700])
def test_shards(spark, bucket_bytes):
    docs = spark.createDataFrame([(k, "x" * (k % 40)) for k in range(999)], "doc_id long, text string").repartition(4)
    got = sharding.digest(docs, bucket_bytes=bucket_bytes).collect()
    slots = shards_of(got)
    sizes = [len(slots[k]) for k in range(16)]
    assert sum(sizes) == 999 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(str, got)) == sorted(map(str, sharding.digest(docs, bucket_bytes=bucket_bytes).collect()))
    # In random order: neighbours in a shard are no neighbours by id.
    first = [r["id"] for r in sorted(got, key=lambda r: r["slot"]) if r["shard"] == 0]
    assert sum(abs(a - b) < 5 for a, b in zip(first, first[1:])) < len(first) / 4
    other = sharding.digest(docs, bucket_bytes=bucket_bytes, seed=1).collect()
    assert {(r["id"], r["shard"]) for r in other} != {(r["id"], r["shard"]) for r in got}


def test_rows_that_all_look_alike_are_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 50)
    monkeypatch.setattr(sharding._scatter, "__defaults__", (50,))
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    hashed = rows.withColumn("_hash", F.xxhash64("doc_id", "text"))
    sizes = [r["count"] for r in sharding._scatter(hashed, 10).groupBy("_bucket").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 600
    slots = shards_of(sharding.digest(rows, bucket_bytes=20_000).collect())
    assert sorted(len(s) for s in slots.values()) == [187] * 8 + [188] * 8


def test_sharding_edges(spark, tmp_path):
    docs = edge_docs(spark)
    got = sharding.digest(docs).collect()
    assert len(got) == docs.count() and {r["size"] for r in got if r["text_crc32"] is None} == {1}
    placed = sharding.shards(docs)
    assert placed.columns == [*docs.columns, "shard", "slot"]
    assert sorted(map(str, placed.drop("shard", "slot").collect())) == sorted(map(str, docs.collect()))
    assert sharding.digest(empty_docs(spark)).count() == 0
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert shards_of(back.collect()).keys() == shards_of(got).keys() and back.count() == docs.count()
