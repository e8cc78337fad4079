import random
import re

import corpus_pipeline
import numpy as np
import xxhash
from edge import empty_docs, edge_docs
from test_near import plain_set

from millrace.llm import simhash as S
from millrace.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k: k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(fps):
    return [(a, b) for k, a in enumerate(fps) for b in fps[:k] if bin((a ^ b) & (2**64 - 1)).count("1") <= 3]


def cluster(rng, size):
    """A chain of fingerprints, each a few bits from an earlier one, with some far away ones."""
    found = [rng.getrandbits(64)]
    while len(found) < size:
        base = rng.choice(found[-20:])
        for bit in rng.sample(range(64), rng.choice([1, 2, 3, 5])):
            base ^= 1 << bit
        found.append(base)
    return np.unique(np.array(found, np.uint64).view(np.int64)).tolist()


def test_spark_hashes_shingles_alike(spark):
    assert spark.sql("select xxhash64('the and of')").first()[0] % 2**64 == xxhash.xxh64_intdigest("the and of", 42)


def test_fingerprints():
    for text in ("", None, "One", "one TWO", "one two three", "É É é \u00a0 x\u2003y z", "a b c d e f g h " * 50):
        assert S.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_spanning_links_connect_what_pairs_connect():
    rng = random.Random(1)
    fps = cluster(rng, 700)
    a, b = S.spanning_links(np.array(fps))
    assert roots(fps, list(zip(a.tolist(), b.tolist()))) == roots(fps, near(fps))


def test_links_with_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(S, "PART", 64)
    rng = random.Random(2)
    fps = cluster(rng, 400) + cluster(rng, 30)
    got = S.links(spark.createDataFrame([(x,) for x in fps], "fp long").repartition(4))
    links = [tuple(r) for r in got.collect()]
    assert roots(fps, links) == roots(fps, near(fps))


def test_components(spark):
    rng = random.Random(4)
    path = [(k, k + 1) for k in range(100, 180)]
    star = [(7, k) for k in range(1000, 1300)]
    noise = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(140)] + [(5, 5), (7, 1000)]
    edges = path + star + noise
    got = components(spark.createDataFrame(edges, "a long, b long"))
    want = roots({n for e in edges for n in e}, edges)
    loops = {a for a, b in edges if a == b} - {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in got.collect()} == {k: v for k, v in want.items() if k not in loops}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges(spark):
    docs = edge_docs(spark)
    found = S.classes(docs)
    rows = docs.select("doc_id", "text").collect()
    fps = {plain_fingerprint(r["text"]) for r in rows}
    of = roots(fps, near(sorted(fps)))
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            root = of[plain_fingerprint(r["text"])]
            least[root] = min(least.get(root, 99), r["doc_id"])
    want = sorted((str(r["doc_id"]), plain_fingerprint(r["text"]), str(least.get(of[plain_fingerprint(r["text"])]))) for r in rows)
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64, str(r["component_id"])) for r in found.collect()) == want
    kept = S.near_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(of.values()))
    assert S.classes(empty_docs(spark)).count() == 0 and S.near_dedup(empty_docs(spark)).count() == 0


def test_registered_query_against_plain(spark):
    from millrace.llm.queries import QUERIES, load

    docs = load(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    of = roots(set(fps.values()), near(sorted(set(fps.values()))))
    least = {}
    for key, fp in sorted(fps.items()):
        least.setdefault(of[fp], key)
    got = QUERIES["op5_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r) for r in got} == {(k, f"{fp:016x}", least[of[fp]]) for k, fp in fps.items()}


def test_near_dedup_by_fingerprints_and_by_similarity(spark):
    """A and B are linked by three bits alone, B and C by similarity alone: one component, of which A stays."""
    rng = random.Random(3)
    differ = lambda a, b: (S.fingerprint(a) ^ S.fingerprint(b)).bit_count()
    alike = lambda a, b: 5 * len(plain_set(a) & plain_set(b)) >= 4 * len(plain_set(a) | plain_set(b))

    def changed(words, at):
        return " ".join(f"y{rng.randrange(10**6)}" if k in at else w for k, w in enumerate(words))

    for _ in range(20_000):
        # A phrase said again and again outweighs the rest in the fingerprint, and is few shingles of the set.
        words = ["so", "it", "goes"] * 40 + [f"w{rng.randrange(10**6)}" for _ in range(24)]
        a, b = " ".join(words), changed(words, {125, 132, 139})
        if differ(a, b) <= 3 and not alike(a, b):
            break
    else:
        raise AssertionError("no such texts")
    other = " ".join(f"z{k}" for k in range(50))
    docs = spark.createDataFrame([(1, a), (2, b), (3, other)], "doc_id long, text string")
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(S.near_dedup(docs)) == [1, 2, 3]
    assert ids(corpus_pipeline.distinct(spark, docs, "")) == [1, 3]
    c = changed(b.split(), {143})
    assert alike(b, c)
    assert ids(corpus_pipeline.distinct(spark, docs.union(spark.createDataFrame([(4, c)], docs.schema)), "")) == [1, 3]
