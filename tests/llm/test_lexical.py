"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge import edge_docs, empty_docs

from millrace.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def plain_search(docs, items, k=20):
    held = [(i, Counter(TERM.findall(fold(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    number, words = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in items:
        scores = []
        for i, counts in held:
            m = 75 + (25 * sum(counts.values()) * number) // words
            score = sum(
                times * math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t, times in Counter(TERM.findall(fold(text))).items() if counts[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        rows += [(item, n, i, -s) for n, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return rows


def texts(rng, number, longest=120):
    words = [f"w{k}" for k in range(60)] + ["Über", "東京", "the", "THE", "of"]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(longest))) for _ in range(number)]


def answers(found):
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("segment,k", [(4 << 20, 20), (600, 3), (600, 20)])
def test_search_against_all_scores(spark, monkeypatch, segment, k):
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", segment)
    rng = random.Random(segment + k)
    docs = list(enumerate(texts(rng, 300)))
    docs += [(1000 + i, t) for i, t in docs[:60]]  # ties
    items = list(enumerate([*texts(rng, 12, 30), "w1 w1 w1 w50", "unknown", "", None, "the of"]))
    got = lexical.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), k=k,
    )
    assert answers(got) == sorted(plain_search(docs, items, k), key=repr)


def test_blocks_of_queries(spark):
    rng = random.Random(1)
    docs, items = list(enumerate(texts(rng, 80))), [(f"q{k}", t) for k, t in enumerate(texts(rng, 9, 20))]
    got = lexical.search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), query_bytes=200,
    )
    assert answers(got) == sorted(plain_search(docs, items), key=repr)


def test_edges(spark):
    items = spark.createDataFrame([(1, "short text"), (1, "short text"), (None, "naïve 東京"), (2, " "), (3, None)], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in edge_docs(spark).collect()]
    want = plain_search(docs, [(1, "short text"), (1, "short text"), (None, "naïve 東京")])
    assert answers(lexical.search(edge_docs(spark), items)) == sorted(want, key=repr)
    assert lexical.search(empty_docs(spark), items).collect() == []
    assert lexical.search(edge_docs(spark), items.limit(0)).collect() == []


def made(rng, number=400, items=20):
    docs, asked = texts(rng, number), texts(rng, items, 30)
    held = [Counter(TERM.findall(fold(t))) for t in docs]
    known = lexical.Vocabulary({w.encode() for t in asked for w in TERM.findall(fold(t))})
    df = Counter(t for c in held for t in c)
    present = sum(map(bool, held))
    weights = np.array([0] + [lexical.weight(present, df[w.decode()]) for w in known.words], np.int64)
    plan = lexical.plan_queries(asked, known, weights, present, sum(sum(c.values()) for c in held))
    parts = [
        lexical.build_segment(pa.array(docs[a: a + 100]), pa.array(range(a, a + 100), pa.int64()), plan) for a in range(0, number, 100)
    ]
    return plan, parts


def test_a_segment_survives_its_bytes():
    _, parts = made(random.Random(3))
    for part in parts:
        again = lexical.Segment.from_bytes(part.to_bytes())
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(vars(part).values(), vars(again).values()))


def test_pair_bounds_read_less_than_single_ones():
    """The same answers with fewer postings than with maxima of single terms, and fewer still than without any bound."""
    plan, parts = made(random.Random(4))
    read, found = {}, {}
    for kind in ("pairs", "single", "none"):
        searcher = lexical.Searcher(plan, 5, np.zeros(plan.size, np.int64))
        for part in parts:
            part = lexical.Segment(**vars(part))
            if kind == "single":  # a pair may add what its terms may add
                peak = dict(zip(part.terms.tolist(), part.peaks.tolist()))
                part.joint_peaks = np.array([sum(peak[t] for t in plan.pairs[p]) for p in part.pairs], np.int64)
            if kind == "none":
                part.peaks, part.joint_peaks = part.peaks * 0 + 10**12, part.joint_peaks * 0 + 10**12
            searcher.add(part)
        read[kind], found[kind] = searcher.scored, [b[0].tolist() for b in searcher.best]
    assert found["pairs"] == found["single"] == found["none"]
    assert read["pairs"] < read["single"] < read["none"]
