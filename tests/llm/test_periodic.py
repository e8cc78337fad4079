"""Periodic runs against a search of all periods and places."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from edge import COLUMNS, edge_docs, empty_docs

from millrace.llm import periodic
from millrace.llm.queries import QUERIES, load

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every maximal stretch of every period, without those that have a smaller one."""
    found, ids = {}, np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, np.int64)
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(np.int8)
        change = np.flatnonzero(np.diff(same))
        for i, j in zip(change[::2].tolist(), change[1::2].tolist()):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_report(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return {
        "doc_id": doc_id, "n_runs": len(runs), "start": best and best[0], "length": best and best[1], "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": sha("".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))),
        "collapsed_sha256": sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    }


def made(rng):
    """Words of a small alphabet with stretches of all kinds of periods, some touching, nested or broken."""
    words = []
    while len(words) < rng.randrange(1, 400):
        kind = rng.randrange(4)
        if kind == 0:
            words += [rng.randrange(rng.choice([2, 3, 40])) for _ in range(rng.randrange(30))]
        elif kind == 1:
            base = [rng.randrange(5) for _ in range(rng.randrange(1, 9))]
            words += (base * 12)[: rng.randrange(1, 12 * len(base))]
        elif kind == 2:
            base = [0] * rng.randrange(1, 8) + [1]
            words += base * rng.randrange(1, 7)
        elif words:
            words += words[-rng.randrange(1, len(words) + 1):] * rng.randrange(1, 5)
            words = words[:1500]
    return np.array(words, np.int64)


@pytest.mark.parametrize("chunk", [500_000, 7])
def test_runs_against_all_periods(monkeypatch, chunk):
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(60):
        texts = [made(rng) for _ in range(rng.randrange(1, 8))] + [np.zeros(0, np.int64)]
        got = periodic.find_runs(texts)
        assert [list(map(tuple, runs.tolist())) for runs in got] == [sorted(plain_runs(t.tolist()), key=lambda r: (r[0], r[2])) for t in texts]


def test_extensions_in_a_grammar():
    rng = random.Random(2)
    for _ in range(40):
        body = np.concatenate([made(rng) for _ in range(3)])
        text = np.array([10**6, *body, 10**6 + 1])
        forward = periodic.Grammar(text)
        backward, n = forward.mirrored(), len(text)
        a, b = rng.choices(range(1, n), k=200), rng.choices(range(1, n), k=200)
        a, b = (np.array(v) for v in zip(*[(x, y) for x, y in zip(a, b) if x != y]))
        right = [next(k for k in range(n) if text[x + k] != text[y + k]) for x, y in zip(a, b)]
        left = [next(k for k in range(n) if text[x - 1 - k] != text[y - 1 - k]) for x, y in zip(a, b)]
        assert forward.extension(a, b).tolist() == right and backward.extension(n - a, n - b).tolist() == left


def test_words_that_repeat_everywhere_stay_cheap():
    text = np.zeros(200_000, np.int64)
    assert periodic.find_runs([text])[0].tolist() == [[0, 200_000, 1]]
    comb = np.arange(40_000)
    comb[::2] = 0  # every other word is the same, and no run
    assert len(periodic.find_runs([comb])[0]) == 0
    assert len(periodic.Grammar(np.array([7, *text, 8])).levels) < 80


def test_equal_words_across_texts():
    # On the grid of multiples of 3, the last word of the first text and three of the next one are equal; no text has a run.
    texts = [np.array([*range(10, 21), 9]), np.array([30, 9, 31, 32, 9, 33, 34, 9])]
    assert [len(runs) for runs in periodic.find_runs(texts)] == [0, 0]
    rng = random.Random(3)
    for _ in range(60):
        # Words that stand once but for one that is frequent, so that most texts have no four equal words of their own.
        texts = [np.where(np.array([rng.random() < 0.3 for _ in range(n)]), 0, np.arange(n) + 1000 * k + 1) for k, n in
                 enumerate(rng.choices(range(6, 60), k=rng.randrange(2, 8)), 1)]
        texts[0][:8] = 5
        got = periodic.find_runs(texts)
        assert [list(map(tuple, runs.tolist())) for runs in got] == [sorted(plain_runs(t.tolist()), key=lambda r: (r[0], r[2])) for t in texts]


def test_documents_with_equal_words_across_texts(spark):
    first = " ".join([*(f"a{k}" for k in range(11)), "the"])
    rows = [(3, "c0 c0 c0 c0 c0 c0 c1 c2"), (1, first), (2, "b0 the b1 b2 the b3 b4 the")]
    got = {r["doc_id"]: r for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert [(got[k]["n_words"], got[k]["runs"]) for k in (1, 2)] == [(12, []), (8, [])] and got[1]["collapsed"] == first
    assert [tuple(r) for r in got[3]["runs"]] == [(0, 6, 1)] and got[3]["collapsed"] == "c0 c1 c2"


@pytest.mark.parametrize("size", [2 << 20, 3000])
def test_query_against_all_periods(spark, monkeypatch, size):
    monkeypatch.setattr(periodic, "SLICE_BYTES", size)
    want = [plain_report(r["doc_id"], r["text"]) for r in load(spark, SF, "documents").collect()]
    got = [r.asDict() for r in QUERIES["op13_periodic"](spark, SF).collect()]
    key = lambda r: (r["doc_id"], r["runs_sha256"])
    assert sum(r["n_runs"] for r in want) > 5 and sorted(got, key=key) == sorted(want, key=key)


def test_edges(spark):
    docs = edge_docs(spark)
    got = periodic.periodic_runs(docs)
    texts = {}
    for row in got.collect():
        texts.setdefault(row["doc_id"], []).append(row)
    assert got.count() == docs.count() and texts[1][0]["n_words"] == 0 and texts[3][0]["collapsed"] == ""
    assert len(texts[7][0]["runs"]) == 1 and texts[7][0]["runs"][0]["start"] == 0  # the long text says the same over and over
    assert periodic.periodic_runs(empty_docs(spark)).collect() == [] and periodic.collapse(empty_docs(spark)).collect() == []
    changed = periodic.collapse(docs)
    assert changed.columns == COLUMNS
    for old, new in zip(sorted(docs.collect(), key=lambda r: r["row"]), sorted(changed.collect(), key=lambda r: r["row"])):
        shorter = len(new["text"] or "") < len(old["text"] or "")
        assert shorter == (old["doc_id"] in (7, 8)), old["doc_id"]
        assert shorter or hash(old) == hash(new)
