import random
import re

import pytest
from edge import PASSAGE, empty_docs, edge_docs

from millrace.llm import decontamination as D


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window):
    out = []
    for key, text in docs:
        doc, hit, found = words(text), set(), set()
        for name, item in items:
            item = words(item)
            n = min(window, len(item))
            for a in range(len(item) - n + 1 if item else 0):
                for b in range(len(doc) - n + 1):
                    if doc[b: b + n] == item[a: a + n]:
                        hit.update(range(b, b + n))
                        found.add("" if name is None else str(name))
        out.append((key, len(doc), len(hit), sorted(found)))
    return sorted(out, key=repr)


def mine(df):
    return sorted(((r[0], r["n_words"], r["n_hit"], r["items"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 200])
def test_random_texts_against_plain_search(spark, chunk_bytes):
    rng = random.Random(5)
    letters = ["a", "b", "longer-than-eight", "longerthaneightletters", "longerthaneightLetterz", "é", "7"]
    text = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    docs = [(k, text(rng.choice([0, 3, 20, 120]))) for k in range(60)]
    items = [(k % 9, text(rng.choice([0, 1, 2, 5, 6, 9]))) for k in range(20)] + [(None, "a b a b a"), (3, None)]
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), window=4, chunk_bytes=chunk_bytes)
    assert mine(got) == plain(docs, items, 4)


def test_longest_matches(spark):
    rng = random.Random(3)
    docs = [(k, " ".join(rng.choice("abc") for _ in range(80))) for k in range(5)]
    items = [(k, " ".join(rng.choice("abcd") for _ in range(30))) for k in range(4)]
    got = D.longest_matches(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(items, "item_id long, text string"), min_words=4)
    best = {}
    for name, item in items:
        item = words(item)
        for a in range(len(item)):
            for key, text in docs:
                doc = words(text)
                for b in range(len(doc)):
                    n = 0
                    while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n]:
                        n += 1
                    if n >= 4:
                        best[str(name), a] = max(best.get((str(name), a), 0), n)
    rows = got.collect()
    assert {(r["item_id"], r["item_pos"]): r["n_words"] for r in rows} == best
    texts = {k: words(t) for k, t in docs}
    for r in rows:
        item = words(dict(items)[int(r["item_id"])])[r["item_pos"]: r["item_pos"] + r["n_words"]]
        assert texts[r["doc_id"]][r["doc_pos"]: r["doc_pos"] + r["n_words"]] == item


def test_edges(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, PASSAGE, 0), (2, None, 0), (2, "", 0)], "item_id long, text string, n_hit int")
    got = mine(D.contamination(docs, items))
    assert len(got) == docs.count() and [r for r in got if r[2]] == [(5, 16, 12, ["1"]), (6, 12, 12, ["1"])]
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert not kept.filter("doc_id in (5, 6)").count()
    assert D.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert D.contamination(empty_docs(spark), items).count() == 0
    assert D.longest_matches(docs, items.limit(0)).count() == 0
