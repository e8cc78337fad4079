import random

import pytest
from edge import empty_docs, edge_docs

from millrace.llm import licenses as L


def plain(rows, known):
    found = {}
    for key, text in rows:
        words = list(L.template("x", (text or "") + " a b c d e").words)[:-5]
        have = [" ".join(words[k: k + 5]) for k in range(len(words) - 4)]
        for t in known:
            whole = set(t.shingles)
            for start in range(0, len(have), t.stride):
                share = len(whole & set(have[start: start + t.window])) / len(whole)
                if share >= 0.8 and share > found.get((key, t.name), (0, 0))[0]:
                    found[key, t.name] = (share, start)
    return found


def test_notices_among_other_words(spark):
    rng = random.Random(2)
    known = [L.template(n, t) for n, t in L.TEMPLATES.items()]
    rows = []
    for k in range(60):
        t = rng.choice(known)
        notice = list(t.words)
        if len(notice) > 40 and k % 2:  # one word changed: five shingles of over forty
            notice[rng.randrange(len(notice))] = "changed"
        filler = [rng.choice("the of and in licensed under".split()) for _ in range(rng.choice([0, 7, 90]))]
        at = rng.randint(0, len(filler))
        rows.append((k, " ".join(filler[:at] + [w.upper() for w in notice] + filler[at:]) + " * end"))
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    mine = {(r["doc_id"], r["license"]): (r["containment"], r["word"]) for r in got.collect()}
    want = plain(rows, known)
    assert mine.keys() == want.keys() and len(want) >= 55
    assert all(abs(mine[k][0] - want[k][0]) < 1e-9 and mine[k][1] == want[k][1] for k in want)


def test_registered_query_against_plain(spark):
    from millrace.llm.queries import QUERIES, load

    rows = load(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    want = plain(rows, [L.template(n, t) for n, t in L.TEMPLATES.items()])
    got = QUERIES["op7_licenses"](spark, "/root/testdata/sf0.001").collect()
    assert {(r["doc_id"], r["license"]) for r in got} == want.keys() and want


def test_edges(spark):
    assert L.scan(edge_docs(spark)).count() == 0 and L.scan(empty_docs(spark)).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License", 2)] * 2, "doc_id long, text string, license int")
    assert [tuple(r) for r in L.scan(twice).collect()] == [(1, "MIT notice", 1.0, 0)] * 2
    with pytest.raises(ValueError):
        L.scan(twice, {"short": "three words only"})
