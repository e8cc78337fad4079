"""Patterns against their definitions, the field against all segmentations and on texts it was not trained on."""

import hashlib
import math
import random
import re
from itertools import combinations

import pytest
from edge import COLUMNS, edge_docs, empty_docs

from millrace.llm import pii
from millrace.llm.queries import QUERIES, load

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def field():
    return pii.train(pii.made_examples(pii.EXAMPLES, pii.SEED))


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    odd = lambda d: sum(sum(divmod(int(c) * (2 if k % 2 else 1), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    find = lambda p, ok: [m.span() for m in re.finditer(p, text) if ok(m)]
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and odd(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [(kind, *span) for kind, (pattern, ok) in rules.items() for span in find(pattern, ok)]


def test_patterns_against_their_definitions():
    rng = random.Random(1)
    pieces = ["a", "ab.c", "@", ".", "1", "12", "255", "256", "+", "+4", " ", "-", "(", ")", "é", "4111111111111111", "%", "_", "1.2.3.4", "0007",
              "\n", "x@y.z", "+1 (555) 123-4567", "4111 1111 1111 1111"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_spans_of_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "+1" + " " * 300_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000):
        assert [s for s in pii.base_spans(text) if s[0] != "ip"] == []


def test_segmentations_against_all_of_them(field):
    texts = ["call 555-123-4567 1.2.3.4 or", "ab at cd dot com dot de", "4111.1111.1111.1111 12 345 6789", "(617) 555-0100 617.555.0101"]
    for text in texts:
        found = pii.lattice(text, pii._NONE, 0, len(text))
        scores = field.scores(found)
        ways = []
        for size in range(4):
            for some in combinations(sorted(range(len(scores)), key=lambda k: found.spans[k][1]), size):
                if all(found.spans[a][2] <= found.spans[b][1] for a, b in zip(some, some[1:])):
                    kinds = [0, *(found.edges[k][2] for k in some)]
                    ways.append((sum(scores[k] for k in some) + sum(field.turn[a][b] for a, b in zip(kinds, kinds[1:])), some))
        assert len(ways) > 2
        best, some = max(ways)
        total = math.log(sum(math.exp(w) for w, _ in ways))
        chances, log_sum = field.probabilities(found, scores)
        if max(len(w) for _, w in ways) < 3:  # all of them were listed
            assert abs(log_sum - total) < 1e-6
        sure = [found.spans[k] for k in some if sum(chances[k]) >= pii.SURE]
        assert field.best(found) == sure


def test_held_out_texts(field):
    hits = misses = wrong = 0
    for text, gold in pii.made_examples(600, 4711):
        got = {s[:3] for s in pii.spans_of(text, field)}
        hits, misses, wrong = hits + len(got & set(gold)), misses + len(set(gold) - got), wrong + len(got - set(gold))
    assert hits > 500 and misses < 0.06 * hits and wrong < 0.01 * hits


def test_added_spans(field):
    text = "Call (617) 555-0100 or write jane.doe [at] mail [dot] example [dot] com by 2024-01-15, not 123-45-6789, version 1.2.3 of 12345678"
    assert [(s[0], text[s[1]: s[2]], s[3]) for s in pii.spans_of(text, field)] == [
        ("email", "jane.doe [at] mail [dot] example [dot] com", False), ("phone", "(617) 555-0100", False)]
    # The pattern takes in the address and then fails; the field finds where the number ends.
    text = "é +1 (826) 555-4081 190.137.223.204 é"
    assert [(s[0], text[s[1]: s[2]], s[3]) for s in pii.spans_of(text, field)] == [("ip", "190.137.223.204", True), ("phone", "+1 (826) 555-4081", False)]
    assert pii.masked(text, pii.spans_of(text, field)) == "é [phone] [ip] é"


@pytest.mark.parametrize("stretch", [200, 4096])
def test_a_long_stretch_loses_nothing(field, monkeypatch, stretch):
    monkeypatch.setattr(pii, "STRETCH", stretch)
    numbers = [f"(617) 555-{k:04}" for k in range(400)]
    text = "; or ".join(numbers)
    assert [text[s[1]: s[2]] for s in pii.spans_of(text, field)] == numbers
    pii.spans_of(" ".join(str(k % 10) for k in range(20_000)), field)


def test_query_keeps_the_patterns_spans(spark):
    texts = {r["doc_id"]: r["text"] for r in load(spark, SF, "documents").collect()}
    rows = QUERIES["op12_pii"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows) > 5
    for row in rows:
        base = plain_base(texts[row["doc_id"]])
        names = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        spans = [s.split(":") for s in row["spans"].split(",") if s]
        assert set(names) <= {":".join(s) for s in spans} and spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1]), int(s[2])))


def test_edges(spark, field):
    docs = edge_docs(spark)
    got = pii.find(docs, field=field)
    assert got.columns == ["doc_id", "spans"] and got.count() == docs.count() and all(r["spans"] is not None for r in got.collect())
    hidden = pii.mask(docs, field=field)
    assert hidden.columns == COLUMNS and hidden.filter("text IS NULL").count() == docs.filter("text IS NULL").count()
    assert sorted(hash(r) for r in hidden.collect()) == sorted(hash(r) for r in docs.collect())  # none of them holds any
    assert pii.find(empty_docs(spark), field=field).collect() == [] and pii.mask(empty_docs(spark), field=field).collect() == []
