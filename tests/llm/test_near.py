import random
import re

import pytest

from millrace.llm import near, simhash


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {" ".join(words[k: k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """The smallest id of every component of the pairs of similarity 0.8 or more."""
    sets = {i: plain_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(i for i in sets if find(i) == i)


def copies(rng, number):
    """Families of texts, each changed in some words of an earlier one: similarities from 0.4 to 1."""
    texts = []
    for _ in range(number):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 30, 120, 400]))]
        for _ in range(rng.randint(1, 5)):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                base[rng.randrange(len(base))] = f"x{rng.randrange(5000)}"
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("part", [1_000_000, 300])
def test_near_copies_against_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(near, "PART_SHINGLES", part)
    rows = copies(random.Random(5), 120)
    got = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(r["doc_id"] for r in got.collect()) == plain_kept(rows)


def test_a_copy_beyond_three_bits_goes_and_one_below_stays(spark):
    base = [f"w{k}" for k in range(204)]  # 200 shingles
    some, many = list(base), list(base)
    for k in (50, 100, 150):  # 15 shingles changed: 185 / 215 is 0.86
        some[k] = f"changed{k}"
    for k in range(20, 180, 20):  # 40 changed: 160 / 240 is 0.67
        many[k] = "other"
    rows = [(k, " ".join(words)) for k, words in enumerate((base, some, many))]
    a, b = (simhash.fingerprint(rows[k][1]) for k in (0, 1))
    assert bin((a ^ b) & (2**64 - 1)).count("1") > 3
    got = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 2]
