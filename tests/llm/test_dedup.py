import random
import re

import pytest
from edge import LONG, empty_docs, edge_docs

from millrace.llm import line_dedup, spans


def plain_spans(rows, least, words, alone=50):
    """All runs of sentences, not only the shortest."""
    seen, gone, parts = {}, {}, {}
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    for key in order:
        text = key[2]
        parts[key] = [p for p in re.split(r"(?<=\n)(?!\n)|(?<=[.!?]\s)(?!\s)", text) if p]
        folded = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), p)) for p in parts[key]]
        worded = [k for k, p in enumerate(folded) if p]
        gone[key] = set()
        for a in range(len(worded)):
            for b in range(a + 1, len(worded) + 1):
                run = sum((folded[k] for k in worded[a:b]), [])
                if (b - a >= least and len(run) >= words) or (b - a == 1 and len(run) >= alone):
                    if tuple(run) in seen:
                        gone[key].update(range(worded[a], worded[b - 1] + 1))
                    seen.setdefault(tuple(run), key)
    out = []
    for i, t in rows:
        key = (i is not None, i or 0, t or "")
        kept = "".join(p for k, p in enumerate(parts[key]) if k not in gone[key])
        out.append((i, t if not gone[key] else kept, len(gone[key])))
    return sorted(out, key=str)


def test_sentence_parts_make_up_the_text():
    for text in ("", "a", "A. B! C?", "one. two.\n\nthree 2.0 four...  five\n", "\n\n.", LONG):
        assert "".join(spans.sentences(text)) == text


@pytest.mark.parametrize("least, words, alone", [(2, 6, 50), (2, 12, 5), (3, 10, 4)])
def test_spans_against_all_runs(spark, least, words, alone):
    rng = random.Random(8)
    # Each sentence begins with a word of its own, so equal words are equal sentences.
    pool = [f"s{k} " + " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))) + rng.choice([". ", "! ", "\n"]) for k in range(12)]
    pool += ["--\n", "-- . "]
    rows = [(k, "".join(rng.choice(pool) for _ in range(rng.choice([0, 2, 12])))) for k in range(80)] + [(None, pool[0] * 4)]
    got = spans.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), least=least, words=words, alone=alone)
    assert sorted(((r["doc_id"], r["text"], r["n_removed"]) for r in got.collect()), key=str) == plain_spans(rows, least, words, alone)


def test_the_end_of_a_repeated_run_goes_and_parts_without_words_repeat_nothing(spark):
    word = iter(f"w{k}" for k in range(1000))
    text = lambda n: " ".join(next(word) for _ in range(n)) + ". "
    run, long = text(5) + text(15) + text(4), text(50)
    rows = [(1, text(9) + run + text(30)), (2, text(7) + run + text(25)), (3, text(8) + long + text(8)), (4, text(8) + long),
            (5, "----\n" + text(15) + text(15)), (6, "----\n" + text(12) + "----\n" + text(12) + "----\n")]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in spans.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == (rows[1][1].replace(run, ""), 3) and got[4] == (rows[3][1].replace(long, ""), 1)
    assert all(got[k] == (rows[k - 1][1], 0) for k in (1, 3, 5, 6))


def test_a_planted_passage_goes_and_the_rest_stays(spark):
    passage = " ".join(f"Sentence number {k} of the passage has some words in it." for k in range(6))
    rows = [(k, f"Own text of {k} here.\n{'intro words without an end ' if k % 2 else ''}{passage} Tail number {k}.") for k in range(40)]
    got = {r["doc_id"]: r for r in spans.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["n_removed"] == 0 and got[0]["text"] == rows[0][1]
    for k in range(1, 40):
        assert "number 3 of the passage" not in got[k]["text"] and f"Own text of {k} here." in got[k]["text"] and f"Tail number {k}." in got[k]["text"]


def plain_lines(rows, n, long_words):
    seen, out = set(), []
    for key, text in rows:
        lines, gone = text.split("\n"), set()
        for k in range(len(lines)):
            for size in {n, *([1] if len(lines[k].split()) > long_words else [])}:
                run = tuple(lines[k: k + size])
                if len(run) == size:
                    if run in seen:
                        gone.update(range(k, k + size))
                    seen.add(run)
        out.append((key, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_lines_against_plain_search(spark, n):
    rng = random.Random(n)
    pool = ["a", "b", "c", "", "a line of six words here", " five words are  too few "]
    rows = [(k, "\n".join(rng.choice([*pool, f"own{k}"]) for _ in range(rng.choice([1, 3, 15])))) for k in range(60)]
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), min_lines=n, long_words=5)
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed").collect())) == plain_lines(rows, n, 5)


def test_a_long_line_is_a_run_of_its_own(spark):
    line = " ".join(f"w{k}" for k in range(51))
    rows = [(1, line), (2, line), (3, f"x\n{line}\ny"), (4, line[4:]), (5, line[4:])]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (line, 0), 2: ("", 1), 3: ("x\ny", 1), 4: (line[4:], 0), 5: (line[4:], 0)}


def test_neighbouring_runs_are_one_stretch(spark):
    text = "\n".join(f"line {k}" for k in range(10))
    found = line_dedup.runs(spark.createDataFrame([(1, text), (2, f"x\n{text}\ny"), (3, "line 3\nline 4")], "doc_id long, text string"))
    assert sorted((r["name"], r["line"], r["n_lines"]) for r in found.collect()) == [("2", 1, 10), ("3", 0, 2)]


@pytest.mark.parametrize("operator", [spans.dedup, line_dedup.dedup])
def test_edges(spark, operator):
    docs = edge_docs(spark)
    got = operator(docs)
    rows = got.collect()
    assert len(rows) == docs.count()
    assert [r["text"] for r in rows if r["doc_id"] == 1] == [None] and [r["text"] for r in rows if r["doc_id"] == 2] == [""]
    assert [r["text"] for r in rows if r["doc_id"] == 4] == ["short text"] * 2
    if operator is line_dedup.dedup:  # a line of its own, over 50 words
        assert [r["text"] for r in rows if r["doc_id"] == 8] == [""]
    if operator is spans.dedup:  # the long text repeats itself and its copy
        assert [r["text"] for r in rows if r["doc_id"] == 8] == [""]
    assert operator(empty_docs(spark)).count() == 0
