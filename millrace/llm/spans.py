"""Substring dedup with sliding sentence spans.

A span is a run of two or more sentences with 20 words or more, or one sentence with 50 words or more. Spans are compared
by a 128-bit hash of their words, case and punctuation aside. Of equal spans the first (by id, then by place) stays; a sentence
covered by any other one is removed. So a passage that repeats goes as a whole, wherever it begins and whatever stands around
it. Only the shortest span from each sentence on, the shortest one up to each sentence, and the long sentences are hashed: in
a longer span that repeats, each sentence lies in one of these, and they repeat with it. Their number grows with the text.

A part without a word (a rule of dashes, a row of dots) is no sentence: no span begins or ends with it, and it goes only with
the sentences around it.

The first place of a hash is found by an aggregation that is combined before the shuffle; the spans meet only that one row
per repeated hash. Texts move once, to meet the list of sentences to remove.

Defined cases: null texts stay null and empty ones empty; a text too short for a span keeps everything; rows equal in id and
text are one document read twice and get the same result; equal ids with different texts are told apart by the text; null ids
come first; repeats within a text count like others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .words import FOLD_WORDS

SENTENCES = 2
WORDS = 20
# A sentence with so many words is a span of its own.
ALONE = 50
_END = re.compile(r"[.!?]+\s+|\n+")
_BLANKED = bytes(b or 32 for b in FOLD_WORDS.tolist())


def sentences(text: str) -> list[str]:
    """The parts of a text that end after a mark followed by a blank, or after a line. Joined they are the text."""
    bounds = [0, *(m.end() for m in _END.finditer(text))]
    if bounds[-1] < len(text):
        bounds.append(len(text))
    return [text[a:b] for a, b in zip(bounds, bounds[1:])]


def _shortest(sums: list[int], least: int, words: int) -> Iterator[tuple[int, int]]:
    """The shortest runs of ``least`` sentences and ``words`` words from each sentence on and up to each; some come twice."""
    number = len(sums) - 1
    end = 0
    for begin in range(number):
        while end <= number and (end - begin < least or sums[end] - sums[begin] < words):
            end += 1
        if end > number:
            break
        yield begin, end
    begin = 0
    for end in range(least, number + 1):
        while end - begin > least and sums[end] - sums[begin + 1] >= words:
            begin += 1
        if sums[end] - sums[begin] >= words:
            yield begin, end


def span_hashes(text: str, least: int = SENTENCES, words: int = WORDS, alone: int = ALONE) -> Iterator[tuple[int, int, int, int]]:
    """First part, number of parts, and two halves of the hash of the spans that tell all others."""
    folded, place, sums, long = [], [], [0], []
    for k, part in enumerate(sentences(text)):
        found = part.encode().translate(_BLANKED).split()
        if found:
            if len(found) >= alone:
                long.append((len(place), len(place) + 1))
            place.append(k)
            folded.append(b" ".join(found))
            sums.append(sums[-1] + len(found))
    for begin, end in sorted({*_shortest(sums, least, words), *long}):
        digest = xxhash.xxh3_128_intdigest(b" ".join(folded[begin:end]))
        size = place[end - 1] + 1 - place[begin]
        yield place[begin], size, (digest >> 64) - (1 << 63), (digest & (2**64 - 1)) - (1 << 63)


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = SENTENCES, words: int = WORDS,
          alone: int = ALONE) -> DataFrame:
    """One row per document: the id, ``text`` without the removed sentences, ``n_sentences`` and ``n_removed`` (both count parts)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("of"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, found = [], []
                for k, text in enumerate(part.column("text")):
                    mine = list(span_hashes(text.as_py() or "", least, words, alone))
                    found.extend(mine)
                    row.extend([k] * len(mine))
                begin, size, high, low = zip(*found) if found else ((),) * 4
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(take), part.column("of").take(take), pa.array(begin, pa.int32()),
                     pa.array(size, pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                    names=["id", "of", "begin", "size", "high", "low"],
                )

    kind = source.schema["id"].dataType.simpleString()
    placed = materialize(
        source.mapInArrow(spans, f"id {kind}, of bigint, begin int, size int, high bigint, low bigint"), "spans"
    )
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "of", "begin")
    first = placed.groupBy("high", "low").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # Stored, so that the join has a shuffle of its own on either side, and adaptive execution can split a hot hash.
    repeated = materialize(first.filter(~F.col("first").eqNullSafe(F.col("last"))).select("high", "low", "first"), "repeated")
    copies = placed.join(repeated, ["high", "low"]).filter(~place.eqNullSafe(F.col("first")))

    # A null id needs a value to be joined by; the flag keeps it apart from any id.
    key = {"none": F.col("id").isNull(), "name": F.coalesce(F.col("id").cast("string"), F.lit(""))}
    covered = copies.withColumns(key).groupBy("none", "name", "of").agg(F.collect_set(F.struct("begin", "size")).alias("covered"))
    met = source.withColumns(key).join(covered, ["none", "name", "of"], "left").select("id", "text", "covered")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, number, removed = [], [], []
                for text, spans_ in zip(part.column("text"), part.column("covered")):
                    text = text.as_py()
                    parts = sentences(text or "")
                    gone = {k for s in spans_.as_py() or () for k in range(s["begin"], s["begin"] + s["size"])}
                    texts.append(text if not gone else "".join(p for k, p in enumerate(parts) if k not in gone))
                    number.append(len(parts))
                    removed.append(len(gone))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(texts, pa.string()), pa.array(number, pa.int64()), pa.array(removed, pa.int64())],
                    names=["id", "text", "n_sentences", "n_removed"],
                )

    return met.mapInArrow(remove, f"id {kind}, text string, n_sentences bigint, n_removed bigint").withColumnRenamed("id", id_col)
