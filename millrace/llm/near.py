"""Near copies by the Jaccard similarity of their word shingles.

MinHash bands bring texts together that may be similar: ``ROWS`` values a band and ``BANDS`` bands miss a pair of similarity s
with a probability of (1 - s ** ROWS) ** BANDS, which is 7 in 100,000 at 0.8 and less above. Texts that share a band make up
groups; inside a group shingle sets are compared exactly, and only pairs of ``LEAST`` or more are linked. Texts with equal sets
are one entry, however many there are. A text meets only the first one of each band, so rows grow with the texts and not with
their pairs; a large group is cut into parts, and each pair of parts is compared by itself.

Defined cases: a text of fewer than ``SHINGLE`` words is one shingle; null, empty and blank texts have none and are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .components import components
from .words import slices

SHINGLE = 5
LEAST = (4, 5)  # common to all shingles of both, as a fraction
ROWS, BANDS = 5, 24
SLICE_BYTES = 2 * 1024 * 1024
# Shingles, and texts, of one group that are compared in one piece.
PART_SHINGLES, PART_TEXTS = 1_000_000, 4096
_FACTORS = np.array([xxhash.xxh64_intdigest(b"minhash", k) | 1 for k in range(ROWS * BANDS)], np.uint64)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The hashes of the word shingles of a text, each once, in order."""
    words = (text or "").encode().lower().split()  # as fingerprints have it
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(size, len(words))
    begins = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(begins, stops)], np.uint64))


def bands(found: np.ndarray) -> list[int]:
    """One key per band; none for a text without shingles."""
    if len(found) == 0:
        return []
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        least = np.minimum(least, np.multiply.outer(_FACTORS, found[at: at + 4096]).min(axis=1))
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(rows[b].tobytes(), b) for b in range(BANDS)]


def with_bands(docs: DataFrame, text_col: str) -> DataFrame:
    """All columns with ``fp`` (names the set of shingles), ``n`` (its size) and ``bands``."""
    schema = T.StructType([*docs.schema, T.StructField("fp", T.LongType()), T.StructField("n", T.IntegerType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                sets = [shingles(t.as_py()) for t in part.column(text_col)]
                names = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                keys = [np.array(bands(s), np.uint64).view(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names), pa.array([len(s) for s in sets], pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                    names=schema.names,
                )

    return docs.mapInArrow(compute, schema)


def similar(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of places that connect whatever pairs of similar sets connect, one less than each component has."""
    flat, bounds = np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum([0, *map(len, sets)])
    own = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
    sizes = np.diff(bounds)
    part, whole = LEAST
    mark = np.zeros(len(flat), np.int64)
    pairs = []
    waiting = np.arange(len(sets))
    while len(waiting) > 1:
        front, waiting = [int(waiting[0])], waiting[1:]
        while front and len(waiting):
            at = front.pop()
            fit = np.minimum(sizes[waiting], sizes[at]) * whole >= np.maximum(sizes[waiting], sizes[at]) * part
            some = waiting[fit]
            if len(some) == 0:
                continue
            mark[own[at]] = 1
            common = np.add.reduceat(mark[np.concatenate([own[k] for k in some])], np.cumsum([0, *sizes[some[:-1]]]))
            mark[own[at]] = 0
            near = some[common * whole >= (sizes[some] + sizes[at] - common) * part]
            pairs.extend((at, k) for k in near.tolist())
            front.extend(near.tolist())
            waiting = np.setdiff1d(waiting, near, assume_unique=True)
    return pairs


def _similar_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by key."""
    now, names, sets = None, [], []

    def linked() -> pa.RecordBatch:
        pairs = similar(sets) if len(sets) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([names[p[k]] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"]
        )

    for batch in batches:
        for key, name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if key != now:
                yield linked()
                now, names, sets = key, [], []
            names.append(name)
            sets.append(shingles(text.as_py()))
    yield linked()


def links(marked: DataFrame, text_col: str) -> DataFrame:
    """Links (a, b) between the ``fp`` of :func:`with_bands` that connect whatever similar pairs of a group connect."""
    entries = marked.select("fp", F.explode("bands").alias("band"))
    # Stored, so that the join has a shuffle of its own on either side, and adaptive execution can split a hot band.
    first = entries.groupBy("band").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).filter("a < last")
    first = materialize(first.select("band", "a"), "bands")
    met = components(entries.join(first, "band").select("a", F.col("fp").alias("b")).filter("a <> b"))
    texts = marked.select(F.col("fp").alias("node"), F.col(text_col).alias("text"), "n").join(met, "node")
    texts = texts.groupBy("node", "root").agg(F.first("text").alias("text"), F.first("n").alias("n"))
    texts = materialize(texts, "candidates")
    total = texts.groupBy("root").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("texts"))
    load = F.greatest(F.col("shingles") / PART_SHINGLES, F.col("texts") / PART_TEXTS)
    # A large group in parts of about half a piece: each text goes to every pair of parts that its own is in.
    parts = F.when(load > 1, F.ceil(load * 2)).otherwise(1).cast("int")
    mine = F.pmod(F.xxhash64("node"), "parts").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = texts.join(total.select("root", parts.alias("parts")), "root").select(
        "root", "node", "text", mine.alias("p"), other.alias("q")
    ).select(F.xxhash64("root", F.least("p", "q"), F.greatest("p", "q")).alias("key"), "node", "text")
    # Hashed keys of two groups may be one: more is compared then, nothing is lost.
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_similar_of_sorted, "a bigint, b bigint")
