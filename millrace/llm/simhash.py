"""SimHash near-duplicates with pigeonhole blocks.

Fingerprints are cut into six blocks. Two that differ in at most three bits agree in at least three blocks, so they meet
in one of the 20 tables that are keyed by three blocks each (32 bits or so). More blocks give longer keys: with eight
there are 56 tables of 40 bits, for tens of billions of texts. Only distinct fingerprints enter the tables: any number of
equal texts is one entry. What meets is compared bit by bit, and a table entry yields a spanning set of its links, not all
pairs. A key with many fingerprints is cut into parts; each pair of parts is compared by itself.

Defined cases: a null or empty text has fingerprint zero, which is linked like any other; repeated rows are kept; equal ids
are judged row by row; null ids never name a component unless all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from . import near
from .components import components
from .words import slices

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = 6
SLICE_BYTES = 2 * 1024 * 1024
# Fingerprints of one key that are compared in one piece.
PART = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of the word shingles of a text, repeats included, as a signed integer."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, and only ASCII blanks separate
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(shingle, len(words))
    begins = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(begins, stops)], dtype="<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at: at + 16384].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = (set_bits * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all without it) with the fingerprint of each text as a bigint ``out``."""
    kept = docs.columns if keep is None else keep
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(out, T.LongType())])
    source = docs.select(*dict.fromkeys([*kept, text_col]))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                values = [fingerprint(t.as_py()) for t in part.column(text_col)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(values, pa.int64())], names=schema.names
                )

    return source.mapInArrow(compute, schema)


def _block_keys(fp: Column, blocks: int) -> list[Column]:
    """One value per table: its number and the blocks that it is keyed by, packed into a bigint."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - DISTANCE)):
        key = F.lit(number).cast("bigint")
        for k in chosen:
            size = edges[k + 1] - edges[k]
            block = F.shiftrightunsigned(fp, edges[k]).bitwiseAND(F.lit((1 << size) - 1))
            key = F.shiftleft(key, size).bitwiseOR(block)
        keys.append(key)
    return keys


def _merge(labels: np.ndarray, near: np.ndarray, rows: slice, columns: slice) -> bool:
    """Give linked rows and columns their smallest label; whether any changed."""
    changed = False
    while True:
        row, column = labels[rows], labels[columns]
        best = np.where(near, column[None, :], len(labels)).min(axis=1)
        row = np.minimum(row, best)
        best = np.where(near, row[:, None], len(labels)).min(axis=0)
        column = np.minimum(column, best)
        if (row == labels[rows]).all() and (column == labels[columns]).all():
            return changed
        labels[rows], labels[columns] = np.minimum(labels[rows], row), np.minimum(labels[columns], column)
        changed = True


def spanning_links(fps: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect whatever pairs of ``fps`` within ``distance`` connect, one less than each component has."""
    fps = np.unique(fps.view(np.uint64))
    labels = np.arange(len(fps))
    step = 256
    changed = True
    while changed:  # labels only fall; mostly the second pass finds nothing to do
        changed = False
        for a in range(0, len(fps), step):
            for b in range(a, len(fps), step):
                rows, columns = slice(a, a + step), slice(b, b + step)
                if labels[rows].min() == labels[rows].max() == labels[columns].min() == labels[columns].max():
                    continue
                near = np.bitwise_count(fps[rows, None] ^ fps[None, columns]) <= distance
                changed |= _merge(labels, near, rows, columns)
    child = np.flatnonzero(labels != np.arange(len(fps)))
    return fps[labels[child]].view(np.int64), fps[child].view(np.int64)


def _linked(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys."""
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(heads, len(keys)))
    left, right = [], []
    small = np.repeat(sizes <= 32, sizes)
    for step in range(1, min(32, int(sizes.max(initial=1)))):
        near = small[:-step] & (keys[step:] == keys[:-step])
        near &= np.bitwise_count((fps[step:] ^ fps[:-step]).view(np.uint64)) <= DISTANCE
        at = np.flatnonzero(near)
        left.append(fps[at])
        right.append(fps[at + step])
    for head, size in zip(heads[sizes > 32].tolist(), sizes[sizes > 32].tolist()):
        a, b = spanning_links(fps[head: head + size])
        left.append(a)
        right.append(b)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _links_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by key. The last key of a batch waits for the next batch; no key has over 2 parts."""
    held_keys = held_fps = np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
        fps = np.concatenate([held_fps, batch.column(1).to_numpy()])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        held_keys, held_fps = keys[cut:], fps[cut:]
        if cut:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _linked(keys[:cut], fps[:cut])], names=["a", "b"])
    if len(held_keys):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _linked(held_keys, held_fps)], names=["a", "b"])


def links(fps: DataFrame, column: str = "fp", blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect whatever pairs within the distance connect."""
    tables = F.explode(F.array(*_block_keys(F.col(column), blocks)))
    entries = fps.select(F.col(column).alias("fp"), tables.alias("key"))
    counted = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(entries.join(counted, "key"), "blocks")
    few = shared.filter(F.col("n") <= PART).select("key", "fp")
    # A larger key in parts of about PART / 2: each fingerprint goes to every pair of parts that its own is in.
    parts = F.ceil(F.col("n") * 2 / PART).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    many = shared.filter(F.col("n") > PART).select("key", "fp", mine.alias("p"), other.alias("q")).select(
        F.xxhash64("key", F.least("p", "q"), F.greatest("p", "q")).alias("key"), "fp"
    )
    # Hashed keys of parts may meet another key: more is compared then, nothing is lost.
    dealt = few.unionByName(many).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_links_of_sorted, _LINKS)


def _classified(fps: DataFrame, id_col: str, linked: Callable[[DataFrame], DataFrame] = links) -> DataFrame:
    """``root`` for every distinct fingerprint, with ``least``: the smallest id of its component and a fingerprint with it."""
    distinct = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("id")), "distinct")
    roots = components(linked(distinct))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Ids before null, as min() has it.
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "fp")
    least = named.groupBy("root").agg(F.min(rank).alias("least"))
    return named.select("fp", "root").join(least, "root")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``fp`` and ``component_id``, the smallest id that links lead to."""
    marked = materialize(with_fingerprints(docs, text_col, keep=[id_col]), "fingerprints")
    named = _classified(marked, id_col).select("fp", F.col("least.id").alias("component_id"))
    return marked.join(named, "fp").select(id_col, "fp", "component_id")


def _links_of_marks(marked: DataFrame) -> DataFrame:
    """Links (a, b) between the ``fp`` of rows whose fingerprints ``mark`` are equal or linked, as a star for each component."""
    pairs = materialize(marked.select("fp", "mark").distinct(), "marks")
    roots = components(links(pairs.select("mark").distinct(), "mark")).withColumnRenamed("node", "mark")
    named = pairs.join(roots, "mark", "left").select("fp", F.coalesce("root", "mark").alias("root"))
    least = named.groupBy("root").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).filter("a < last").select("root", "a")
    # Stored, as the first texts of bands are: the join can split a hot root then.
    return named.join(materialize(least, "stars"), "root").select("a", F.col("fp").alias("b")).filter("a <> b")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, marks: bool = False) -> DataFrame:
    """The documents, all columns, one of each component of texts whose 5-word shingles are similar to 0.8 or more: that
    with the smallest id.

    With ``marks`` texts are linked as well where their fingerprints are, as in :func:`classes`, and a component may have links
    of both kinds. Three bits alone do not find all similar texts: at 0.8 some ten of 64 bits differ, and blocks for so many
    would have four bits or fewer. See :mod:`.near`. If several have the smallest id, one of those with the smallest name of a
    shingle set among them stays.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]  # clashes with no working column
    key, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    banded = near.with_bands(docs.toDF(*names), text)
    marked = materialize(with_fingerprints(banded, text, "mark") if marks else banded, "shingles")

    def linked(_: DataFrame) -> DataFrame:
        found = near.links(marked, text)
        return found.unionByName(_links_of_marks(marked)) if marks else found

    stays = _classified(marked.select(F.col(key).alias("id"), "fp"), "id", linked)
    stays = stays.select("least.*").distinct()
    name = F.coalesce(F.concat(F.lit("v"), F.col("id").cast("string")), F.lit("none"))
    named = marked.select(*names, "fp").withColumn("id", F.col(key)).withColumn("name", name)
    kept = named.join(stays.select(name.alias("name"), "fp"), ["name", "fp"], "left_semi")
    one = F.row_number().over(Window.partitionBy("name", "fp").orderBy(F.lit(0)))
    return kept.withColumn("row", one).filter("row = 1").select(*names).toDF(*docs.columns)
