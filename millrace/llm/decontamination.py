"""Benchmark decontamination with suffix arrays over shards of the training text.

Every task builds suffix arrays over slices of its documents, a few MB of text each: suffixes begin at words and end
before the first word that no benchmark item has, since no match can run past it. Every suffix of every item is looked up
by binary search, several words at a time. The documents are never shuffled, and a passage that a third of them share
costs each of them its own few lookups.

Defined cases: a null or empty text has no words and is clean; repeated rows and equal ids are judged row by row; an empty
benchmark or table gives clean documents or no rows; extra columns are ignored by the reports and kept by
``decontaminate``. Items with one id count as one item, and a null id is reported as an empty name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .words import Vocabulary, slices, split_words

WINDOW = 10
# Benchmark text looked for in one pass; it is held by every task. More text takes more passes, chained in the same task.
CHUNK_BYTES = 16 * 1024 * 1024
# Text of one suffix array.
SLICE_BYTES = 4 * 1024 * 1024
_HITS, _ITEMS = "__hits", "__items"


class SuffixArray:
    """Sorted suffixes of a sequence of word ids, in which 0 ends a suffix. Sorted up to ``depth`` words."""

    def __init__(self, ids: np.ndarray, bits: int, depth: int):
        self.bits, self.width = bits, max(1, 63 // bits)
        count = len(ids)
        place = np.arange(count)
        ends = np.minimum.accumulate(np.where(ids == 0, place, count)[::-1])[::-1]
        self.run = ends - place
        self.packed = self._pack(ids)
        live = np.flatnonzero(ids)
        order = live[np.argsort(self.packed[live], kind="stable")]
        heads = np.ones(len(order), bool)
        heads[1:] = self.packed[order[1:]] != self.packed[order[:-1]]
        rank = np.zeros(count, np.int64)
        known = self.width
        while len(order) and known < depth:
            group = np.maximum.accumulate(np.where(heads, np.arange(len(order)), 0))
            rank[order] = group + 1
            alone = heads & np.append(heads[1:], True)
            open_ = np.flatnonzero(~alone)
            if not (self.run[order[open_]] > known).any():
                break
            at = order[open_]
            # What follows the known words; ranks are those of the round before.
            second = np.where(self.run[at] > known, rank[np.minimum(at + known, count - 1)], 0)
            sorted_ = np.lexsort((second, group[open_]))
            order[open_], second = at[sorted_], second[sorted_]
            fresh = np.ones(len(open_), bool)
            fresh[1:] = (group[open_][1:] != group[open_][:-1]) | (second[1:] != second[:-1])
            heads[open_] = fresh
            known *= 2
        self.order = order
        self.leading = self.packed[order]

    def _pack(self, ids: np.ndarray) -> np.ndarray:
        """The first ``width`` words of every suffix in one integer; nothing after its end."""
        packed = np.zeros(len(ids), np.int64)
        for k in range(self.width):
            part = np.zeros(len(ids), np.int64)
            if k < len(ids):
                part[: len(ids) - k] = ids[k:]
            packed = (packed << self.bits) | np.where(self.run > k, part, 0)
        return packed

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: int, key: np.ndarray, after: bool) -> np.ndarray:
        """The first place in [low, high) whose words from ``depth`` on are not below (or, ``after``, are above) the key."""
        low, high = low.copy(), high.copy()
        while (going := low < high).any():
            middle = (low + high) >> 1
            at = self.order[np.minimum(middle, len(self.order) - 1)] + depth
            words = self.packed[np.minimum(at, len(self.packed) - 1)]
            right = going & ((words <= key) if after else (words < key))
            low = np.where(right, middle + 1, low)
            high = np.where(going & ~right, middle, high)
        return low

    def find(self, text: SuffixArray, begins: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Look up parts of ``text``: ``goal`` words from each of ``begins``.

        Gives the interval of suffixes that begin with the whole part (empty if none), and the length of the longest
        beginning of it that any suffix has.
        """
        low, high = np.zeros(len(begins), np.int64), np.full(len(begins), len(self.order))
        best = np.zeros(len(begins), np.int64)
        live = np.flatnonzero((goal > 0) & (high > 0))
        high[goal <= 0] = 0
        depth = 0
        while len(live):
            take = np.minimum(self.width, goal[live] - depth)
            spare = (self.width - take) * self.bits
            key = (text.packed[begins[live] + depth] >> spare) << spare
            top = key | ((np.int64(1) << spare) - 1)
            if depth == 0:
                new_low = np.searchsorted(self.leading, key)
                new_high = np.searchsorted(self.leading, top, side="right")
            else:
                new_low = self._bound(low[live], high[live], depth, key, False)
                new_high = self._bound(new_low, high[live], depth, top, True)
            hit = new_low < new_high
            best[live[hit]] = depth + take[hit]
            miss = np.flatnonzero(~hit)
            for side in (new_low[miss] - 1, new_low[miss]):  # the nearest suffixes share the most words
                fits = (side >= low[live[miss]]) & (side < high[live[miss]])
                at = self.order[np.clip(side, 0, len(self.order) - 1)] + depth
                other = self.packed[np.minimum(at, len(self.packed) - 1)]
                shared = np.zeros(len(miss), np.int64)
                for k in range(1, self.width + 1):
                    drop = (self.width - k) * self.bits
                    same = fits & (k <= take[miss]) & ((other >> drop) == (key[miss] >> drop))
                    shared[same] = k
                best[live[miss]] = np.maximum(best[live[miss]], depth + shared)
            low[live], high[live] = new_low, np.where(hit, new_high, new_low)
            depth += self.width
            live = live[hit & (goal[live] > depth)]
        return low, high, best


class Items:
    """The searched side: word ids of all items with their suffixes, and the distinct windows among these."""

    def __init__(self, rows: Sequence[tuple[str, str | None]], window: int):
        words = split_words(pa.array([text or "" for _, text in rows], pa.string()))
        raw = bytes(words.data)
        tokens = [raw[s: s + n] for s, n in zip(words.starts.tolist(), words.lengths.tolist())]
        self.vocabulary = Vocabulary(tokens)
        self.names = [name for name, _ in rows]
        counts = np.diff(words.first)
        # One 0 after each item.
        self.ids = np.zeros(len(tokens) + len(rows) + 1, np.int64)
        owner = np.repeat(np.arange(len(rows)), counts)
        self.begins = np.arange(len(tokens)) + owner
        self.ids[self.begins] = [self.vocabulary[w] for w in tokens]
        self.bits = max(1, int(self.vocabulary.size).bit_length())
        self.depth = int(counts.max(initial=0))
        self.suffixes = SuffixArray(self.ids, self.bits, 0)
        self.owner = owner
        self.left = (words.first[1:][owner] - np.arange(len(tokens))) if len(tokens) else np.zeros(0, np.int64)
        need = np.minimum(window, counts)[owner]
        whole = np.flatnonzero(self.left >= need)
        owners: dict[tuple, set[int]] = {}
        first: dict[tuple, int] = {}
        for k in whole.tolist():
            at = self.begins[k]
            content = tuple(self.ids[at: at + need[k]].tolist())
            owners.setdefault(content, set()).add(int(owner[k]))
            first.setdefault(content, k)
        self.windows = np.array([first[c] for c in owners], np.int64)
        self.window_words = need[self.windows] if len(self.windows) else np.zeros(0, np.int64)
        self.window_items = [sorted({self.names[i] for i in found}) for found in owners.values()]


def _shard(part: pa.RecordBatch, column: str, items: Items) -> tuple[np.ndarray, np.ndarray, SuffixArray]:
    """Word ids of a slice with one 0 after each text, the first id of each text, and the suffix array."""
    words = split_words(part.column(column))
    texts = len(words.first) - 1
    owner = np.repeat(np.arange(texts), np.diff(words.first))
    ids = np.zeros(len(words.starts) + texts + 1, np.int64)
    ids[np.arange(len(words.starts)) + owner] = items.vocabulary.ids(words)
    return ids, words.first + np.arange(texts + 1), SuffixArray(ids, items.bits, items.depth)


def _mark(part: pa.RecordBatch, column: str, items: Items) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Which words of the slice are hit (with one place after each text), the texts' first places, and their items."""
    ids, first, array = _shard(part, column, items)
    found: list[set[str]] = [set() for _ in range(part.num_rows)]
    edges = np.zeros(len(ids) + 1, np.int64)
    low, high, _ = array.find(items.suffixes, items.begins[items.windows], items.window_words)
    some = np.flatnonzero(low < high)
    for k in some.tolist():
        at = array.order[low[k]: high[k]]
        np.add.at(edges, at, 1)
        np.add.at(edges, at + items.window_words[k], -1)
        for text in np.unique(np.searchsorted(first, at, side="right") - 1).tolist():
            found[text].update(items.window_items[k])
    return np.cumsum(edges)[:-1] > 0, first, found


def _chunks(benchmark: DataFrame, id_col: str, text_col: str, window: int, chunk_bytes: int) -> list:
    """The benchmark in broadcast parts of about ``chunk_bytes``, dealt out by hash."""
    rows = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).alias("text")
    ).filter("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    count = max(1, math.ceil(total / chunk_bytes))
    context = benchmark.sparkSession.sparkContext
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("name", "text"), F.lit(count)))
    return [
        context.broadcast(Items([(r["name"], r["text"]) for r in dealt.filter(F.col("part") == k).collect()], window))
        for k in range(count)
    ]


def _marked(documents: DataFrame, benchmark: DataFrame, columns: Sequence[str], *, text_col: str, item_id: str,
            item_text: str, window: int, chunk_bytes: int) -> DataFrame:
    """``columns`` of the documents with a byte per word (1: hit) and the names of the items found."""
    schema = T.StructType([*[documents.schema[c] for c in columns], T.StructField(_HITS, T.BinaryType()),
                           T.StructField(_ITEMS, T.ArrayType(T.StringType()))])
    marked = documents.select(*columns)
    for number, chunk in enumerate(_chunks(benchmark, item_id, item_text, window, chunk_bytes)):
        earlier = number > 0

        def mark(batches: Iterator[pa.RecordBatch], chunk=chunk, earlier=earlier) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col, SLICE_BYTES):
                    hits, first, found = _mark(part, text_col, chunk.value)
                    flags = [hits[a: b - 1].astype(np.uint8) for a, b in zip(first[:-1], first[1:])]
                    if earlier:
                        before = part.column(_HITS).to_pylist()
                        flags = [f | np.frombuffer(old, np.uint8) for f, old in zip(flags, before)]
                        found = [s | set(old) for s, old in zip(found, part.column(_ITEMS).to_pylist())]
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in columns], pa.array([f.tobytes() for f in flags], pa.binary()),
                         pa.array([sorted(s) for s in found], pa.list_(pa.string()))],
                        names=[*columns, _HITS, _ITEMS],
                    )

        marked = marked.mapInArrow(mark, schema)
    return marked


def contamination(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: its words, the words inside any occurrence of an item's window, and the items found.

    A window is ``window`` consecutive item words; a shorter item is one window. Columns: the id, ``n_words``, ``n_hit``,
    ``items`` (names, sorted) and ``contaminated``.
    """
    marked = _marked(documents, benchmark, [id_col, text_col], text_col=text_col, item_id=item_id, item_text=item_text,
                     window=window, chunk_bytes=chunk_bytes)
    schema = T.StructType([
        documents.schema[id_col], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = [np.frombuffer(x, np.uint8) for x in batch.column(_HITS).to_pylist()]
            hits = [int(f.sum()) for f in flags]
            items = batch.column(_ITEMS).to_pylist()
            digests = [hashlib.sha256(",".join(names).encode()).hexdigest() for names in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([len(f) for f in flags], pa.int64()), pa.array(hits, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(digests, pa.string()), pa.array([h > 0 for h in hits], pa.bool_())],
                names=schema.names,
            )

    return marked.select(id_col, _HITS, _ITEMS).mapInArrow(count, schema)


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents, all columns, without those that hold a window of any item."""
    names = [f"c{k}" for k in range(len(documents.columns))]  # clashes with no working column
    plain = documents.toDF(*names)
    text = names[documents.columns.index(text_col)]
    marked = _marked(plain, benchmark, names, text_col=text, item_id=item_id, item_text=item_text, window=window,
                     chunk_bytes=chunk_bytes)
    return marked.filter(F.size(_ITEMS) == 0).select(*names).toDF(*documents.columns)


def longest_matches(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", min_words: int = WINDOW,
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The longest verbatim match of every item suffix, and where it stands.

    One row per item and word position whose longest match over all shards has at least ``min_words`` words: ``item_id``
    (as text), ``item_pos``, ``n_words``, and the document and word position of one such match (the smallest of the ids
    that the shards offer).
    """
    found_schema = T.StructType([
        T.StructField("item_id", T.StringType()), T.StructField("item_pos", T.LongType()),
        T.StructField("n_words", T.LongType()), T.StructField("doc", documents.schema[id_col].dataType),
        T.StructField("doc_pos", T.LongType()),
    ])
    found = None
    for chunk in _chunks(benchmark, item_id, item_text, min_words, chunk_bytes):

        def search(batches: Iterator[pa.RecordBatch], chunk=chunk) -> Iterator[pa.RecordBatch]:
            items = chunk.value
            starts = np.searchsorted(items.owner, np.arange(len(items.names)))
            for batch in batches:
                for part in slices(batch, text_col, SLICE_BYTES):
                    _, first, array = _shard(part, text_col, items)
                    *_, best = array.find(items.suffixes, items.begins, items.left)
                    some = np.flatnonzero(best >= min_words)
                    low, *_ = array.find(items.suffixes, items.begins[some], best[some])
                    at = array.order[low] if len(some) else np.zeros(0, np.int64)
                    text = np.searchsorted(first, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([items.names[k] for k in items.owner[some]], pa.string()),
                         pa.array(some - starts[items.owner[some]], pa.int64()), pa.array(best[some], pa.int64()),
                         part.column(id_col).take(pa.array(text)), pa.array(at - first[text], pa.int64())],
                        names=found_schema.names,
                    )

        rows = documents.select(id_col, text_col).mapInArrow(search, found_schema)
        found = rows if found is None else found.unionByName(rows)
    best = found.groupBy("item_id", "item_pos").agg(
        F.max(F.struct("n_words")).alias("_top"), F.min(F.struct(-F.col("n_words"), "doc", "doc_pos")).alias("_at")
    )
    return best.select(
        "item_id", "item_pos", F.col("_top.n_words").alias("n_words"), F.col("_at.doc").alias(id_col),
        F.col("_at.doc_pos").alias("doc_pos"),
    )
