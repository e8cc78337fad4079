"""Ranked lexical search: MaxScore over index segments whose bounds know pairs of terms.

The documents stay where they are. One pass counts them (documents, words, and in how many documents each query term stands);
the next cuts every task's documents into segments and stores, per segment, the impacts of every query term with their maximum,
and for pairs of terms of one query the list of documents that hold both, with their greatest joint impact. A query's terms are
paired by weight, neighbours with each other. In a segment a pair can then add no more than its greatest joint impact or the
greater of its single ones, which is less than the sum that independent maxima allow. Units (pairs, and a term left over) that
together stay below the score needed are not read for candidates; where only the joint impact of a pair reaches it, the pair's
list is read instead of its two terms. Candidates are dropped as soon as what is left cannot lift them to the score needed.

The score needed is the k-th best so far, and before that a value that k documents surely reach: the k-th greatest of a
list's maxima over the segments, each of which is another document. Every task gives at most k rows per query; these are
ranked in the end. Queries are taken in blocks of ``QUERY_BYTES`` of text, one block after the other, so what a task holds is
bounded, however many there are.

Words, weights and scores are those of the module's functions below; scores are 64-bit integers, so that ties are exact.

Defined cases: a null or empty text has no terms, is never found, and as a query finds nothing; equal scores rank by
ascending document id, a null id last; repeated documents are found one by one, and repeated query rows are answered one by
one; an empty table on either side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import materialize
from .words import Vocabulary, slices, split_words

K = 20
QUERY_BYTES = 4 * 1024 * 1024
# Text of one segment.
SEGMENT_BYTES = 4 * 1024 * 1024
_DOCS, _WORDS = -1, -2  # keys of the totals among the counts of terms


def weight(docs: int, holding: int) -> int:
    """The weight of a term that ``holding`` of ``docs`` documents hold."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def length_norm(words: np.ndarray, docs: int, all_words: int) -> np.ndarray:
    return 75 + (25 * words * docs) // max(all_words, 1)


def impact(weights: np.ndarray, tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 12 * norm))


@dataclass
class Plan:
    """The queries of one block: their terms as numbers of the vocabulary, dealt into units of one or two terms."""

    vocabulary: Vocabulary
    weights: np.ndarray  # by term number
    docs: int
    all_words: int
    pairs: np.ndarray  # two term numbers each; no pair twice
    bounds: np.ndarray  # first unit of each query, and the end
    first: np.ndarray  # per unit: a term,
    second: np.ndarray  # another or 0,
    times: np.ndarray  # how often each stands in the query,
    pair: np.ndarray  # and the number of the pair or -1

    @property
    def size(self) -> int:
        return len(self.bounds) - 1


def plan_queries(texts: list[str | None], vocabulary: Vocabulary, weights: np.ndarray, docs: int, all_words: int) -> Plan:
    words = split_words(pa.array(texts, pa.string()))
    ids, numbers = vocabulary.ids(words), {}
    bounds, first, second, times, pair = [0], [], [], [], []
    for a, b in zip(words.first, words.first[1:]):
        counts = Counter(ids[a:b].tolist())
        order = sorted(counts, key=lambda t: (-weights[t], t))
        for x, y in zip(order[::2], [*order[1::2], 0]):
            first.append(x)
            second.append(y)
            times.append((counts[x], counts.get(y, 0)))
            pair.append(numbers.setdefault((min(x, y), max(x, y)), len(numbers)) if y else -1)
        bounds.append(len(first))
    return Plan(
        vocabulary, weights, docs, all_words, np.array(list(numbers), np.int64).reshape(-1, 2), np.array(bounds),
        np.array(first, np.int64), np.array(second, np.int64), np.array(times, np.int64).reshape(-1, 2), np.array(pair, np.int64),
    )


@dataclass
class Segment:
    """Some documents: for each term its places and impacts, for each pair the places that hold both."""

    ids: np.ndarray
    no_id: np.ndarray
    terms: np.ndarray
    term_ends: np.ndarray
    places: np.ndarray
    impacts: np.ndarray
    peaks: np.ndarray
    pairs: np.ndarray
    pair_ends: np.ndarray
    both: np.ndarray
    joint_peaks: np.ndarray

    def to_bytes(self) -> bytes:
        """All arrays, packed by Arrow, so that a stored segment takes in memory what it takes on disk."""
        row = pa.RecordBatch.from_arrays([pa.array([v]) for v in vars(self).values()], names=list(vars(self)))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(row)
        return sink.getvalue().to_pybytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Segment:
        row = pa.ipc.open_stream(data).read_next_batch()
        return cls(*[c[0].values.to_numpy(zero_copy_only=False) for c in row.columns])


def build_segment(text: pa.Array, ids: pa.Array, plan: Plan) -> Segment:
    words = split_words(text)
    terms, count = plan.vocabulary.ids(words), len(text)
    lengths = np.diff(words.first)
    owner = np.repeat(np.arange(count), lengths)
    keys, tf = np.unique((terms * count + owner)[terms > 0], return_counts=True)
    own_term, places = keys // count, keys % count
    impacts = impact(plan.weights[own_term], tf, length_norm(lengths, plan.docs, plan.all_words)[places])
    held, starts = np.unique(own_term, return_index=True)
    ends = np.append(starts[1:], len(keys)) if len(held) else starts
    peaks = np.maximum.reduceat(impacts, starts) if len(held) else np.zeros(0, np.int64)
    slot = np.full(len(plan.weights), -1)
    slot[held] = np.arange(len(held))
    pairs, lists, joint = [], [], []
    at = slot[plan.pairs]
    for number in np.flatnonzero((at >= 0).all(axis=1)):
        (a, b), (c, d) = ((starts[s], ends[s]) for s in at[number])
        common, x, y = np.intersect1d(places[a:b], places[c:d], assume_unique=True, return_indices=True)
        if len(common):
            pairs.append(number)
            lists.append(common)
            joint.append((impacts[a + x] + impacts[c + y]).max())
    return Segment(
        np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), held, ends, places.astype(np.int32), impacts, peaks,
        np.array(pairs, np.int64), np.cumsum([len(v) for v in lists], dtype=np.int64),
        np.concatenate(lists).astype(np.int32) if lists else np.zeros(0, np.int32), np.array(joint, np.int64),
    )


class Searcher:
    """Searches one segment after the other and keeps the best ``k`` of each query."""

    def __init__(self, plan: Plan, k: int, needed: np.ndarray):
        self.plan, self.k, self.needed = plan, k, needed.copy()
        self.best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in range(plan.size)]
        self.scored = 0  # postings that were added up

    def add(self, segment: Segment) -> None:
        plan, count = self.plan, len(segment.ids)
        begin, end = np.zeros((2, len(plan.weights)), np.int64)
        end[segment.terms], begin[segment.terms] = segment.term_ends, np.append(0, segment.term_ends[:-1])[: len(segment.terms)]
        peak = np.zeros(len(plan.weights), np.int64)
        peak[segment.terms] = segment.peaks
        pair_begin, pair_end, joint = np.zeros((3, len(plan.pairs) + 1), np.int64)  # one more for no pair
        pair_end[segment.pairs] = segment.pair_ends
        pair_begin[segment.pairs] = np.append(0, segment.pair_ends[:-1])[: len(segment.pairs)]
        joint[segment.pairs] = segment.joint_peaks
        one, two = plan.times[:, 0] * peak[plan.first], plan.times[:, 1] * peak[plan.second]
        single = np.maximum(one, two)
        extra = (plan.times[:, 0] - 1) * peak[plan.first] + (plan.times[:, 1] - 1) * peak[plan.second]
        together = joint[plan.pair]
        bound = np.where(together > 0, np.minimum(np.maximum(together + extra, single), one + two), single)
        postings = lambda t: slice(begin[t], end[t])

        for query in range(plan.size):
            needed = max(int(self.needed[query]), 1)
            units = np.arange(plan.bounds[query], plan.bounds[query + 1])
            units = units[bound[units] > 0]
            if bound[units].sum() < needed:
                continue
            units = units[np.argsort(bound[units], kind="stable")]
            reach = np.cumsum(bound[units])
            idle = int(np.searchsorted(reach, needed))  # these units together stay below
            # Up to here a document that holds at most one term of each pair stays below as well.
            lone = idle + int(np.searchsorted((reach[idle - 1] if idle else 0) + np.cumsum(single[units[idle:]]), needed))
            total, seen = np.zeros(count, np.int64), np.zeros(count, bool)
            for unit in units[idle:lone]:
                seen[segment.both[pair_begin[plan.pair[unit]]: pair_end[plan.pair[unit]]]] = True
            for unit in units[lone:]:
                for term, times in zip((plan.first[unit], plan.second[unit]), plan.times[unit]):
                    here = postings(term)
                    total[segment.places[here]] += times * segment.impacts[here]
                    seen[segment.places[here]] = True
                    self.scored += here.stop - here.start
            alive = np.flatnonzero(seen)
            for k in range(lone - 1, -1, -1):
                alive = alive[total[alive] + reach[k] >= needed]
                if len(alive) == 0:
                    break
                for term, times in zip((plan.first[units[k]], plan.second[units[k]]), plan.times[units[k]]):
                    here = postings(term)
                    where = segment.places[here]
                    if len(where):
                        at = np.minimum(np.searchsorted(where, alive), len(where) - 1)
                        total[alive] += np.where(where[at] == alive, times * segment.impacts[here][at], 0)
                        self.scored += len(alive)
            self._keep(query, alive[total[alive] >= needed], total, segment)

    def _keep(self, query: int, found: np.ndarray, total: np.ndarray, segment: Segment) -> None:
        if len(found) == 0:
            return
        scores, no_id, ids = (
            np.concatenate([old, new])
            for old, new in zip(self.best[query], (total[found], segment.no_id[found], segment.ids[found]))
        )
        order = np.lexsort((ids, no_id, -scores))[: self.k]
        self.best[query] = scores[order], no_id[order], ids[order]
        if len(order) == self.k:
            self.needed[query] = max(self.needed[query], scores[order[-1]])

    def rows(self) -> pa.RecordBatch:
        numbers = np.repeat(np.arange(self.plan.size), [len(s) for s, _, _ in self.best])
        scores, no_id, ids = (np.concatenate([b[k] for b in self.best]) if self.best else np.zeros(0) for k in range(3))
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(ids, pa.int64(), mask=no_id.astype(bool)), pa.array(scores, pa.int64())],
            names=["query", "doc_id", "score"],
        )


def count_terms(docs: DataFrame, vocabulary: Vocabulary) -> dict[int, int]:
    """In how many documents each term of the vocabulary stands; the documents with words and all words under own keys."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        holding, totals = np.zeros(known.size + 1, np.int64), [0, 0]
        for batch in batches:
            for part in slices(batch, "text", SEGMENT_BYTES):
                words = split_words(part.column("text"))
                lengths = np.diff(words.first)
                totals[0] += int((lengths > 0).sum())
                totals[1] += int(lengths.sum())
                keys = np.unique(np.repeat(np.arange(len(lengths)), lengths) * (known.size + 1) + known.ids(words))
                holding += np.bincount(keys % (known.size + 1), minlength=known.size + 1)
        terms = np.flatnonzero(holding[1:]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([_DOCS, _WORDS, *terms.tolist()], pa.int32()), pa.array([*totals, *holding[terms].tolist()], pa.int64())],
            names=["term", "n"],
        )

    # As many rows as the vocabulary of one block of queries has terms.
    counts = docs.select("text").mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n")).collect()
    return {_DOCS: 0, _WORDS: 0, **{row[0]: row[1] for row in counts}}


def build_index(docs: DataFrame, plan: Plan) -> DataFrame:
    """One row per segment: ``data``, and the maxima of its terms (``list`` is the number) and pairs (``list`` is -1 - number)."""
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    schema = T.StructType([
        T.StructField("data", T.BinaryType()), T.StructField("list", T.ArrayType(T.IntegerType())),
        T.StructField("peak", T.ArrayType(T.LongType())),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SEGMENT_BYTES):
                found = build_segment(part.column("text"), part.column("doc_id"), shared.value)
                lists, peaks = np.append(found.terms, -1 - found.pairs), np.append(found.peaks, found.joint_peaks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([found.to_bytes()], pa.binary()), pa.array([lists], pa.list_(pa.int32())), pa.array([peaks], pa.list_(pa.int64()))],
                    names=schema.names,
                )

    return materialize(docs.mapInArrow(build, schema), "lexical-index")


def sure_scores(index: DataFrame, plan: Plan, k: int) -> np.ndarray:
    """For each query a score that ``k`` documents reach; 0 where there are fewer than ``k`` segments."""
    peaks = index.select(F.explode(F.arrays_zip("list", "peak")).alias("x")).select("x.list", "x.peak")
    best = peaks.withColumn("n", F.row_number().over(Window.partitionBy("list").orderBy(F.desc("peak")))).filter(F.col("n") == k)
    reached = {row["list"]: row["peak"] for row in best.select("list", "peak").collect()}  # at most the lists of the plan
    found = np.zeros(plan.size, np.int64)
    for query in range(plan.size):
        units = range(plan.bounds[query], plan.bounds[query + 1])
        found[query] = max((
            reached.get(name, 0) for u in units for name in (plan.first[u], plan.second[u], -1 - plan.pair[u] if plan.pair[u] >= 0 else 0)
        ), default=0)
    return found


def search_index(index: DataFrame, plan: Plan, k: int, needed: np.ndarray) -> DataFrame:
    """``query``, ``doc_id``, ``score``: the best ``k`` of every task."""
    shared = index.sparkSession.sparkContext.broadcast((plan, needed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(shared.value[0], k, shared.value[1])
        for batch in batches:
            for data in batch.column("data"):
                searcher.add(Segment.from_bytes(data.as_py()))
        yield searcher.rows()

    return index.select("data").mapInArrow(run, "query int, doc_id bigint, score bigint")


def _one_block(docs: DataFrame, rows: list, id_type: T.DataType, k: int) -> DataFrame:
    spark, texts = docs.sparkSession, [r["text"] for r in rows]
    words = split_words(pa.array(texts, pa.string()))
    vocabulary = Vocabulary({words.data[a: a + n].tobytes() for a, n in zip(words.starts, words.lengths)})
    counts = count_terms(docs, vocabulary)
    weights = np.array([weight(counts[_DOCS], counts.get(t, 0)) for t in range(vocabulary.size + 1)], np.int64)
    plan = plan_queries(texts, vocabulary, weights, counts[_DOCS], counts[_WORDS])
    index = build_index(docs, plan)
    found = search_index(index, plan, k, sure_scores(index, plan, k))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", id_type)])
    named = spark.createDataFrame([(n, r["id"]) for n, r in enumerate(rows)], names)  # the rows of one block
    return best.join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, queries: DataFrame, *, k: int = K, id_col: str = "doc_id", text_col: str = "text",
    query_col: str = "item_id", query_text_col: str = "text", query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``k`` best documents of every query with a score above 0.

    Document ids are whole numbers.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    asked = queries.select(F.col(query_col).alias("id"), F.col(query_text_col).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, math.ceil(size / query_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    parts = [
        _one_block(docs, asked.filter(block == b).collect(), asked.schema["id"].dataType, k) for b in range(blocks)
    ]
    found = parts[0] if blocks == 1 else materialize(parts[0], "lexical")
    for part in parts[1:]:
        found = found.unionByName(materialize(part, "lexical"))
    return found
