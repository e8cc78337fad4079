"""Toxicity scores by weak supervision.

Terms are counted by label in all labelled rows: whole words of any length, word beginnings of 4 to 8 bytes, as stems of
inflected words, and, since many scripts put no blanks between words, short runs of non-ASCII characters from every position.
The most telling ones become lexicon voters, next to pattern voters for shouting, repetition and shape. A generative label model estimates from the votes on all documents how often each voter fires in either class, and
how far voters that agree depend on each other; dependent voters are discounted. Its posterior labels of a bounded sample of the labelled rows, with
the given label as one more imperfect voter, train a linear classifier over the terms. Posterior labels are cautious where few
voters speak, so the given labels of the sample tell in the end how likely label 1 is at a score (Platt's scaling). The
classifier scores every whole text.

What depends on all documents leaves the tasks as sums of fixed size; the driver holds the sample's features and the model.

Defined cases: a null or empty text scores like any text without a known term; labels without a document, null labels and
null ids are not learned from; several labels of a document count as toxic if one is; without labels every text scores
0.5; repeated rows are scored one by one; extra columns are ignored by ``scores`` and kept by ``reject``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.joins import sized_join
from ..session import materialize
from .words import LANE, Words, slices, split_words

# The classifier is fitted on about so many labelled rows, taken by a hash of the id.
FIT_ROWS = 20_000
FEATURES = 2048
LEXICONS = 56
LEAST_ROWS = 5
THRESHOLD = 0.7
ROUNDS = 6
# How far a given label is trusted beside the voters.
LABEL_ACCURACY = 0.98
SLICE_BYTES = 4 * 1024 * 1024
STEMS = (4, 5, 6, 7, 8)
# Kinds of terms: 0 a word of up to 8 bytes, 1 a longer one (its first four bytes and half of a hash of all), 4 to 8 a beginning
# of so many bytes, and GRAM + 2, 3 and 4 runs of characters of so many bytes each, of the lengths below in bytes.
LONG, GRAM = 1, 16
GRAMS = {2: 8, 3: 6, 4: 4}
PATTERNS = ("shouting", "marks", "repetition", "short", "no lexicon term")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, kind and bytes of every run of non-ASCII characters of the lengths in ``GRAMS``."""
    data = words.data
    word, kind, key = ([np.zeros(0, t)] for t in (np.int64, np.int64, np.uint64))
    leads = np.flatnonzero(data >= 0xC2)
    for width, size in GRAMS.items():
        low, high = {2: (0xC2, 0xDF), 3: (0xE0, 0xEF), 4: (0xF0, 0xF4)}[width]
        at = leads[leads + LANE <= len(data)]
        for step in range(0, size, width):
            at = at[(data[at + step] >= low) & (data[at + step] <= high)]
        of = np.searchsorted(words.starts, at, side="right") - 1
        inside = at + size <= words.starts[of] + words.lengths[of]
        at, of = at[inside], of[inside]
        view = np.ndarray((len(data) - LANE + 1,), dtype="<u8", buffer=data, strides=(1,))
        word.append(of)
        kind.append(np.full(len(at), GRAM + width))
        key.append(view[at] & np.uint64((1 << (8 * size)) - 1))
    return np.concatenate(word), np.concatenate(kind), np.concatenate(key)


def _terms(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, kind and key of each term of these words, runs of characters aside."""
    sizes = words.lengths[chosen]
    word, kind, key = [], [], []
    for size in (0, *STEMS):
        some = chosen[sizes <= 8 if size == 0 else sizes > size]
        word.append(some)
        kind.append(np.full(len(some), size))
        key.append(words.prefix(some, size or 8))
    some = chosen[sizes > 8]
    word.append(some)
    kind.append(np.full(len(some), LONG))
    key.append(words.prefix(some, 4) | (words.hashes(some) & np.uint64(0xFFFFFFFF00000000)))
    return np.concatenate(word), np.concatenate(kind), np.concatenate(key)


class Terms:
    """A bounded list of terms that texts are searched for."""

    def __init__(self, kinds: Sequence[int], keys: Sequence[int]):
        self.count = len(kinds)
        self._has_grams = any(kind > GRAM for kind in kinds)
        codes = _codes(np.array(kinds, np.int64), np.array(keys, np.int64).view(np.uint64))
        self._order = np.argsort(codes)
        self._codes = codes[self._order]
        self._begins = np.zeros(1 << 16, bool)
        begins = np.array(keys, np.int64).view(np.uint64) & np.uint64(0xFFFFFFFF)
        self._begins[_spot(begins)] = True

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Each text and term that are found together, once, by text."""
        if self.count == 0 or len(words.starts) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        chosen = np.flatnonzero(self._begins[_spot(words.prefix(slice(None), 4))])
        parts = [_terms(words, chosen), *([_grams(words)] if self._has_grams else [])]
        word, kind, key = (np.concatenate(p) for p in zip(*parts))
        codes = _codes(kind, key)
        at = np.minimum(np.searchsorted(self._codes, codes), self.count - 1)
        found = np.flatnonzero(self._codes[at] == codes)
        text = np.searchsorted(words.first, word[found], side="right") - 1
        pairs = np.unique(text * self.count + self._order[at[found]])
        return pairs // self.count, pairs % self.count


def _codes(kind: np.ndarray, key: np.ndarray) -> np.ndarray:
    return (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + kind.astype(np.uint64)


def _spot(begin: np.ndarray) -> np.ndarray:
    return ((begin * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def _patterns(column: pa.Array, words: Words) -> np.ndarray:
    """Votes of the pattern voters, a row per text."""
    texts = pc.fill_null(column, "")
    upper = pc.count_substring_regex(texts, "[A-Z]").to_numpy(zero_copy_only=False)
    lower = pc.count_substring_regex(texts, "[a-z]").to_numpy(zero_copy_only=False)
    marks = pc.count_substring(texts, "!!").to_numpy(zero_copy_only=False)
    counts = np.diff(words.first)
    same = np.zeros(len(words.starts), np.int64)
    keys = words.prefix(slice(None), 8)
    same[1:] = keys[1:] == keys[:-1]
    runs = np.add.reduceat(np.append(same, 0), np.minimum(words.first[:-1], len(same))) if len(counts) else counts
    runs = np.where(counts > 0, runs, 0)
    return np.stack([upper > lower, marks >= 3, runs * 3 > counts, counts < 20], axis=1)


@dataclass
class Voters:
    terms: Terms

    @property
    def count(self) -> int:
        return self.terms.count + len(PATTERNS)

    def votes(self, column: pa.Array) -> np.ndarray:
        words = split_words(column)
        votes = np.zeros((len(column), self.count))
        text, term = self.terms.hits(words)
        votes[text, term] = 1
        votes[:, self.terms.count: -1] = _patterns(column, words)
        votes[:, -1] = votes[:, : self.terms.count].sum(axis=1) == 0
        return votes


@dataclass
class LabelModel:
    """How often each voter fires in either class, how much an independent voter it is worth, and the share of class 1."""

    fires: np.ndarray  # two rows
    worth: np.ndarray
    share: float

    def logit(self, votes: np.ndarray) -> np.ndarray:
        """A voter that does not fire abstains; that no lexicon term is there is a voter of its own."""
        says = np.log(self.fires[1] / self.fires[0])
        return np.log(self.share / (1 - self.share)) + votes @ (says * self.worth)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _logistic(self.logit(votes))

    def sums(self, votes: np.ndarray) -> np.ndarray:
        """What the next round needs of these votes: per class their number and how often each pair fires together."""
        p = self.posterior(votes)
        return np.stack([np.append(((v := votes * w[:, None]).T @ votes).ravel(), w.sum()) for w in (1 - p, p)])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _next_model(sums: np.ndarray, gold: np.ndarray) -> LabelModel:
    """The model that the expected counts of all documents and the labelled sample's counts give together."""
    both = sums + gold
    size = int(np.sqrt(both.shape[1] - 1))
    number = both[:, -1]
    together = both[:, :-1].reshape(2, size, size)
    fires = (together[:, np.arange(size), np.arange(size)] + 0.5) / (number[:, None] + 1)
    joint = (together + 0.25) / (number[:, None, None] + 1)
    deviation = np.sqrt(fires * (1 - fires))
    related = (joint - fires[:, :, None] * fires[:, None, :]) / (deviation[:, :, None] * deviation[:, None, :])
    # In each class by its weight; voters that fire together beyond what the class explains share their say.
    related = np.clip((related * number[:, None, None]).sum(axis=0) / max(number.sum(), 1), 0, 1)
    np.fill_diagonal(related, 0)
    return LabelModel(fires, 1 / (1 + related.sum(axis=1)), float((number[1] + 1) / (number.sum() + 2)))


def _linear(text: np.ndarray, term: np.ndarray, wanted: np.ndarray, features: int) -> np.ndarray:
    """Weights, and the bias last, of a logistic regression on soft labels; full-batch Adam, small ridge."""
    weights, first, second = (np.zeros(features + 1) for _ in range(3))
    rows = max(len(wanted), 1)
    share = np.clip((wanted.sum() + 1) / (len(wanted) + 2), 0.001, 0.999)
    weights[-1] = np.log(share / (1 - share))
    for step in range(1, 301):
        score = np.bincount(text, weights[term], len(wanted)) + weights[-1]
        error = _logistic(score) - wanted
        slope = np.append(np.bincount(term, error[text], features), error.sum()) / rows
        slope[:-1] += 2e-5 * weights[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def _scaling(logit: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make ``logit`` that of label 1 (Platt's method, with his smoothed labels)."""
    positive = toxic.sum()
    negative = len(toxic) - positive
    if positive == 0 or negative == 0:
        return 1.0, 0.0
    wanted = np.where(toxic > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    given = np.stack([logit, np.ones(len(logit))], axis=1)
    line = np.array([1.0, 0.0])
    for _ in range(100):
        p = _logistic(given @ line)
        curve = (given * (p * (1 - p))[:, None]).T @ given + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(curve, given.T @ (wanted - p)), -0.5, 0.5)
        line += step
        if np.abs(step).max() < 1e-8:
            break
    return (float(line[0]), float(line[1])) if line[0] > 0 else (1.0, 0.0)


def _scaled(text: np.ndarray, term: np.ndarray, wanted: np.ndarray, toxic: np.ndarray, features: int) -> np.ndarray:
    """The classifier of soft labels, scaled to the given ones."""
    weights = _linear(text, term, wanted, features)
    slope, shift = _scaling(np.bincount(text, weights[term], len(wanted)) + weights[-1], toxic)
    weights *= slope
    weights[-1] += shift
    return weights


@dataclass
class Classifier:
    terms: Terms
    weights: np.ndarray  # the bias last

    def score(self, column: pa.Array) -> np.ndarray:
        text, term = self.terms.hits(split_words(column))
        return _logistic(np.bincount(text, self.weights[term], len(column)) + self.weights[-1])


def _per_slice(column: str, compute: Callable[[pa.Array], Iterator[pa.RecordBatch]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, SLICE_BYTES):
                yield from compute(part)

    return run


def _term_counts(labelled: DataFrame) -> DataFrame:
    """``kind``, ``key``, and in how many of the labelled texts, and toxic ones, each term stands."""

    def count(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = split_words(part.column("text"))
        word, kind, key = (np.concatenate(p) for p in zip(_terms(words, np.arange(len(words.starts))), _grams(words)))
        text = np.searchsorted(words.first, word, side="right") - 1
        order = np.lexsort((text, key, kind))
        text, kind, key = text[order], kind[order], key[order]
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (kind[1:] != kind[:-1]) | (key[1:] != key[:-1])
        text, kind, key = text[fresh], kind[fresh], key[fresh]
        heads = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (key[1:] != key[:-1]))) if len(text) else np.zeros(0, int)
        toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[text]
        n = np.diff(np.append(heads, len(text)))
        pos = np.add.reduceat(toxic, heads) if len(heads) else heads
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind[heads]), pa.array(key[heads].view(np.int64)), pa.array(n), pa.array(pos)],
            names=["kind", "key", "n", "pos"],
        )

    found = labelled.mapInArrow(_per_slice("text", count), "kind bigint, key bigint, n bigint, pos bigint")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).filter(F.col("n") >= LEAST_ROWS)


def _bytes(key: int) -> bytes:
    return int(key & (2**64 - 1)).to_bytes(8, "little").rstrip(b"\0")


def _lexicons(ranked: list, limit: int) -> list:
    """The most telling terms that speak for toxicity, without those that merely shorten or lengthen a chosen one."""
    chosen: list = []
    for row in ranked:
        if row["z"] <= 0 or row["pos"] * 2 < row["n"]:
            continue
        mine = _bytes(row["key"])
        same = any(
            (mine.startswith(_bytes(c["key"])) or _bytes(c["key"]).startswith(mine)) and 0.7 < row["pos"] / c["pos"] < 1.4
            for c in chosen
        )
        if not same:
            chosen.append(row)
        if len(chosen) == limit:
            break
    return chosen


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
        fit_rows: int = FIT_ROWS, features: int = FEATURES, lexicons: int = LEXICONS, rounds: int = ROUNDS) -> Classifier:
    """Fit on the documents and those of their labels that are not held out."""
    spark = docs.sparkSession
    usable = labels.filter(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull() & ~held_out(F.col(id_col)))
    known = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
    known = materialize(known, "known")
    rows = known.count()
    part = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, fit_rows / max(rows, 1)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    named = texts.filter("id IS NOT NULL")
    labelled = sized_join(named, known, ["id"], "inner")
    sample = materialize(sized_join(named, known.filter(part), ["id"], "inner"), "sample")

    number = labelled.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    positive, total = number[0] or 0, number[1]
    counts = _term_counts(labelled.select("text", "toxic"))
    pos, neg = F.col("pos") + 0.5, F.col("n") - F.col("pos") + 0.5
    odds = F.log(pos / (positive + 1)) - F.log(neg / (total - positive + 1))
    ranked = counts.withColumn("z", odds / F.sqrt(1 / pos + 1 / neg))
    best = ranked.orderBy(F.desc(F.abs("z")), "kind", "key").limit(features).collect()

    chosen = _lexicons(best, lexicons)
    voters = Voters(Terms([r["kind"] for r in chosen], [r["key"] for r in chosen]))
    terms = Terms([r["kind"] for r in best], [r["key"] for r in best])
    shared = spark.sparkContext.broadcast((voters, terms))

    def look(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        voters, terms = shared.value
        column = part.column("text")
        text, term = terms.hits(split_words(column))
        bounds = np.searchsorted(text, np.arange(len(column) + 1))
        yield pa.RecordBatch.from_arrays(
            [part.column("toxic"), pa.array(list(voters.votes(column)), pa.list_(pa.float64())),
             pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(term, pa.int32()))],
            names=["toxic", "votes", "hits"],
        )

    seen = sample.select("text", "toxic").mapInArrow(
        _per_slice("text", look), "toxic int, votes array<double>, hits array<int>"
    ).toArrow()  # the sample only, some hundred numbers a row
    toxic = seen["toxic"].to_numpy().astype(np.float64)
    votes = np.array(seen["votes"].to_pylist(), np.float64).reshape(len(toxic), voters.count)
    gold = np.stack([np.append(((votes * w[:, None]).T @ votes).ravel(), w.sum()) for w in (1 - toxic, toxic)])
    model = _next_model(np.zeros_like(gold), gold)

    # The votes on all documents: equal votes are counted together first.
    def vote(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        votes = shared.value[0].votes(part.column("text")).astype(np.int64)
        masks, n = np.unique(votes @ (np.int64(1) << np.arange(votes.shape[1])), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(masks), pa.array(n)], names=["mask", "n"])

    patterns = texts.select("text").mapInArrow(_per_slice("text", vote), "mask bigint, n bigint")
    patterns = materialize(patterns.groupBy("mask").agg(F.sum("n").alias("n")), "votes")
    for _ in range(rounds):
        current = spark.sparkContext.broadcast((model, voters.count))

        def expect(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            model, count = current.value
            sums = np.zeros((2, count * count + 1))
            for batch in batches:
                masks, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float64)
                votes = ((masks[:, None] >> np.arange(count)) & 1).astype(np.float64)
                p = model.posterior(votes)
                for k, weight in enumerate((n * (1 - p), n * p)):
                    sums[k] += np.append(((votes * weight[:, None]).T @ votes).ravel(), weight.sum())
            yield pa.RecordBatch.from_arrays([pa.array([sums.ravel()], pa.list_(pa.float64()))], names=["sums"])

        found = patterns.mapInArrow(expect, "sums array<double>").collect()  # a row per task
        sums = sum((np.array(r["sums"]) for r in found), np.zeros(gold.size)).reshape(gold.shape)
        model = _next_model(sums, gold)

    trust = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
    wanted = _logistic(model.logit(votes) + np.where(toxic > 0, trust, -trust)) if len(toxic) else np.zeros(0)
    hits = seen["hits"].combine_chunks() if len(toxic) else pa.array([], pa.list_(pa.int32()))
    sizes = hits.value_lengths().to_numpy(zero_copy_only=False) if len(toxic) else np.zeros(0, np.int64)
    weights = _scaled(np.repeat(np.arange(len(sizes)), sizes), hits.flatten().to_numpy(), wanted, toxic, terms.count)
    return Classifier(terms, weights)


def scored(docs: DataFrame, model: Classifier, text_col: str = "text", out: str = "score") -> DataFrame:
    """The documents, all columns, with their score from 0 to 1; ``out`` must not be a column yet."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def score(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.score(part.column(text_col)))], names=schema.names)

    return docs.mapInArrow(_per_slice(text_col, score), schema)


def scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
           **options) -> DataFrame:
    """One row per document: the id, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    found = scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model)
    return found.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
           **options) -> DataFrame:
    """The documents, all columns, that score below ``threshold``."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    names = [f"c{k}" for k in range(len(docs.columns))]  # clashes with no working column
    found = scored(docs.toDF(*names), model, names[docs.columns.index(text_col)])
    return found.filter(F.col("score") < threshold).select(*names).toDF(*docs.columns)
