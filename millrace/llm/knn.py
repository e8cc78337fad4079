"""Exact top-k search by inner product as a Voronoi join.

Vectors are grouped by their nearest pivot. A group's summary is its radius, its greatest norm and the distances of its
innermost members; with the length of a query these bound the scores of the group from above and below. Every query first
meets its own group. Then it is sent only to groups whose upper bound reaches the k-th best score it is sure of, and
scores below that are not sent back. Queries are far fewer than vectors, so it is queries that are replicated; the vectors
move once, to their group. Large groups, and groups with many queries, are solved in parts.

Defined cases: rows whose id or vector is null, or whose vector holds a null or non-finite component, take no part; shorter
vectors count as filled up with zeros, an empty one scores 0; rows with the query's id are the query's own and no candidates;
repeated query rows are answered one by one; ties go to the smaller id; fewer candidates than ``k`` are all given. Scores are
64-bit; components whose products go beyond that are outside the contract.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize

SCALE = 1024
K = 10
# Pivots are the rows whose ids hash least: about the root of the row number, up to this many. Any choice gives the same rows.
MAX_PIVOTS = 1024
# Vectors, and queries, of one group that are solved in one piece.
PART = 4096


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component; null if the vector is null or a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(vectors: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Integer vectors as rows of a matrix with at least ``width`` columns, filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    wide = max(width, int(sizes.max(initial=0)))
    if (sizes == wide).all():
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of both; in floating point where all sums are exact there."""
    wide = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (a, b))
    top = [float(np.abs(m.astype(np.float64)).max(initial=0)) for m in (a, b)]
    if top[0] * top[1] * wide < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


@dataclass
class Cells:
    """Pivots and the summaries of their groups, ``MAX_PIVOTS`` rows at most."""

    pivots: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    inner: np.ndarray  # distances of the k + 1 innermost ids, each once, infinite where there are fewer
    ids: np.ndarray  # those ids
    used: np.ndarray

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every query the greatest score each group may hold, and a score that k candidates surely reach."""
        wide = max(queries.shape[1], self.pivots.shape[1])
        q, p = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))).astype(np.float64) for m in (queries, self.pivots))
        length = np.sqrt((q * q).sum(axis=1))[:, None]
        at = q @ p.T
        slack = 1e-9 * length * (np.sqrt((p * p).sum(axis=1))[None, :] + self.radius) + 1e-6
        upper = np.minimum(at + length * self.radius, length * self.norm) + slack
        upper[:, ~self.used] = -np.inf
        cell, rank = np.nonzero(np.isfinite(self.inner))
        order = np.argsort(self.ids[cell, rank], kind="stable")
        cell, rank = cell[order], rank[order]
        heads = np.flatnonzero(np.diff(self.ids[cell, rank], prepend=self.ids[cell[0], rank[0]] - 1)) if len(cell) else cell
        k = self.inner.shape[1]
        if len(heads) < k:
            return upper, np.full(len(q), -np.inf)
        sure = np.maximum.reduceat((at - slack)[:, cell] - length * self.inner[cell, rank][None], heads, axis=1)
        # One of k + 1 ids may be the query's own, none of whose rows is a candidate.
        return upper, np.partition(sure, -k, axis=1)[:, -k]


def _grouped(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``id``, ``vec``, the nearest pivot ``cell``, and the ``dist`` to it."""
    context = vectors.sparkSession.sparkContext
    shared = context.broadcast(pivots)
    schema = T.StructType([vectors.schema["id"], vectors.schema["vec"], T.StructField("cell", T.IntegerType()),
                           T.StructField("dist", T.DoubleType()), T.StructField("norm", T.DoubleType())])

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                v = _matrix(part.column("vec"), shared.value.shape[1]).astype(np.float64)
                p = np.pad(shared.value, ((0, 0), (0, v.shape[1] - shared.value.shape[1]))).astype(np.float64)
                cell = ((p * p).sum(axis=1)[None, :] - 2 * (v @ p.T)).argmin(axis=1)
                dist = np.sqrt(((v - p[cell]) ** 2).sum(axis=1))
                norm = np.sqrt((v * v).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vec"), pa.array(cell, pa.int32()), pa.array(dist), pa.array(norm)],
                    names=schema.names,
                )

    return materialize(vectors.mapInArrow(assign, schema), "cells")


def _summary(grouped: DataFrame, pivots: np.ndarray, k: int) -> tuple[Cells, dict[int, int]]:
    """The summaries of all groups and their sizes: at most one row per pivot and rank reaches the driver."""
    cells = Cells(pivots, np.zeros(len(pivots)), np.zeros(len(pivots)), np.full((len(pivots), k + 1), np.inf),
                  np.zeros((len(pivots), k + 1), np.int64), np.zeros(len(pivots), bool))
    sizes = {}
    totals = grouped.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("r"), F.max("norm").alias("top"))
    for row in totals.collect():
        cells.radius[row["cell"]], cells.norm[row["cell"]], cells.used[row["cell"]] = row["r"], row["top"], True
        sizes[row["cell"]] = row["n"]
    once = grouped.groupBy("cell", F.col("id").cast("bigint").alias("id")).agg(F.min("dist").alias("dist"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("dist", "id"))
    for row in once.withColumn("k", rank).filter(F.col("k") <= k + 1).collect():
        cells.inner[row["cell"], row["k"] - 1] = row["dist"]
        cells.ids[row["cell"], row["k"] - 1] = row["id"]
    return cells, sizes


_FOUND = "q bigint, vec_id bigint, score bigint"


def _solve(grouped: DataFrame, sent: DataFrame, sizes: dict[int, int], k: int) -> DataFrame:
    """The k best of every query in every group it was sent to, those below its ``least`` left out.

    ``sent`` has ``q``, ``query_id``, ``query``, ``least`` and ``cell``. A part of a group meets a part of its queries.
    """
    asked = {r["cell"]: r["n"] for r in sent.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = grouped.sparkSession.createDataFrame(
        [(c, math.ceil(sizes[c] / PART), math.ceil(n / PART)) for c, n in asked.items()], "cell int, dn int, qn int"
    )
    parts = F.broadcast(parts)  # a row per pivot
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1)
    data = grouped.select("id", "vec", "cell").join(parts, "cell").select(
        "cell", F.pmod(F.xxhash64("id"), "dn").alias("d"), F.explode(upto("qn")).alias("p"),
        F.col("id").cast("bigint").alias("id"), "vec",
    )
    asking = sent.join(parts, "cell").select(
        "cell", F.explode(upto("dn")).alias("d"),
        F.pmod(F.xxhash64("q"), "qn").alias("p"), "q", "query_id", "query", "least",
    )
    key = ["cell", "d", "p"]

    def solve(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if vectors.num_rows == 0 or queries.num_rows == 0:
            return pa.table({"q": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        vectors = vectors.sort_by("id")  # so that stable sorting leaves ties in order
        ids = vectors["id"].to_numpy()
        v = _matrix(vectors["vec"])
        out_q, out_id, out_score = [], [], []
        for at in range(0, queries.num_rows, 256):
            some = queries.slice(at, 256)
            scores = _products(_matrix(some["query"]), v)
            own = some["query_id"].to_numpy()[:, None] == ids[None, :]
            fit = ~own & (scores >= some["least"].to_numpy()[:, None])
            for row, q in enumerate(some["q"].to_pylist()):
                there = np.flatnonzero(fit[row])
                if len(there) > k:
                    limit = np.partition(scores[row, there], -k)[-k]
                    there = there[scores[row, there] >= limit]
                best = there[np.argsort(-scores[row, there], kind="stable")[:k]]
                out_q.append(np.full(len(best), q))
                out_id.append(ids[best])
                out_score.append(scores[row, best])
        return pa.table({n: pa.array(np.concatenate(x).astype(np.int64)) for n, x in
                         (("q", out_q), ("vec_id", out_id), ("score", out_score))})

    return data.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(solve, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = SCALE, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best of all other rows for every row with ``is_query``."""
    spark = vectors.sparkSession
    whole = vectors.select(F.col(id_col).alias("id"), integers(F.col(vector_col), scale).alias("vec"), is_query.alias("asks"))
    whole = materialize(whole.filter("id IS NOT NULL AND vec IS NOT NULL"), "vectors")
    rows = whole.count()
    count = max(1, min(max_pivots, math.isqrt(rows)))
    sample = whole.orderBy(F.xxhash64("id"), "id").limit(count).select("vec").collect()
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pivots = np.unique(_matrix(pa.array([r["vec"] for r in sample], pa.list_(pa.int64()))), axis=0)
    grouped = _grouped(whole.select("id", "vec"), pivots)
    cells, sizes = _summary(grouped, pivots, k)
    shared = spark.sparkContext.broadcast(cells)

    queries = whole.filter("asks").select(F.monotonically_increasing_id().alias("q"), F.col("id").cast("bigint").alias("query_id"), F.col("vec").alias("query"))
    queries = materialize(queries, "queries")

    def send(rest: bool):
        """The groups to send a query to: its own (the most promising one), or all others that may matter."""
        def choose(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64)
                    upper, sure = shared.value.bounds(_matrix(part.column("query")))
                    first = upper.argmax(axis=1)
                    least = np.where(np.isfinite(sure), np.ceil(sure), -(2.0**62))
                    if rest:
                        least = np.maximum(least, part.column("least").to_numpy())
                        wanted = upper >= least[:, None]
                        wanted[np.arange(len(first)), first] = False
                    else:
                        wanted = np.arange(upper.shape[1])[None, :] == first[:, None]
                    row, cell = np.nonzero(wanted)
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c).take(take) for c in ("q", "query_id", "query")],
                         pa.array(least[row].astype(np.int64)), pa.array(cell, pa.int32())],
                        names=["q", "query_id", "query", "least", "cell"],
                    )
        return choose

    schema = "q bigint, query_id bigint, query array<bigint>, least bigint, cell int"
    first = materialize(_best(_solve(grouped, queries.mapInArrow(send(False), schema), sizes, k), k), "first")
    sure = first.filter(F.col("rank") == k).select("q", F.col("score").cast("double").alias("least"))
    waiting = queries.join(sure, "q", "left").select("q", "query_id", "query", F.coalesce("least", F.lit(-(2.0**62))).alias("least"))
    second = _solve(grouped, materialize(waiting.mapInArrow(send(True), schema), "sent"), sizes, k)
    best = _best(first.drop("rank").unionByName(second), k)
    return best.join(queries.select("q", "query_id"), "q").select("query_id", "rank", "vec_id", "score")
