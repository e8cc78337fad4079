"""Globally shuffled shards by a two-pass external shuffle.

The first pass scatters the records over buckets by a seeded hash; a bucket fits in a task's memory. The second pass shuffles
each bucket by Fisher and Yates' method (Spark's ``shuffle``). Buckets one after the other are then a random order of all
records, which is cut into shards whose counts differ by one at most; a shard is written as it comes. Where a record lands
depends on the seed, the records and the number of buckets only: every bucket has a task of its own, is sorted before it is
shuffled, and its random numbers start from the seed and the bucket's number.

Defined cases: null and empty texts are records of size 1; a null id and equal ids are scattered by the text as well, and
rows that share both and would fill a bucket one by one; rows equal in all columns are interchangeable; an empty table gives no rows; fewer records than shards leave the last shards
empty or with one record less.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import hot_keys
from ..session import materialize

SHARDS = 16
SEED = 20240
# Bytes of records per bucket.
BUCKET_BYTES = 16 * 1024 * 1024
# A record in an array costs this much besides its text.
ROW_BYTES = 64
# A hash with fewer rows never fills a bucket.
HOT_ROWS = 20_000


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _scatter(hashed: DataFrame, buckets: int, min_rows: int = HOT_ROWS) -> DataFrame:
    """Put ``_bucket`` for ``_hash``. Rows of a hash that alone would fill a bucket are scattered by all their columns, and
    rows that share those too, which nothing tells apart, one by one."""
    rest = [c for c in hashed.columns if c != "_hash"]
    for more in ([*rest], [F.monotonically_increasing_id()]):
        hot = hot_keys(hashed, ["_hash"], 1 / buckets, min_rows)[0] if buckets > 1 else []
        if not hot:
            break
        is_hot = F.col("_hash").isin([key for key, in hot])
        hashed = hashed.withColumn("_hash", F.when(is_hot, F.xxhash64("_hash", *more)).otherwise(F.col("_hash")))
    return hashed.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int")).drop("_hash")


def shuffled(records: DataFrame, bucket: str, buckets: int, seed: int = SEED) -> DataFrame:
    """The records with ``_pos``, their 0-based place within their bucket after a Fisher-Yates shuffle."""
    columns = [c for c in records.columns if c != bucket]
    # A task per bucket, whose number is the bucket's.
    dealt = records.repartitionById(buckets, bucket)
    packed = dealt.groupBy(bucket).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("_all"))
    in_order = packed.sortWithinPartitions(bucket)
    mixed = in_order.select(bucket, F.shuffle("_all", seed).alias("_all"))
    return mixed.select(bucket, F.posexplode("_all").alias("_pos", "_row")).select(bucket, "_pos", "_row.*")


def assign(records: DataFrame, *, id_col: str, text_col: str, size: Column, shards: int = SHARDS, seed: int = SEED,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records with ``shard`` (counts at most one apart) and ``slot``, the place in it, without gaps from 0.

    ``size`` is the bytes that a record takes in memory. The columns must be orderable.
    """
    total = records.agg(F.sum(size + ROW_BYTES), F.count(F.lit(1))).first()
    rows = total[1]
    buckets = max(1, math.ceil((total[0] or 0) / bucket_bytes))
    scattered = _scatter(records.withColumn("_hash", F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))), buckets)
    placed = materialize(shuffled(scattered, "_bucket", buckets, seed), "shuffled")
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # One row per bucket.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = placed.join(F.broadcast(starts), "_bucket").withColumn("_at", F.col("_start") + F.col("_pos"))
    shard = F.expr(f"_at * {shards} div {max(rows, 1)}")
    first = F.expr(f"(shard * {rows} + {shards} - 1) div {shards}")
    return (
        at.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("_at") - first).cast("bigint"))
        .drop("_bucket", "_pos", "_start", "_at")
    )


def shards(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", count: int = SHARDS, seed: int = SEED,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The documents, all columns, with ``shard`` and ``slot`` after them."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # clashes with no working column
    of = dict(zip(docs.columns, names))
    size = F.lit(0)
    for name, kind in zip(names, docs.dtypes):
        size = size + (F.coalesce(F.octet_length(name), F.lit(0)) if kind[1] in ("string", "binary") else F.lit(16))
    found = assign(docs.toDF(*names), id_col=of[id_col], text_col=of[text_col], size=size.cast("bigint"), shards=count,
                   seed=seed, bucket_bytes=bucket_bytes)
    return found.select(*names, "shard", "slot").toDF(*docs.columns, "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write ``<path>/shard=<n>``, the records of each file in slot order.

    A bucket's records lie next to each other in the global order, so a task writes to one or two shards.
    """
    placed = shards(docs, **options)
    tasks = placed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = placed.repartitionByRange(int(tasks), "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Ids, sizes and checksums in their shards, without moving the texts."""
    narrow = materialize(docs.select(
        F.col(id_col).alias("id"), record_size(F.col(text_col)).alias("size"), F.crc32(text_col).alias("text_crc32"),
        F.xxhash64(text_col).alias("text_hash"),
    ), "records")
    return assign(narrow, id_col="id", text_col="text_hash", size=F.lit(64), **options).drop("text_hash")
