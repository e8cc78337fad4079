"""Joins that check sizes before they broadcast and keep hot keys out of the shuffle."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

# A broadcast table is held by the driver and by every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more than this share of the rows is hot, so there can be at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.005
# Below this many rows a key is never worth special treatment.
HOT_ROWS = 1_000_000

_JOIN_TYPES = ("inner", "left", "left_semi", "left_anti")


def _value_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """Bytes ``df`` takes as rows in memory, measured by one aggregate over it."""
    per_row = sum((_value_bytes(f) for f in df.schema.fields), F.lit(16))
    return int(df.agg(F.sum(per_row.cast("bigint"))).first()[0] or 0)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def splits_skew(spark: SparkSession) -> bool:
    """Whether adaptive execution splits skewed joins here, even where that costs another shuffle later on."""
    return all(
        spark.conf.get(f"spark.sql.adaptive.{name}").lower() == "true"
        for name in ("enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin")
    )


def _any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | F.col(key).isNull()
    return found


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS
) -> tuple[list[tuple], bool]:
    """The keys with more than ``share`` of the rows, and whether null keys are that many.

    The counts are combined before the shuffle, so a hot key costs no more than any other. What reaches the driver is
    at most 1 / share keys, which is all there can be.
    """
    seen = Observation()
    watched = df.select(*keys).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(_any_null(keys), 1)).alias("nulls")
    )
    top = (
        watched.filter(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n")).limit(math.ceil(1 / share)).collect()
    )
    if not top:
        # No row, or none with a key; an empty plan may have been cut down to nothing, counters included.
        return [], df.filter(_any_null(keys)).count() > min_rows
    floor = max(min_rows, share * seen.get["rows"])
    return [tuple(row)[:-1] for row in top if row["_n"] > floor], seen.get["nulls"] > floor


def sized_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    small: bool | None = None,
    skewed: bool = True,
    broadcast_bytes: int | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a large left side with a right side of unknown size.

    A right side that is measured to be small is broadcast. Otherwise the join shuffles, and a hot key must not end up in
    one task. Where the session lets adaptive execution split any skewed join, that does it, by the sizes it meets and
    at no cost without skew. Elsewhere the left keys are counted first, and left rows with a hot or null key stay where
    they are: their few right rows are broadcast.

    ``small`` skips the measurement when the caller already knows, and ``skewed=False`` the search for hot keys when a
    left key has a bounded number of rows. A stream can be searched only inside foreachBatch; as a plain streaming left
    side it is joined as it is.
    """
    if how not in _JOIN_TYPES:
        raise ValueError(f"how must be one of {_JOIN_TYPES}")
    on = list(on)
    if small is None:
        small = fits_broadcast(right, broadcast_bytes)
    if small:
        return left.join(F.broadcast(right), on, how)
    if left.isStreaming or not skewed or splits_skew(left.sparkSession):
        return left.join(right, on, how)

    hot, many_nulls = hot_keys(left, on, share, min_rows)
    if not hot and not many_nulls:
        return left.join(right, on, how)

    key_schema = T.StructType([left.schema[k] for k in on])
    hot_rows = left.sparkSession.createDataFrame(hot, key_schema)  # at most 1 / share rows
    hot_right = right.join(F.broadcast(hot_rows), on, "left_semi")
    if not fits_broadcast(hot_right):
        return left.join(right, on, how)  # few keys with very many or very wide right rows

    no_key = _any_null(on)
    flagged = left.join(F.broadcast(hot_rows.withColumn("_hot", F.lit(True))), on, "left")
    stays = no_key | F.coalesce(F.col("_hot"), F.lit(False))
    staying, moving = (flagged.filter(c).select(left.columns) for c in (stays, ~stays))
    return staying.join(F.broadcast(hot_right), on, how).unionByName(moving.join(right, on, how))
