"""Latest row per key, the meaning of an upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``order`` for each key. Null columns of that row stay null.

    An aggregate and not a ranking: rows of one key are combined before the shuffle, so a key with a third of all
    changes sends one row per task. Rows equal in ``order`` are told apart by their other columns, which makes the
    result the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order and _orderable(df.schema[c].dataType)]
    if all(_orderable(df.schema[c].dataType) for c in rest):
        picked = F.max(F.struct(*order, *[c for c in rest if c not in order]))
    else:
        picked = F.max_by(F.struct(*rest), F.struct(*order, *tie))
    found = df.groupBy(*keys).agg(picked.alias("_row"))
    return found.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
