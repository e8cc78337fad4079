"""Dimension lookups that fall back to default values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .. import constants as C
from .joins import fits_broadcast, sized_join
from .latest import latest_by_key


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    columns: Sequence[str] | Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
    *,
    default: object = C.NO_INFO,
    how: str = "left",
    latest: Sequence[str] | None = None,
    unique: bool = False,
    **join_options,
) -> DataFrame:
    """Add ``columns`` of ``dim`` to ``df`` where ``on = (column of df, column of dim)`` match.

    With ``how="left"`` a row without a match gets the defaults; a match whose column is null stays null. With
    ``how="inner"`` a row without a match is dropped. A column that ``df`` already has is overwritten. A row never
    meets more than one of ``dim``: of several with its key the last by ``latest`` counts, and of these the greatest by
    content. ``unique`` says that ``dim`` has one row per key, as a snapshot does, and saves looking.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    wanted = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    fact_key, dim_key = on
    if latest or not unique:
        needed = list(dict.fromkeys([dim_key, *(latest or ()), *wanted.values()]))
        dim = dim.select(needed)
        # Measured before the latest rows are found, which would only be done twice; if these fit, so do those.
        if join_options.get("small") is None and fits_broadcast(dim, join_options.get("broadcast_bytes")):
            join_options["small"] = True
        dim = latest_by_key(dim, [dim_key], latest or [])
    if df.schema[fact_key].dataType == dim.schema[dim_key].dataType:
        # Joining on the column itself lets a second lookup by it reuse the partitioning.
        left, key, dim_value = df, fact_key, F.col(dim_key)
    else:
        left, key, dim_value = df.withColumn("_lookup", F.col(fact_key).cast("string")), "_lookup", F.col(dim_key).cast("string")
    side = dim.filter(F.col(dim_key).isNotNull()).select(
        dim_value.alias(key),
        F.lit(True).alias("_hit"),
        *[F.col(source).alias(f"_dim_{name}") for name, source in wanted.items()],
    )
    joined = sized_join(left, side, [key], how, **join_options)
    fallback = {name: (defaults or {}).get(name, default) for name in wanted}
    added = {
        name: F.col(f"_dim_{name}") if how == "inner"
        else F.when(F.col("_hit"), F.col(f"_dim_{name}")).otherwise(F.lit(fallback[name]))
        for name in wanted
    }
    kept = [c for c in df.columns if c not in wanted]
    return joined.select(*kept, *[expr.alias(name) for name, expr in added.items()])


def song_play_wide(
    plays: DataFrame, songs: DataFrame, columns: Sequence[str] = ("singer_info",), **options
) -> DataFrame:
    """Plays with song information, by song id."""
    return lookup_join(plays, songs, ("songid", "source_id"), columns, **options)


def order_wide(
    orders: DataFrame,
    locations: DataFrame,
    contracts: DataFrame,
    *,
    location_columns: Sequence[str] = tuple(C.LOCATION_COLUMNS),
    contract_columns: Sequence[str] = tuple(C.CONTRACT_COLUMNS),
    strict: bool = False,
    **options,
) -> DataFrame:
    """Orders with the place and the contract of their machine.

    ``strict`` keeps only orders where both are known: a match whose province or investor's rate is null does not count.
    """
    how = "inner" if strict else "left"
    if strict:
        locations, contracts = locations.filter("province IS NOT NULL"), contracts.filter("inv_rate IS NOT NULL")
    keyed = orders.withColumn("_mid", F.col("mid").cast("string"))
    placed = lookup_join(keyed, locations, ("_mid", "mid"), location_columns, how=how, **options)
    contracted = lookup_join(
        placed, contracts, ("_mid", "machine_num"), contract_columns, C.RATE_DEFAULTS, how=how, **options
    )
    return contracted.drop("_mid")
