"""Cleansing of dimension columns and the presets per dimension table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as C
from . import address, dates


def singer_name(c: Column) -> Column:
    """Name of the first singer in a JSON array."""
    return F.coalesce(F.get_json_object(c, "$[0].name"), F.lit(C.UNKNOWN_SINGER))


def album_name(c: Column) -> Column:
    """Name of the first album in a JSON array, else the first title in book marks, marks included."""
    title = F.nullif(F.regexp_extract(c, "《[^》]*》", 0), F.lit(""))
    return F.coalesce(F.get_json_object(c, "$[0].name"), title, F.lit(C.NO_ALBUM))


def company_name(c: Column) -> Column:
    """Name in a JSON object that describes the licensing company."""
    return F.coalesce(F.get_json_object(c, "$.name"), F.lit(C.DEFAULT_COMPANY))


def _present(df: DataFrame, fixes: dict[str, Column]) -> DataFrame:
    return df.withColumns({name: fix for name, fix in fixes.items() if name in df.columns})


def clean_song(df: DataFrame) -> DataFrame:
    return _present(df, {
        "album": album_name(F.col("album")),
        "singer_info": singer_name(F.col("singer_info")),
        "post_time": dates.format_date(F.col("post_time")),
        "authorized_company": company_name(F.col("authorized_company")),
    })


def clean_machine_local(df: DataFrame) -> DataFrame:
    return _present(df, {
        "province": address.repair(F.col("province"), address.province(F.col("address"))),
        "city": address.repair(F.col("city"), address.city(F.col("address"))),
    })


# Tables without an entry are stored as they come.
CLEANSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    C.DIM_SONG: clean_song,
    C.DIM_MACHINE_LOCAL: clean_machine_local,
}


def cleanse(df: DataFrame, table: str) -> DataFrame:
    return CLEANSERS.get(table, lambda same: same)(df)
