"""Small text helpers. All are plain column expressions."""

from pyspark.sql import Column, functions as F

from ..constants import NO_INFO


def is_empty(c: Column) -> Column:
    """True for null and for the empty string."""
    return c.isNull() | (c == "")


def check_string(c: Column) -> Column:
    """Null, the empty string and an empty JSON array become the "no info" text."""
    return F.when(is_empty(c) | (c == "[]"), F.lit(NO_INFO)).otherwise(c)


def str_to_int(c: Column) -> Column:
    """Empty becomes 0; text that is no integer becomes null."""
    return F.when(is_empty(c), F.lit(0)).otherwise(c.try_cast("int"))


def split_cols(c: Column) -> Column:
    """A comma-separated column list as an array. Trailing empty entries are dropped."""
    return F.split(F.regexp_replace(c, ",+$", ""), ",")


def join_address(scene: Column, ground: Column) -> Column:
    """Scene address followed by the ground name, with missing parts left out."""
    return F.concat(F.coalesce(scene, F.lit("")), F.coalesce(ground, F.lit("")))
