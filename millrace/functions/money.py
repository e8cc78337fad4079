"""Exact money arithmetic in decimals."""

from pyspark.sql import Column, functions as F

from ..constants import MONEY


def percent_rate(rate: Column) -> Column:
    """A percentage, given as text or number, as an exact decimal percentage; missing counts as 0."""
    return F.coalesce(rate.try_cast("decimal(9,4)"), F.lit(0).cast("decimal(9,4)"))


def fraction(rate: Column) -> Column:
    """Percent to fraction: 40 gives 0.40."""
    return percent_rate(rate) * F.lit("0.01").cast("decimal(3,2)")


def share(amount: Column, rate: Column) -> Column:
    """The part of ``amount`` that a percentage stands for, rounded half up to two digits."""
    return (amount.cast(MONEY) * fraction(rate)).cast(MONEY)
