"""Mart rows and daily roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import constants as C
from ..functions import dates, money
from ..functions.text import join_address
from .windows import event_time, tumbling_count

SONG_KEYS = {"song_id": "songid", "song_name": "songname", "singer_name": "singer_info"}
LOGIN_KEYS = ("province", "city", "district", "lng", "lat")
SHARES = ("inv", "age", "com", "par")


def song_heat(plays: DataFrame, *, size: str = "5 seconds", delay: str = "3 seconds") -> DataFrame:
    """Plays per song, and in the same window plays of its singer with that song (always the same number)."""
    timed = plays.withColumn("_ts", event_time("time"))
    return tumbling_count(
        timed, "_ts", SONG_KEYS, size=size, delay=delay, counts=("song_playtimes", "singer_playtimes")
    )


def login_heat(
    logins: DataFrame, *, keys: Sequence[str] = LOGIN_KEYS, size: str = "5 seconds", delay: str = "3 seconds"
) -> DataFrame:
    timed = logins.withColumn("_ts", event_time("login_dt"))
    return tumbling_count(timed, "_ts", keys, size=size, delay=delay, counts=("login_times",))


def order_revenue(orders: DataFrame, *, dt_from: str = "bill_date", address_from: str = "contract") -> DataFrame:
    """One mart row per wide order: the amount and what each of the four parties gets of it.

    ``data_dt`` is the bill date as it is or, with ``dt_from="action_time"``, the date of an action time that is
    either epoch milliseconds or ``yyyyMMddHHmmss``. ``address_from="place"`` takes the ``address`` that the place
    dimension gave the order instead of the contract's scene.
    """
    if address_from not in ("contract", "place"):
        raise ValueError("address_from must be 'contract' or 'place'")
    address = join_address(F.col("scene_address"), F.col("ground_name")) if address_from == "contract" else F.col("address")
    if dt_from == "bill_date":
        data_dt = F.col("bill_date")
    elif dt_from == "action_time":
        text = F.col("action_time")
        compact = F.when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
        data_dt = F.coalesce(F.date_format(compact, C.DATE_FORMAT), dates.epoch_date(text.try_cast("bigint")))
    else:
        raise ValueError("dt_from must be 'bill_date' or 'action_time'")
    return orders.select(
        "province", "city",
        address.alias("address"),
        F.col("mid").cast("string").alias("mid"),
        "machine_name", "pkg_name",
        F.col("amount").cast(C.MONEY).alias("amount"),
        *[money.share(F.col("amount"), F.col(f"{s}_rate")).alias(f"{s}_rev") for s in SHARES],
        data_dt.alias("data_dt"),
    )


def rollup_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum the measures over rows that agree in the keys. Roll-ups of roll-ups give the same sums."""
    return df.groupBy(*keys).agg(*[F.sum(m).cast(df.schema[m].dataType).alias(m) for m in measures])


def song_daily(heat: DataFrame) -> DataFrame:
    return rollup_sum(heat, ["data_dt", *SONG_KEYS], ["song_playtimes", "singer_playtimes"])


def singer_daily(heat: DataFrame) -> DataFrame:
    return rollup_sum(heat, ["data_dt", "singer_name"], ["singer_playtimes"])


def login_daily(heat: DataFrame, keys: Sequence[str] = LOGIN_KEYS) -> DataFrame:
    return rollup_sum(heat, ["data_dt", *keys], ["login_times"])


def revenue_by_region(revenue: DataFrame, keys: Sequence[str] = ("province", "city")) -> DataFrame:
    return rollup_sum(revenue, list(keys), ["amount", *[f"{s}_rev" for s in SHARES]])
