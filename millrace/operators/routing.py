"""Splitting one log into routes by event type."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import constants as C
from .parse import drop_fields, json_fields, parse_json, without_nulls

OTHER = "other"
MALFORMED = "malformed"


@dataclass(frozen=True)
class Route:
    """Where events of one type go.

    ``body`` says what is forwarded: "content" is the nested event body, "untyped" the event without its type and
    "raw" the text as it came. ``key`` is the field of the forwarded text that becomes the record key.
    """

    name: str
    event_type: str
    topic: str
    body: str = "raw"
    key: str | None = None


PLAY_ROUTE = Route("play", C.PLAY_EVENT, C.DWD_PLAY, "content", "uid")
LOGIN_ROUTE = Route("login", C.LOGIN_EVENT, C.DWD_LOGIN, "untyped", "mid")
THREE_WAY = (PLAY_ROUTE, LOGIN_ROUTE)
TWO_WAY = (Route("play", C.PLAY_EVENT, C.DWD_PLAY, "content", "mid"),)

_ENVELOPE = T.StructType([T.StructField(n, T.StringType()) for n in ("event_type", "event_content")])


def _body(route: Route) -> Column:
    if route.body == "content":
        return F.col("event_content")
    if route.body == "untyped":
        return F.to_json(without_nulls(drop_fields(json_fields(F.col("value")), "event_type")))
    return F.col("value")


def route_events(
    df: DataFrame, routes: Sequence[Route] = THREE_WAY, other_topic: str = C.DWD_OTHER, malformed_topic: str = MALFORMED
) -> DataFrame:
    """Columns ``route, topic, key, value``: every row of ``df.value`` goes to exactly one route.

    Unknown and missing event types go to "other". Text that is no JSON object goes to "malformed". A missing key field
    gives a null key. Works on batch and streaming input alike, in one pass.
    """
    seen = parse_json(df, _ENVELOPE, keep=["value"], malformed="_malformed")
    bad = F.col("_malformed").isNotNull() | F.col("value").isNull()

    def pick(per_route, bad_value, other_value) -> Column:
        chain = F.when(bad, bad_value)
        for route in routes:
            chain = chain.when(F.col("event_type") == route.event_type, per_route(route))
        return chain.otherwise(other_value)

    routed = seen.select(
        "value", "event_type", "event_content",
        pick(lambda r: F.lit(r.name), F.lit(MALFORMED), F.lit(OTHER)).alias("route"),
        pick(lambda r: F.lit(r.topic), F.lit(malformed_topic), F.lit(other_topic)).alias("topic"),
        pick(_body, F.col("value"), F.col("value")).alias("_body"),
    )
    key = F.lit(None).cast("string")
    for route in routes:
        if route.key:
            key = F.when(F.col("route") == route.name, F.get_json_object("_body", f"$.{route.key}")).otherwise(key)
    return routed.select("route", "topic", key.alias("key"), F.col("_body").alias("value"))


def only(routed: DataFrame, route: str) -> DataFrame:
    return routed.filter(F.col("route") == route)
