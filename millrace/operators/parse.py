"""From JSON text to typed columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_BAD = "_bad_text"


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    column: str = "value",
    *,
    number_default: int | None = 0,
    keep: Sequence[str] = (),
    malformed: str | None = None,
) -> DataFrame:
    """Read ``column`` as JSON into the columns of ``schema``, next to the ``keep`` columns.

    A string column takes a nested object as its JSON text. A number may be quoted and may have a fraction, which a whole
    number loses. A missing or unreadable number becomes ``number_default``; pass None to keep it null. ``malformed``
    names an extra column that holds text which is not a JSON object.
    """
    numeric = [isinstance(f.dataType, T.NumericType) for f in schema.fields]
    # Numbers are read as text first, however they are spelled.
    read_as = [T.StructField(f.name, T.StringType() if n else f.dataType) for f, n in zip(schema.fields, numeric)]
    fields = T.StructType([*read_as, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    # Filters are not moved below an explode, so a filter on a parsed field does not parse the text a second time.
    parsed = df.withColumn("_json", F.explode(F.array(F.from_json(column, fields, options))))

    def read(field: T.StructField) -> Column:
        value = F.col("_json")[field.name]
        if isinstance(field.dataType, T.IntegralType):
            value = value.try_cast("decimal(38,6)").try_cast(field.dataType)
        elif isinstance(field.dataType, T.NumericType):
            value = value.try_cast(field.dataType)
        if number_default is not None and isinstance(field.dataType, T.NumericType):
            value = F.coalesce(value, F.lit(number_default).cast(field.dataType))
        return value.alias(field.name)

    bad = F.col("_json").isNull() | F.col("_json")[_BAD].isNotNull()
    extra = [F.when(bad, F.col(column)).alias(malformed)] if malformed else []
    return parsed.select(*keep, *[read(f) for f in schema.fields], *extra)


def json_fields(text: Column) -> Column:
    """A JSON object as a map from field name to value, the last one of a repeated name; null for anything else."""
    entries = F.map_entries(F.from_json(text, "map<string,variant>"))

    def is_last(entry: Column, place: Column) -> Column:
        after = F.slice(entries, place + 2, F.size(entries))
        return ~F.exists(after, lambda other: other["key"] == entry["key"])

    return F.map_from_entries(F.filter(entries, is_last))


def put_fields(text: Column, **added: Column) -> Column:
    """Set text fields of a JSON object given as text; null for anything else. Null values are left out.

    The new fields are appended to the text, and what is there keeps its spelling. Only where one of the names stands in the
    object already, a name stands there twice, or a null would have to go, is the object taken apart and put together again.
    """
    names = list(added)
    rest = F.map_filter(json_fields(text), lambda name, _: ~name.isin(names))
    pairs = F.map_from_entries(F.array(*[F.struct(F.lit(n), v.cast("string").cast("variant")) for n, v in added.items()]))
    rebuilt = F.map_concat(rest, F.map_filter(pairs, lambda _, value: value.isNotNull()))

    def put(there: Column) -> Column:
        """``there`` are the names in the object, read once."""
        rebuild = (
            ~(text.startswith("{") & text.endswith("}")) | there.isNull() | F.arrays_overlap(there, F.array(*map(F.lit, names)))
            | (F.size(F.array_distinct(there)) < F.size(there)) | (text.contains("null") & text.rlike(r":\s*null\s*[,}]"))
        )
        tail = F.to_json(F.struct(*[v.cast("string").alias(n) for n, v in added.items()]))  # without the null ones
        appended = F.concat(
            F.left(text, F.length(text) - 1), F.when(F.size(there) == 0, F.lit("")).otherwise(F.lit(",")),
            F.substring(tail, 2, 2**31 - 1),
        )
        none = F.coalesce(*[v.cast("string") for v in added.values()]).isNull()
        return F.when(rebuild, F.to_json(without_nulls(rebuilt))).when(none, text).otherwise(appended)

    return F.transform(F.array(F.json_object_keys(text)), put)[0]


def drop_fields(fields: Column, *names: str) -> Column:
    return F.map_filter(fields, lambda name, _: ~name.isin(list(names)))


def without_nulls(fields: Column) -> Column:
    return F.map_filter(fields, lambda _, value: ~F.is_variant_null(value))


def to_records(df: DataFrame, key: str | None = None, topic: str | None = None) -> DataFrame:
    """All columns as one JSON text ``value``, with an optional key column and topic."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != "topic"]))
    return df.select(
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        value.alias("value"),
        (F.lit(topic) if topic else F.col("topic")).cast("string").alias("topic"),
    )
