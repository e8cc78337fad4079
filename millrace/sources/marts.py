"""Sinks for mart tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from .. import constants as C
from ..streaming.once import read_committed, write_batch_once

# The columns each mart is sorted by.
MART_ORDER = {
    C.MART_SONG_HOT: ("song_id", "song_name", "singer_name"),
    C.MART_LOGIN: ("province",),
    C.MART_ORDER: ("province", "city"),
}


def _laid_out(df: DataFrame, date: str, order: Sequence[str]) -> DataFrame:
    """Rows of one date together and sorted for row-group skipping, in evenly sized files.

    The rebalance is a request, not a fixed partitioning: adaptive execution splits a date that holds most of the rows
    and merges dates that hold few.
    """
    return df.hint("rebalance", date).sortWithinPartitions(date, *order)


@dataclass(frozen=True)
class ParquetMarts:
    """``<root>/<table>/batch=<id>/data_dt=<date>``; each batch is written once.

    With ``date_folders=False`` the dates of a batch share files, sorted by date. That suits back-fills, whose batches
    span so many dates that each would leave a tiny file per date.
    """

    root: str
    date: str = "data_dt"
    date_folders: bool = True

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        laid_out = _laid_out(df, self.date, MART_ORDER.get(table, ()))
        write_batch_once(laid_out, self.path(table), batch_id, [self.date] if self.date_folders else [])

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
        """All committed batches. ``schema`` gives the columns of an empty table before the first."""
        if schema is None:
            schema = read_committed(spark, self.path(table)).schema
        # Dates are text in the marts, whatever partition names look like.
        names = [T.StructField(f.name, T.StringType() if f.name == self.date else f.dataType) for f in schema]
        return read_committed(spark, self.path(table), T.StructType(names)).drop("batch")


@dataclass(frozen=True)
class JdbcMarts:
    """Appends to database tables, ``batch_rows`` rows per statement batch. Delivers at least once."""

    url: str
    driver: str
    batch_rows: int = 50
    max_connections: int = 16
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url, "driver": self.driver, "dbtable": table,
            "batchsize": str(self.batch_rows), "numPartitions": str(self.max_connections), **self.properties,
        }

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        df.write.format("jdbc").options(**self.options(table)).mode("append").save()


@dataclass(frozen=True)
class ConsoleMarts:
    """Prints the schema once per batch and shows the rows, for debugging."""

    rows: int = 20

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        print(f"{table} batch {batch_id}")
        df.printSchema()
        df.show(self.rows, truncate=False)
