"""The table that says which source tables matter and where their changes go."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..constants import CONFIG_SCHEMA
from ..operators.latest import latest_by_key
from ..streaming.log import CommitLog
from ..streaming.once import job_id, read_committed, write_batch_once

ConfigLoader = Callable[[SparkSession], DataFrame]


def config_from_parquet(path: str) -> ConfigLoader:
    """Reads the table anew on each call, so a running stream sees changes with its next batch."""
    return lambda spark: spark.read.schema(CONFIG_SCHEMA).parquet(path)


def jdbc_options(url: str, user: str, password: str, table: str = "tbl_config_info") -> dict[str, str]:
    return {"url": url, "user": user, "password": password, "dbtable": table}


def config_from_jdbc(options: Mapping[str, str]) -> ConfigLoader:
    return lambda spark: spark.read.format("jdbc").options(**options).load().select(CONFIG_SCHEMA.names)


def config_from_rows(rows) -> ConfigLoader:
    return lambda spark: spark.createDataFrame(rows, CONFIG_SCHEMA)


@dataclass(frozen=True)
class ConfigHistory:
    """The configuration as a job has come to know it: rows are put in by source table, and never go.

    What the table says at a batch is compared with what is known, and new and changed rows, if any, are kept as the next
    version. A row that left the table stays in force. A batch meets the newest rows of its own version and those before, also
    when it is replayed after the table has changed.
    """

    path: str
    key: tuple[str, str] = ("tbl_db", "tbl_name")

    def _known(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        schema = T.StructType([*CONFIG_SCHEMA, T.StructField("batch", T.LongType())])
        rows = read_committed(spark, self.path, schema)
        if version is not None:
            rows = rows.filter(F.col("batch") <= version)
        return latest_by_key(rows, list(self.key), ["batch"]).select(CONFIG_SCHEMA.names)

    def at(self, now: DataFrame, batch_id: int, *, job: str | None = None) -> DataFrame:
        """The configuration in force for a batch, which sees the table as ``now``."""
        spark = now.sparkSession
        job = job_id(spark) if job is None else job
        done = CommitLog(spark, self.path).state()["jobs"].get(job)
        if done is None or done[0] < batch_id:
            # Of several rows for one table the same one counts on every run.
            given = latest_by_key(now.select(CONFIG_SCHEMA.names), list(self.key), ["sink_topic"]).select(CONFIG_SCHEMA.names)
            write_batch_once(given.exceptAll(self._known(spark)), self.path, batch_id, job=job)
            done = CommitLog(spark, self.path).state()["jobs"][job]
        elif done[0] > batch_id:
            raise ValueError(f"batch {batch_id} of {job} comes after batch {done[0]}")
        return self._known(spark, done[1])
