"""How far a group of consumers has come in its topics, kept beside any checkpoint."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..streaming.once import committed_versions, job_id, read_committed, write_batch_once

_SCHEMA = "topic string, partition int, next long"


@dataclass(frozen=True)
class GroupOffsets:
    """The next offset of every partition that the group has worked through, one small table that each batch replaces.

    A restarted query goes on from its checkpoint. A query with a *new* checkpoint starts where the group has come to,
    whichever query brought it there. Batches need the columns ``topic`` and ``offset``, and ``partition`` if
    there are several; of a folder topic the version that wrote a record is its offset. The offsets are committed when the
    batch's work is done, so a batch that failed in between is worked through again.
    """

    path: str
    group: str

    @property
    def _folder(self) -> str:
        return f"{self.path.rstrip('/')}/{self.group}"

    def positions(self, spark: SparkSession) -> dict[str, dict[int, int]]:
        """By topic and partition; one row each is read."""
        found: dict[str, dict[int, int]] = {}
        for topic, partition, after in read_committed(spark, self._folder, _schema(spark)).select("topic", "partition", "next").collect():
            found.setdefault(topic, {})[partition] = after
        return found

    def starting(self, spark: SparkSession, topic: str) -> str | None:
        """What Kafka's ``startingOffsets`` takes; None if the group has not begun. New partitions start at the earliest."""
        mine = self.positions(spark).get(topic)
        return json.dumps({topic: {str(p): n for p, n in sorted(mine.items())}}) if mine else None

    def commit(self, batch: DataFrame, batch_id: int) -> bool:
        spark = batch.sparkSession
        place = F.col("batch") if "batch" in batch.columns else F.col("offset")
        partition = F.col("partition").cast("int") if "partition" in batch.columns else F.lit(0)
        ends = batch.groupBy("topic", partition.alias("partition")).agg((F.max(place) + 1).alias("next"))
        known = read_committed(spark, self._folder, _schema(spark)).select("topic", "partition", "next")
        merged = known.unionByName(ends).groupBy("topic", "partition").agg(F.max("next").alias("next")).coalesce(1)
        return write_batch_once(merged, self._folder, batch_id, job=job_id(spark), drops=committed_versions(spark, self._folder))

    def tracked(self, work: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """``work`` on a source's batches, with the offsets committed after each."""
        def run(batch: DataFrame, batch_id: int) -> None:
            work(batch, batch_id)
            self.commit(batch, batch_id)

        return run


def _schema(spark: SparkSession):
    return spark.createDataFrame([], _SCHEMA).schema
