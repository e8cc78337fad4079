"""Topics: streams of (key, value, topic) text records, in Kafka or in a shared folder."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..constants import RECORD_SCHEMA
from ..streaming.once import read_committed, write_batch_once
from .offsets import GroupOffsets

# ``offset`` is the place of a record in its batch, so that batch and offset tell in which order records arrived.
_STORED_SCHEMA = T.StructType([*RECORD_SCHEMA.fields, T.StructField("offset", T.LongType()), T.StructField("batch", T.LongType())])


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on a Kafka cluster. Needs Spark's Kafka connector on the class path.

    A new stream starts where its ``group`` has come to, else at the earliest record or, with ``from_earliest=False``, at the
    end; a restarted one goes on from its checkpoint. The sink honours a topic per record and delivers at least once.
    """

    servers: str
    from_earliest: bool = True
    max_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def source_options(self, topic: str, starting: str | None = None) -> dict[str, str]:
        found = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": topic,
            "startingOffsets": starting or ("earliest" if self.from_earliest else "latest"),
        }
        if self.max_per_trigger:
            found["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        return {**found, **self.options}

    def sink_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, **self.options}

    def read_stream(self, spark: SparkSession, topic: str, group: GroupOffsets | None = None) -> DataFrame:
        starting = group.starting(spark, topic) if group else None
        raw = spark.readStream.format("kafka").options(**self.source_options(topic, starting)).load()
        return raw.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})

    def write_stream(self, records: DataFrame, name: str, checkpoint: str):
        return (
            records.select("key", "value", "topic").writeStream.format("kafka").options(**self.sink_options())
            .option("checkpointLocation", checkpoint)
        )

    def write_batch(self, records: DataFrame, name: str, batch_id: int) -> None:
        records.select("key", "value", "topic").write.format("kafka").options(**self.sink_options()).save()


@dataclass(frozen=True)
class FolderTopics:
    """Topics as Parquet files below a shared folder: ``<root>/<writer>/batch=<id>/topic=<topic>``.

    Each writing job has its own folder. A batch is committed there as a whole and once, so delivery is exactly once.
    ``read`` takes committed batches only. A stream takes files as they appear, so on a store where moving a folder is a
    copy it may see a file of a batch that is moved a second time after a crash. Readers take the folder of one writer, or
    any folder of ``key, value`` files.
    """

    root: str
    max_files_per_trigger: int | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read_stream(
        self, spark: SparkSession, topic: str, writer: str | None = None, group: GroupOffsets | None = None
    ) -> DataFrame:
        """All records of a topic; with a ``group`` those after the versions that it has worked through."""
        reader = spark.readStream.schema(_STORED_SCHEMA)
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        records = reader.parquet(self.path(writer or topic)).filter(F.col("topic") == topic)
        start = group.positions(spark).get(topic, {}).get(0) if group else None
        return records if start is None else records.filter(F.col("batch") >= start)  # whole folders

    def read(self, spark: SparkSession, topic: str, writer: str | None = None) -> DataFrame:
        records = read_committed(spark, self.path(writer or topic), _STORED_SCHEMA)
        return records.filter(F.col("topic") == topic)

    def write_stream(self, records: DataFrame, name: str, checkpoint: str):
        return (
            records.select("key", "value", "topic").writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, batch_id: self.write_batch(batch, name, batch_id))
        )

    def write_batch(self, records: DataFrame, name: str, batch_id: int) -> None:
        placed = records.select("key", "value", "topic", F.monotonically_increasing_id().alias("offset"))
        write_batch_once(placed, self.path(name), batch_id, ["topic"])


@dataclass(frozen=True)
class ConsoleTopics:
    """Shows records instead of storing them, for debugging."""

    prefix: str = ""
    rows: int = 20

    def write_stream(self, records: DataFrame, name: str, checkpoint: str):
        return (
            records.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, batch_id: self.write_batch(batch, name, batch_id))
        )

    def write_batch(self, records: DataFrame, name: str, batch_id: int) -> None:
        print(f"{self.prefix}{name} batch {batch_id}")
        records.show(self.rows, truncate=False)
