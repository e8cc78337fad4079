"""Summed marts, kept up to date by micro-batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.marts import rollup_sum
from .once import job_id
from .parts import PartedTable

_MERGE = "_merge"  # the job that compacts


@dataclass
class SummedMart:
    """Measures summed by keys within a date, as a table that sums its rows by itself would hold them.

    A batch is summed before the shuffle and appended as partial sums, in the partitions of the dates it met; nothing else is
    touched. Readers add up what a date has. A date with more than ``delta_files`` partial sums, or with more in them than
    ``delta_share`` of its base and ``delta_bytes``, is summed up into a new base. A replayed batch of the same streaming query
    does nothing. Versions that nothing needs are deleted by the first batch that comes ``keep_seconds`` later. One writer at a
    time.

    A measure has the type of the first batch. Rows with a null date make a partition of their own; null measures count as
    nothing.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    measures: Sequence[str]
    date: str = "data_dt"
    keep_seconds: float = 3600.0
    delta_files: int = 24
    delta_bytes: int = 8 * 1024 * 1024
    delta_share: float = 0.25

    @property
    def parts(self) -> PartedTable:
        return PartedTable(self.spark, self.path.rstrip("/"), self.date)

    def _sums(self, rows: DataFrame) -> DataFrame:
        return rollup_sum(rows, [self.date, *self.keys], self.measures)

    def _laid(self, rows: DataFrame) -> DataFrame:
        """The rows of a date together and in order; a date with most of the rows is dealt to several tasks."""
        return rows.hint("rebalance", self.date).sortWithinPartitions(self.date, *self.keys)

    def write_batch(self, rows: DataFrame, batch_id: int, *, job: str | None = None) -> bool:
        """Add rows with the keys, the measures and the date; False, and nothing done, if this job added this batch before."""
        job, state = job_id(self.spark) if job is None else job, self.parts.state()
        done = state["jobs"].get(job)
        if done and done[0] >= batch_id:
            if job_id(self.spark):  # operators with state have to run, so that their state of this batch is committed
                rows.write.format("noop").mode("overwrite").save()
            return False
        rows = rows.withColumn(self.date, F.col(self.date).cast("string"))
        if "facts" in state:
            schema = T.StructType.fromJson(state["facts"]["schema"])
            rows = rows.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
        sums = self._sums(rows)
        self.parts.write(state, self._laid(sums), "delta", [], job, batch_id, self.keep_seconds, schema=sums.schema.jsonValue())
        self.compact()
        return True

    def _read(self, state: dict, names: set[str]) -> DataFrame:
        held = [(n, state["base"][n]) for n in names if n in state["base"]] + [(n, p) for n in names for p in state["deltas"].get(n, [])]
        return self._sums(self.parts.stored(T.StructType.fromJson(state["facts"]["schema"]), held))

    def read(self) -> DataFrame:
        """One row per date and keys."""
        state = self.parts.state()
        if "facts" not in state:
            raise ValueError(f"{self.path} has no batch yet")
        return self._read(state, self.parts.names(state))

    def compact(self) -> list[str]:
        """Sum up the dates that have too many deltas; gives them as their folders are named."""
        state = self.parts.state()
        due = self.parts.grown(state, self.delta_files, self.delta_bytes, self.delta_share)
        if due:
            number = state["jobs"].get(_MERGE, [-1])[0] + 1
            self.parts.write(state, self._laid(self._read(state, due)), "base", due, _MERGE, number, self.keep_seconds, **state["facts"])
        return sorted(due)
