"""Row-count windows over a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators.windows import apply_windows, arrival_positions, full_and_rest
from ..session import scratch
from .log import CommitLog
from .once import committed_versions, job_id, read_committed, write_batch_once


@dataclass
class CountWindowStream:
    """Full windows of ``n`` rows in arrival order, over all micro-batches together; with ``fn`` what it makes of them.

    Each batch is ranked as a whole by the distributed two-pass rank, together with the rows the last batch left over.
    Fewer than ``n`` rows per key are carried on, as a small table per batch id. No operator state and no single task
    holds the stream, so this also works without a key.
    """

    spark: SparkSession
    root: str
    n: int
    order: Sequence[str]
    keys: Sequence[str] = ()
    fn: Callable | None = None  # takes and gives a pandas frame of whole windows, as in apply_windows
    schema: str | T.StructType | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        job = job_id(self.spark)
        rest_path, out_path = f"{self.root}/rest", f"{self.root}/windows"
        done = CommitLog(self.spark, rest_path).state()["jobs"].get(job)
        if done and done[0] >= batch_id:
            return
        rests = committed_versions(self.spark, rest_path)
        rows = read_committed(self.spark, rest_path, batch.schema).select(batch.columns).unionByName(batch)
        with scratch(self.spark):
            full, rest = full_and_rest(arrival_positions(rows, self.order, self.keys), self.n, rows.columns)
            if self.fn:
                full = apply_windows(full, self.fn, self.schema, self.keys)
            # The rest is written last, in place of the one before: until then a replay finds the same rows to start from.
            write_batch_once(full, out_path, batch_id, job=job)
            write_batch_once(rest, rest_path, batch_id, job=job, drops=rests)

    def windows(self) -> DataFrame:
        """Everything emitted so far; a window is told by ``batch`` and ``window_no`` (and the keys)."""
        return read_committed(self.spark, f"{self.root}/windows")
