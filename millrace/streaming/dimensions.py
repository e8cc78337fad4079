"""Dimension tables, kept up to date by micro-batches and merged when they are read."""

from __future__ import annotations

import math
from collections.abc import Collection, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.cdc import latest_dim_columns
from ..operators.joins import BROADCAST_BYTES, fits_broadcast, measured_bytes
from ..session import scratch
from .once import job_id
from .parts import MEMBER, PartedTable, held_bytes

_MERGE = "_merge"  # the job that compacts

# Buckets made for less than this share a folder, and with it a file, with the buckets next to them.
_FOLDER_BYTES = 8 * 1024 * 1024


def bucket_of(hashed: Column, count: int) -> Column:
    """Linear hashing: with ``count`` buckets, those beyond the last power of two have split off from their lower twins."""
    half = 1 << (count.bit_length() - 1)
    wide = F.pmod(hashed, F.lit(2 * half))
    return F.when(wide < count, wide).otherwise(F.pmod(hashed, F.lit(half))).cast("int")


def _twin(bucket: int) -> int:
    """The bucket that this one splits off from."""
    return bucket - (1 << (bucket.bit_length() - 1))


@dataclass
class DimensionStore:
    """Dimension tables, all columns text, one row per key, in hash buckets of the key.

    An upsert reads nothing: it appends its rows as sorted delta files for the buckets that its keys are in. Readers merge a
    table's base files with the deltas since; the last arrival wins, column by column: a batch replaces what it gives, and
    keeps stored columns that its configuration does not name; among the changes of one batch the latest counts. A bucket
    whose deltas have grown beyond ``delta_share`` of its base and ``delta_bytes``, or are more than ``delta_files``, is
    merged into a new base. As the table grows, buckets split, so that one holds about ``bucket_bytes``; splitting a bucket
    rewrites that bucket alone. Buckets of less than 8 MB lie many to a file, so that a table has files by its bytes and not by
    its buckets; a reader of one of them passes over the others in its file. So what a batch writes follows from its own size, and over time each row is rewritten a number
    of times that does not depend on the number of batches.

    The commit log says which files count. A replayed batch of the same streaming query does nothing. Versions that nothing
    needs are deleted by the first batch that comes ``keep_seconds`` later, so that running readers can finish. One writer at a
    time per table: a second one fails, and so does one that was given up and still runs.
    """

    spark: SparkSession
    root: str
    keep_seconds: float = 3600.0
    bucket_bytes: int = 64 * 1024 * 1024
    delta_bytes: int = 8 * 1024 * 1024
    delta_share: float = 0.25
    delta_files: int = 24
    _small: dict[str, bool] = field(default_factory=dict, repr=False)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def parts(self, table: str) -> PartedTable:
        return PartedTable(self.spark, self.path(table), "bucket")

    def state(self, table: str) -> dict:
        """What the commit log says of the table."""
        return self.parts(table).state()

    def versions(self, table: str) -> list[int]:
        return self.parts(table).versions()

    def _stored(self, table: str, columns: list[str], parts: Iterable[tuple[str, list]]) -> DataFrame:
        """Stored rows as they are: the key, each other column as ``struct<value>``, null if it was not given."""
        value = T.StructType([T.StructField("value", T.StringType())])
        schema = T.StructType([
            T.StructField(columns[0], T.StringType()), *[T.StructField(c, value) for c in columns[1:]], T.StructField("bucket", T.IntegerType()),
        ])
        return self.parts(table).stored(schema, parts)

    def _merged(self, table: str, state: dict, buckets: Collection[str]) -> DataFrame:
        """One row per key of these buckets, each other column as ``struct<value>``."""
        columns = state["facts"]["columns"]
        pk, names = columns[0], columns[1:]
        base = self._stored(table, columns, ((b, state["base"][b]) for b in buckets if b in state["base"]))
        deltas = [(b, part) for b in buckets for part in state["deltas"].get(b, [])]
        base = base.select(columns)
        if not deltas:
            return base
        newest = [F.max(F.when(F.col(c).isNotNull(), F.struct("batch", F.col(c)["value"].alias("value")))).alias(f"_new_{c}") for c in names]
        rows = self._stored(table, columns, deltas)
        changed = rows.groupBy(pk).agg(*newest) if names else rows.select(pk).distinct()
        given = {c: F.when(F.col(f"_new_{c}").isNotNull(), F.struct(F.col(f"_new_{c}")["value"].alias("value"))) for c in names}
        last = [F.coalesce(given[c], F.col(c)).alias(c) for c in names]
        if not fits_broadcast(changed):
            return base.join(changed, pk, "full").select(pk, *last)
        # The base stays where it is: it meets the few changes, and then those of them that it does not have are added.
        met = base.join(F.broadcast(changed), pk, "left").select(pk, *last)
        known = base.select(pk).join(F.broadcast(changed.select(pk)), pk, "left_semi")
        added = changed.join(F.broadcast(known), pk, "left_anti").select(pk, *[given[c].alias(c) for c in names])
        return met.unionByName(added)

    def read(self, table: str, columns: list[str] | None = None) -> DataFrame:
        """The newest snapshot. Before the first one this is an empty table with ``columns``."""
        state = self.state(table)
        if "facts" not in state:
            if columns is None:
                raise ValueError(f"{table} has no snapshot yet; name its columns to read it as empty")
            return self.spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
        pk, *names = state["facts"]["columns"]
        return self._merged(table, state, self.parts(table).names(state)).select(pk, *[F.col(c)["value"].alias(c) for c in names])

    def is_small(self, table: str) -> bool:
        """Whether the newest snapshot fits a broadcast; measured once per version, and only if its files are small."""
        state = self.state(table)
        if "facts" not in state:
            return True
        if held_bytes(state) > BROADCAST_BYTES:
            return False
        name = f"{table}/{state['version']}"
        if name not in self._small:
            self._small[name] = fits_broadcast(self.read(table))
        return self._small[name]

    def upsert(
        self, changes: DataFrame, table: str, pk: str, cols: str | Collection[str], batch_id: int, *, job: str | None = None
    ) -> bool:
        """Merge the envelopes in ``changes`` that belong to ``table``; False if this job merged the batch before.

        ``cols`` may be several column lists; a record gives those that its own ``cols`` names.
        """
        with scratch(self.spark):
            fresh = latest_dim_columns(changes, table, pk, [cols] if isinstance(cols, str) else sorted(cols))
            return self._append(fresh, table, pk, batch_id, job_id(self.spark) if job is None else job)

    def put(self, rows: DataFrame, table: str, pk: str, batch_id: int = 0, *, job: str = "load") -> bool:
        """Merge whole rows with one key each, for a first load or a back-fill."""
        given = [F.struct(F.col(c).cast("string").alias("value")).alias(c) for c in rows.columns if c != pk]
        with scratch(self.spark):
            return self._append(rows.select(F.col(pk).cast("string").alias(pk), *given), table, pk, batch_id, job)

    def _append(self, fresh: DataFrame, table: str, pk: str, batch_id: int, job: str) -> bool:
        state = self.state(table)
        done, known = state["jobs"].get(job), state.get("facts")
        if done and done[0] >= batch_id:
            return False
        columns = list(dict.fromkeys([*(known["columns"] if known else [pk]), *fresh.columns]))
        # A first load may be large, so its buckets are made for its size.
        count = known["count"] if known else max(1, math.ceil(measured_bytes(fresh) / self.bucket_bytes))
        self._write(table, state, fresh, "delta" if known else "base", [], job, batch_id, columns, count)
        self.compact(table)
        return True

    def _write(
        self, table: str, state: dict, rows: DataFrame, kind: str, replaces: Iterable[str], job: str, batch: int, columns: list[str], count: int
    ) -> None:
        pk, together = columns[0], max(1, _FOLDER_BYTES // self.bucket_bytes)
        laid = rows.withColumn("bucket", bucket_of(F.xxhash64(pk), count))
        if together > 1:
            laid = laid.withColumn(MEMBER, F.col("bucket")).withColumn("bucket", F.col(MEMBER) - F.col(MEMBER) % together)
        order = [c for c in ("bucket", MEMBER, pk) if c in laid.columns]
        laid = laid.repartition("bucket").sortWithinPartitions(*order)
        self.parts(table).write(state, laid, kind, replaces, job, batch, self.keep_seconds, columns=columns, count=count)

    def compact(self, table: str) -> list[str]:
        """Merge the buckets that have too many deltas, and split those that the table has outgrown; gives their names."""
        parts = self.parts(table)
        state = parts.state()
        columns, count = state["facts"]["columns"], state["facts"]["count"]
        wanted = max(count, math.ceil(held_bytes(state) / self.bucket_bytes))
        due = parts.grown(state, self.delta_files, self.delta_bytes, self.delta_share)
        for new in range(count, wanted):
            source = _twin(new)
            while source >= count:
                source = _twin(source)
            due.add(str(source))
        due &= parts.names(state)
        if not due and wanted == count:
            return []
        number = state["jobs"].get(_MERGE, [-1])[0] + 1
        self._write(table, state, self._merged(table, state, due), "base", due, _MERGE, number, columns, wanted)
        return sorted(due)
