"""Writing a micro-batch exactly once.

A batch is a folder ``<path>/batch=<version>``, and counts once its entry stands in the table's commit log: the job and batch
id that wrote it, and the names and sizes of its files. Versions only count up; they are not the batch ids of a job, so a job
with a new checkpoint, or a second job, appends and is never taken for a replay. Files without an entry, as a crash or a copying
"rename" leaves them, are not read, and the replay of that batch replaces them. An entry whose files are gone is an error to
readers; only a replay of that very batch mends it, with a new version.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ..fs import SharedFiles
from .log import CommitLog, LostFiles


def job_id(spark: SparkSession) -> str:
    """What names a streaming query over all its restarts: the id that its checkpoint keeps. Empty outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/batch={version}"


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    return _versions(CommitLog(spark, path).state())


def _versions(state: dict) -> list[int]:
    return [v for first, last in state.get("ranges", []) for v in range(first, last + 1)]


def with_all_files(df: DataFrame, files: int, path: str) -> DataFrame:
    """``df`` itself, which reads plain files, if it found as many as were committed."""
    found = len(df._jdf.inputFiles())
    if found != files:
        raise LostFiles(f"{path} has {found} of {files} committed files")
    return df


def read_committed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All committed batches as one table with these columns (without a schema: those of the newest one with
    rows); empty before the first."""
    log = CommitLog(spark, path)
    state = log.state()
    versions = _versions(state)
    if schema is None:
        newest = next((v for v in reversed(versions) if log.entry(v)["files"]), None)
        if newest is None:
            raise ValueError(f"{path} has no rows yet; give its schema to read it as empty")
        schema = spark.read.parquet(folder(path, newest)).schema
    if not versions:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*[folder(path, v) for v in versions])
    return with_all_files(found, state["files"], path)


def data_files(files: SharedFiles, path: str) -> dict[str, int]:
    return {n: size for n, size in files.files(path).items() if not n.rpartition("/")[2].startswith((".", "_"))}


def write_batch_once(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), *, job: str | None = None,
    facts: Mapping[str, object] | None = None, drops: Iterable[int] = (),
) -> bool:
    """Append ``df`` as the next version; False, and nothing done, if this job wrote this batch already.

    ``job`` is the streaming query that is running unless given. ``facts`` are put into the entry, and ``drops`` are versions
    that no longer count once this one does. The files are written to a hidden folder and moved into place. Several writers
    may append at once: each has a version of its own.
    """
    spark = df.sparkSession
    files, root, log = SharedFiles(spark), path.rstrip("/"), CommitLog(spark, path)
    job, state, drops = job_id(spark) if job is None else job, log.state(), list(drops)
    done = state["jobs"].get(job)
    if done and done[0] >= batch_id:
        # Batches of a job come in order, so its newest one tells.
        there = data_files(files, folder(root, done[1]))
        if done[0] > batch_id or there == log.entry(done[1])["files"]:
            if job_id(spark):  # operators with state have to run, so that their state of this batch is committed
                df.write.format("noop").mode("overwrite").save()
            return False
        drops.append(done[1])
    version = log.claim(state, job, batch_id)
    staging, target = f"{root}/_staging/{version}", folder(root, version)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(staging)
    files.delete(target)  # what an attempt left that did not get as far as its entry
    files.rename(staging, target)
    gone = [[v, len(log.entry(v)["files"])] for v in drops]
    log.publish(version, {"job": job, "batch": batch_id, "files": data_files(files, target), "drops": gone, **(facts or {})})
    for dropped in drops:
        files.delete(folder(root, dropped))
    return True
