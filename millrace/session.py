"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .fs import SharedFiles

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings a job can switch on inside a running session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    STATE_STORE: ROCKSDB,
}


def tune(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution, skew handling and disk-backed stream state."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state in RocksDB, whatever the session is set to.

    A query takes the settings that it is started with, so the session has its own again afterwards.
    """
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def local_session(cores: str | int = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A small local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, and so share their folders."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session without the setting gets a
    temporary folder of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/millrace-{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application left in the shared folder. Nothing read from there may be in use any more."""
    SharedFiles(spark).delete(scratch_root(spark))


_scope = threading.local()  # streaming queries run their batches in threads of their own


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are deleted at the end; nothing that reads them may be used after that."""
    outer, mine = getattr(_scope, "paths", None), []
    _scope.paths = mine
    try:
        yield
    finally:
        _scope.paths = outer
        files = SharedFiles(spark)
        for path in mine:
            files.delete(path)


def materialize(df: DataFrame, label: str = "table", *, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    This cuts the lineage for good: a lost executor cannot bring a different row order or different range borders.
    Unlike a checkpoint, the table is columnar, so later passes read only the columns they need. Inside of
    :func:`scratch` it lasts as long as that. Columns to partition by must be the last ones.
    """
    path = path or scratch_path(df.sparkSession, label)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
