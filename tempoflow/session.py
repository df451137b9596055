"""Session helpers: a local session for tests and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 8 * 1024 * 1024


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tempoflow") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller passes in its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``; local runs may fall back to a temporary one."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="tempoflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one staged table or stream checkpoint."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of the executors that computed them."""
    shared_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    for files in _scopes.get():
        written = stored._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if written.isDefined():
            files.append(written.get())
    return stored


@contextmanager
def freed_checkpoints(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`checkpointed` writes inside, at the end: for steps whose results are saved by then."""
    files: list[str] = []
    token = _scopes.set((*_scopes.get(), files))
    try:
        yield
    finally:
        _scopes.reset(token)
        for name in files:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash the rows over all shuffle partitions before costly per-row work; a given number is not coalesced again."""
    return df.repartition(shuffle_partitions(df.sparkSession), *keys)


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Redistribute the rows of a scan that has fewer splits than there are cores; a large scan passes unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def splittable(df: DataFrame, *keys: str) -> DataFrame:
    """Prepare the one-row-per-key side of a join whose other side may be dominated by one key.

    Adaptive execution splits a hot key only if both sides of the join are plain shuffles. A side that was just grouped
    by the join key would be used as it lies, so it is moved once by a hash of the key; the join then shuffles both.
    """
    return df.repartition(F.xxhash64(*keys))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only after measuring the table; beyond the bound the join is left to shuffle with AQE.

    The table is measured by running it, so pass a stored or checkpointed one.
    """
    width: Column = F.lit(0).cast("bigint")
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + F.lit(16)
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
