"""Running a stream and keeping its results or its state as one folder per epoch.

A replayed epoch overwrites its own folder and reads the state of the epoch before it, so each step is exactly-once
whatever executor or driver is lost in between. Nothing lives in driver memory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tempoflow import schema as S

AVAILABLE_NOW = {"availableNow": True}
EVERY_TEN_SECONDS = {"processingTime": f"{S.TRIGGER_SECONDS} seconds"}

Handler = Callable[[DataFrame, int], None]


class EpochTable:
    """What a stream leaves after each epoch.

    A history keeps one folder per epoch. State and snapshots need only the last epochs: with ``slots`` the folders are
    reused in turn, so storage stays bounded; two slots suffice, since epoch n reads n-1 and overwrites n-2.
    """

    def __init__(self, path: str, schema: StructType, slots: int | None = None):
        self.path = path
        self.schema = schema
        self.slots = slots

    def _folder(self, epoch: int) -> str:
        return f"{self.path}/epoch={epoch}" if self.slots is None else f"{self.path}/slot={epoch % self.slots}"

    def _stored(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(StructType([*self.schema.fields, StructField("epoch", LongType())])).parquet(path)

    def write(self, df: DataFrame, epoch: int) -> None:
        rows = df.select(*self.schema.fieldNames())
        if self.slots is not None:
            rows = rows.withColumn("epoch", F.lit(epoch).cast("bigint"))
        rows.write.mode("overwrite").parquet(self._folder(epoch))

    def before(self, spark: SparkSession, epoch: int) -> DataFrame:
        """State left by the previous epoch; nothing before the first one."""
        if epoch == 0:
            return spark.createDataFrame([], self.schema)
        if self.slots is None:
            return spark.read.schema(self.schema).parquet(self._folder(epoch - 1))
        return self._stored(spark, self._folder(epoch - 1)).where(F.col("epoch") == epoch - 1).drop("epoch")

    def all(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark, self.path)

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest epoch with rows."""
        rows = self.all(spark)
        return rows.where(F.col("epoch") == rows.agg(F.max("epoch")).scalar()).drop("epoch", "slot")


def start(
    stream: DataFrame, handler: Handler, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Start a checkpointed query that hands each micro-batch to ``handler``. Errors stop the query and are retried."""
    return (
        stream.writeStream.foreachBatch(handler)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def start_snapshots(
    aggregate: DataFrame, table: EpochTable, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the full result of a streaming aggregate after every epoch."""
    return start(aggregate, table.write, checkpoint, "complete", trigger)


def start_append(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append final rows to a parquet folder."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def start_console(aggregate: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Print the full result after every epoch."""
    return (
        aggregate.writeStream.format("console")
        .outputMode("complete")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait for a query that processes what is available; its failure is raised here."""
    query.awaitTermination()
