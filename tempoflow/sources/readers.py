"""Batch and stream readers and writers; connection details always come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tempoflow.sources import tables


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest", max_offsets: int | None = None) -> dict:
    """Options of a topic scan. ``max_offsets`` bounds one micro-batch: the counterpart of a count trigger."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_stream(
    spark: SparkSession, fmt: str, options: dict | None = None, schema: StructType | None = None, path: str | None = None
) -> DataFrame:
    """Streaming frame from Kafka or from a folder of files."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def stream_table(spark: SparkSession, sf_dir: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """One parquet table of a data folder as a stream: a folder of part files, or a single file beside others."""
    schema = tables.table(spark, sf_dir, table).schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    options = {}
    if files_per_trigger is not None:
        options["maxFilesPerTrigger"] = str(files_per_trigger)
    # a table that is not there is an error here, not a stream without files
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return read_stream(spark, "parquet", options, schema, f"{sf_dir}/{table}.parquet")
    return read_stream(spark, "parquet", {**options, "pathGlobFilter": f"{table}.parquet"}, schema, sf_dir)


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch write of encoded messages to a topic."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def start_topic_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    """Streaming write of encoded messages to a topic."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
