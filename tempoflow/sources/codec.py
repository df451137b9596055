"""JSON messages to records and back; flattening of nested playlist documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tempoflow import schema as S
from tempoflow.functions.scalars import TIME_FORMAT

_CORRUPT = "_corrupt_record"
_JSON_OPTIONS = {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}


def decode(messages: DataFrame, schema: StructType | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records from a ``value`` column; a malformed message gives a row of nulls, a bad field a null."""
    parsed = F.from_json(F.col("value").cast("string"), schema or S.track_schema(), _JSON_OPTIONS)
    return messages.select(*keep, parsed.alias("data")).select(*keep, "data.*")


def decode_with_rejects(messages: DataFrame, schema: StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Good records, and the raw text of the messages that did not parse."""
    schema = schema or S.track_schema()
    watched = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    options = {**_JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = messages.select(F.from_json(F.col("value").cast("string"), watched, options).alias("data")).select("data.*")
    good = parsed.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    rejects = parsed.where(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("value"))
    return good, rejects


def judged(messages: DataFrame, schema: StructType | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, the message as ``value``, its record as ``data``, and as ``reason`` why it is none, null for good ones.

    Reasons: missing (null), empty, malformed (no JSON), wrong type (JSON whose fields do not fit the schema).
    """
    schema = schema or S.track_schema()
    watched = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    options = {**_JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = F.col("value").cast("string")
    parsed = messages.select(*keep, text.alias("value"), F.from_json(text, watched, options).alias("data"))
    reason = (
        F.when(F.col("value").isNull(), "missing")
        .when(F.trim("value") == "", "empty")
        .when(F.get_json_object("value", "$").isNull(), "malformed")
        .when(F.col("data").isNull() | F.col(f"data.{_CORRUPT}").isNotNull(), "wrong type")
    )
    return parsed.withColumn("reason", reason).withColumn("data", F.col("data").dropFields(_CORRUPT))


def encode(records: DataFrame, columns: tuple[str, ...] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON message per record, ready for a topic or a text sink."""
    columns = columns or tuple(S.track_schema().fieldNames())
    return records.select(*keep, F.to_json(F.struct(*columns), _JSON_OPTIONS).alias("value"))


def flatten_items(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per playlist item that has a track; only the first artist counts."""
    track = F.col("item.track")
    return (
        documents.select(*keep, F.explode_outer("items").alias("item"))
        .where(track.isNotNull())
        .select(
            *keep,
            track["id"].alias("track_id"),
            track["name"].alias("name"),
            F.try_element_at(track["artists"], F.lit(1))["name"].alias("artist"),
            track["popularity"].alias("popularity"),
        )
    )


def with_audio_features(tracks: DataFrame, features: DataFrame) -> DataFrame:
    """Add the audio features by track id.

    Both sides may be large and one track may be very hot: no hint is given, so the shuffle join can be split by
    adaptive skew handling, or turned into a broadcast once the measured feature side is small enough.
    """
    return tracks.join(features.withColumnRenamed("id", "track_id"), "track_id").drop("track_id")
