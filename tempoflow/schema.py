"""The track emission record and the defaults shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The record layout on the wire.
METRICS = ("popularity", "danceability", "energy")
FEATURES = ("danceability", "energy", "tempo")
MASKABLE = ("popularity", "danceability", "energy", "tempo")

# Defaults of the analyses.
POPULAR_ABOVE = 80
VERY_POPULAR_ABOVE = 90
POPULAR_FROM = 80
ENERGY_FROM = 0.8
DANCE_FROM = 0.8
WINDOW_ARRIVALS = 100
BLOOM_BITS = 1000
BLOOM_HASHES = 3
RESERVOIR_SIZE = 10
FM_ESTIMATORS = 32
MINHASH_PERMUTATIONS = 128
EPSILON = 0.5
K_ANONYMITY = 2
CLUSTERS = 3
TEMPO_SCALE = 200.0
TRIGGER_SECONDS = 10


def track_schema(popularity: str = "int", timestamp: str = "timestamp") -> T.StructType:
    """Schema of one JSON record; both declared variants of the two loose fields are accepted."""
    number = {"int": T.IntegerType(), "double": T.DoubleType()}[popularity]
    moment = {"string": T.StringType(), "timestamp": T.TimestampType()}[timestamp]
    return T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("artist", T.StringType()),
            T.StructField("popularity", number),
            T.StructField("danceability", T.DoubleType()),
            T.StructField("energy", T.DoubleType()),
            T.StructField("tempo", T.DoubleType()),
            T.StructField("timestamp", moment),
        ]
    )


TRACK_ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("popularity", T.IntegerType()),
        T.StructField("artists", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    ]
)

PLAYLIST_SCHEMA = T.StructType(
    [T.StructField("items", T.ArrayType(T.StructType([T.StructField("track", TRACK_ITEM)])))]
)

FORGET_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType(), False),
        T.StructField("item", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("reason", T.StringType()),
    ]
)
