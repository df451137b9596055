import datetime as dt

from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions import scalars
from tempoflow.sources import codec, readers


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_malformed_messages_become_nulls(spark):
    rows = codec.decode(messages(spark, "not json", '{"popularity":81.5}', '{"popularity":"x","name":"b"}')).collect()
    assert all(v is None for v in rows[0])
    assert rows[1]["popularity"] is None
    assert (rows[2]["popularity"], rows[2]["name"]) == (None, "b")


def test_rejects_keep_the_raw_text(spark):
    good, bad = codec.decode_with_rejects(messages(spark, "not json", '{"name":"a","popularity":7}'))
    assert [r["name"] for r in good.collect()] == ["a"]
    assert [r["value"] for r in bad.collect()] == ["not json"]


def test_both_schema_variants(spark):
    text = '{"name":"a","popularity":7,"timestamp":"2024-05-06 07:08:09"}'
    loose = codec.decode(messages(spark, text), S.track_schema("double", "string")).first()
    strict = codec.decode(messages(spark, text)).first()
    assert (loose["popularity"], loose["timestamp"]) == (7.0, "2024-05-06 07:08:09")
    assert (strict["popularity"], strict["timestamp"]) == (7, dt.datetime(2024, 5, 6, 7, 8, 9))


def test_encode_decode_round_trip(spark, make_tracks):
    tracks = make_tracks([{"name": 'q"uote', "artist": "b", "popularity": None, "tempo": 1.5, "timestamp": dt.datetime(2024, 1, 1)}])
    assert codec.decode(codec.encode(tracks)).collect() == tracks.drop("seq").collect()


def test_flatten_takes_first_artist_and_skips_empty_items(spark):
    text = (
        '{"items":[{"track":{"id":"1","name":"a","popularity":5,"artists":[{"name":"x"},{"name":"y"}]}},{"track":null},'
        '{"track":{"id":"2","name":"b","popularity":6,"artists":[]}}]}'
    )
    flat = codec.flatten_items(codec.decode(messages(spark, text, '{"items":null}'), S.PLAYLIST_SCHEMA))
    assert [(r["track_id"], r["artist"]) for r in flat.orderBy("track_id").collect()] == [("1", "x"), ("2", None)]
    features = spark.createDataFrame([("1", 0.1, 0.2, 90.0)], "id string, danceability double, energy double, tempo double")
    assert [r["name"] for r in codec.with_audio_features(flat, features).collect()] == ["a"]


def test_thresholds(make_tracks):
    tracks = make_tracks([{"popularity": p} for p in (80, 81, 90, 91, 0, None)])
    assert tracks.where(scalars.above("popularity", 80)).count() == 3
    assert tracks.where(scalars.above("popularity", 90)).count() == 1
    assert tracks.agg(F.sum(scalars.threshold_bit("popularity", 80))).first()[0] == 4


def test_discretise_rounds_half_to_even(spark):
    values = [0.005, 0.015, 0.025, 0.5, 0.123]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in frame.select(scalars.discretise(F.col("v"))).collect()] == [round(v * 100) for v in values]


def test_kafka_options():
    options = readers.kafka_options("host:9092", "topic", max_offsets=5)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "5"
