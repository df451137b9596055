import statistics

from pyspark.sql import functions as F

from tempoflow.functions import hashing as H
from tempoflow.operators import distinct, membership, sampling


def names(spark, n, prefix="n"):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("name"))


def test_trailing_zeros(spark):
    frame = spark.createDataFrame([(v,) for v in (1, 2, 12, 0, 1 << 31)], "w long")
    assert [r[0] for r in frame.select(H.trailing_zeros(F.col("w"))).collect()] == [0, 1, 2, 32, 31]


def test_words_agree_between_forms(spark):
    for mode in (H.PORTABLE, H.FAST):
        frame = names(spark, 50).withColumn("b", H.base(F.col("name"), mode)).select(
            H.word_array(F.col("name"), 5, mode).alias("all"),
            F.array(*[H.word(F.col("b"), i, mode) for i in range(5)]).alias("single"),
            F.array(*[F.expr(H.word_sql("b", i, mode)) for i in range(5)]).alias("text"),
        )
        assert frame.where((F.col("all") != F.col("single")) | (F.col("all") != F.col("text"))).count() == 0


def test_null_items_are_not_counted(spark):
    frame = spark.createDataFrame([(None,)], "name string")
    for mode in (H.PORTABLE, H.FAST):
        assert distinct.estimate(distinct.registers(frame, mode=mode)).first()["estimate"] is None
    assert membership.build(frame).count() == 0


def test_fm_of_nothing_and_of_one(spark):
    assert distinct.estimate(distinct.registers(names(spark, 0))).first()["estimate"] is None
    one = distinct.long_registers(distinct.registers(names(spark, 1))).agg(F.count("*"), F.min("max_zeros")).first()
    assert one[0] == 32 and one[1] >= 0


def test_fm_ignores_copies_and_merges(spark):
    left, right = names(spark, 400), names(spark, 300, "m")
    copies = left.unionByName(left)
    assert distinct.registers(copies).collect() == distinct.registers(left).collect()
    merged = distinct.merge([distinct.registers(left), distinct.registers(right)])
    assert merged.collect() == distinct.registers(left.unionByName(right)).collect()


def test_fm_error_is_bounded_over_seeds(spark):
    for mode in (H.PORTABLE, H.FAST):
        wide = names(spark, 2000).withColumn("seed", F.explode(F.sequence(F.lit(1), F.lit(12))))
        seeded = wide.select("seed", F.concat_ws("/", "seed", "name").alias("name"))
        rows = distinct.estimate(distinct.registers(seeded, group=("seed",), mode=mode), ("seed",), corrected=True).collect()
        mean = statistics.mean(r["estimate"] for r in rows)
        assert 0.8 * 2000 < mean < 1.25 * 2000


def test_bloom_has_no_false_negatives_in_either_path(spark):
    members, strangers = names(spark, 300), names(spark, 2000, "s")
    everyone = members.unionByName(strangers)
    for mode in (H.PORTABLE, H.FAST):
        words = membership.build(members, bits=4000, hashes=3, mode=mode)
        inline = {r["name"] for r in membership.probe(everyone, words, bits=4000, mode=mode).collect()}
        joined = {r["name"] for r in membership.probe(everyone, words, bits=4000, mode=mode, inline_bits=0).collect()}
        assert inline == joined
        assert {r["name"] for r in members.collect()} <= inline
        assert len(inline) < 300 + 200


def test_bloom_merge_and_positions(spark):
    left, right = names(spark, 20), names(spark, 20, "r")
    merged = membership.merge(membership.build(left), membership.build(right))
    whole = membership.build(left.unionByName(right))
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in whole.collect()}
    assert membership.set_positions(whole).count() == membership.fill(whole).first()["bits_set"]


def test_reservoir_sizes_and_merge(spark):
    for n, k in ((3, 10), (10, 10), (200, 10)):
        frame = names(spark, n)
        assert sampling.reservoir_sample(frame, k).count() == min(n, k)
    key = sampling.hashed_key("name", 5)
    left, right = names(spark, 100), names(spark, 100, "r")
    parts = [sampling.bottom_k(sampling.keyed(p, key), 10) for p in (left, right)]
    merged = sampling.merge(*parts, k=10).drop(sampling.KEY)
    assert merged.collect() == sampling.reservoir_sample(left.unionByName(right), 10, key).collect()


def test_reservoir_is_uniform_over_seeds(spark):
    counts = {}
    for seed in range(30):
        for row in sampling.reservoir_sample(names(spark, 20), 5, sampling.hashed_key("name", seed)).collect():
            counts[row["name"]] = counts.get(row["name"], 0) + 1
    assert len(counts) == 20 and max(counts.values()) < 20
