import math
import random

from pyspark.sql import functions as F

from tempoflow.operators import lastn, ranking


def simulate(bits, n):
    """Step-by-step exponential buckets: estimate and live bucket sizes after every bit."""
    buckets, out = [], []
    for t, bit in enumerate(bits, start=1):
        if bit:
            buckets.insert(0, [t, 1])
            size = 1
            while sum(1 for b in buckets if b[1] == size) > 2:
                older = [i for i, b in enumerate(buckets) if b[1] == size][-2:]
                buckets[older[0]][1] *= 2
                del buckets[older[1]]
                size *= 2
        live = [b for b in buckets if b[0] > t - n]
        out.append((sum(b[1] for b in live) - (live[-1][1] / 2 if live else 0), len(live)))
    return out


def skewed(spark, rows=1500, seed=3):
    """A third of the rows under one key, the others spread."""
    rng = random.Random(seed)
    data = [(i, "hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}", int(rng.random() < 0.6)) for i in range(rows)]
    return data, spark.createDataFrame(data, "seq long, artist string, bit int")


def test_timeline_matches_simulation_with_small_blocks(spark):
    data, frame = skewed(spark)
    for n, block in ((7, 16), (50, 10)):
        got = {
            (r["artist"], r["arrival"]): (r["estimated_b"], r["actual_b"])
            for r in lastn.dgim_timeline(frame, n=n, bits={"b": F.col("bit")}, block_rows=block, partitions=5).collect()
        }
        assert len(got) == len(data)
        for key in {d[1] for d in data}:
            bits = [d[2] for d in data if d[1] == key]
            for t, (estimate, _) in enumerate(simulate(bits, n), start=1):
                exact = sum(bits[max(0, t - n) : t])
                assert got[key, t] == (estimate, exact)
                assert abs(estimate - exact) <= 0.5 * exact


def test_stats_at_the_end(spark):
    data, frame = skewed(spark)
    n = 60
    rows = {r["artist"]: r for r in lastn.dgim_stats(frame, n=n, bits={"b": F.col("bit")}).collect()}
    for key, row in rows.items():
        bits = [d[2] for d in data if d[1] == key]
        estimate, buckets = simulate(bits, n)[-1]
        assert (row["estimated_count"], row["bucket_count"]) == (estimate, buckets)
        assert (row["actual_count"], row["current_position"]) == (sum(bits[-n:]), len(bits))


def test_five_ones(spark):
    frame = spark.createDataFrame([(i, "a", 1) for i in range(5)], "seq long, artist string, bit int")
    buckets = lastn.dgim_buckets(frame, F.col("bit")).orderBy("newest_age").collect()
    assert [b["bucket_size"] for b in buckets] == [1, 2, 2]
    row = lastn.dgim_stats(frame, bits={"b": F.col("bit")}).first()
    assert (row["estimated_count"], row["actual_count"]) == (4.0, 5)


def test_no_ones_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a", 0)], "seq long, artist string, bit int")
    row = lastn.dgim_overall(frame, bits={"b": F.col("bit")}).first()
    assert (row["estimated_count"], row["actual_count"], row["bucket_count"]) == (0.0, 0, 0)
    assert lastn.dgim_overall(frame.limit(0), bits={"b": F.col("bit")}).count() == 0


def test_global_rank_with_ties_and_few_rows(spark):
    data = [(i, i % 3) for i in range(500)]
    frame = spark.createDataFrame(data, "seq long, v int")
    got = [(r["v"], r["seq"]) for r in ranking.global_rank(frame, ["v", "seq"], 7).orderBy("position").collect()]
    assert got == sorted((v, s) for s, v in data)
    positions = [r["position"] for r in ranking.global_rank(frame.limit(2), ["seq"], 7).collect()]
    assert sorted(positions) == [1, 2]
    assert ranking.global_rank(frame.limit(0), ["seq"], 3).count() == 0


def test_first_n_two_step_equals_one_step(spark):
    _, frame = skewed(spark)
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    one = ranking.last_n(frame, ["artist"], ["seq"], 40).collect()
    spark.conf.set(limit, "10")
    try:
        two = ranking.last_n(frame, ["artist"], ["seq"], 40).collect()
    finally:
        spark.conf.unset(limit)
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert math.isclose(len(one), len(two))
