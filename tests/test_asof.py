"""As-of matches in stretches of time against brute force, and with one identity that holds nearly all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof

T0 = datetime(2024, 1, 1)


def rows(r, n, hours, keys):
    return [(i, r.choice(keys), T0 + timedelta(minutes=r.randint(0, hours * 60), seconds=r.choice([0, 0, 30]))) for i in range(n)]


@pytest.mark.parametrize("stretch", [60, 3_600, 10**7])
def test_neighbours_and_latest(spark, stretch):
    """Stretches of a minute, an hour, and one that holds all: the same matches, with ties, null keys and null times."""
    r = random.Random(stretch)
    left = [*rows(r, 150, 60, ["a", "b", "c"]), (900, None, T0), (901, "a", None), (902, "none", T0), (903, "a", T0 - timedelta(days=9)), (904, "a", T0 + timedelta(days=9))]
    right = [*rows(r, 80, 50, ["a", "b"]), (800, None, T0), (801, "a", T0 + timedelta(hours=5)), (802, "a", T0 + timedelta(hours=5))]
    a = spark.createDataFrame(left, "i int, k string, t timestamp").withColumn("_x", F.lit(1))
    b = spark.createDataFrame(right, "v int, k string, at timestamp")
    got = {x.i: (x.prev_ts, x.same_ts, x.next_ts) for x in asof.neighbours(a, b, ["k"], "t", "at", stretch_s=stretch).collect()}
    last = {x.i: x.asof_v for x in asof.latest_before(a, b, ["k"], "t", "at", "v", stretch_s=stretch).collect()}
    assert len(got) == len(last) == len(left)
    for i, k, t in left:
        own = [(at, v) for v, q, at in right if q == k and k is not None and t is not None]
        before, after = [x for x, _ in own if x < t], [x for x, _ in own if x > t]
        same = next((x for x, _ in own if x == t), None)
        assert got[i] == (max(before, default=None), same, min(after, default=None))
        assert last[i] == max((x for x in own if x[0] <= t), default=(None, None))[1]
    assert asof.neighbours(a.limit(0), b, ["k"], "t", "at").count() == 0
    assert {x.prev_ts for x in asof.neighbours(a, b.limit(0), ["k"], "t", "at").collect()} == {None}


def test_hot_identity(spark):
    """Two million rows of one identity over thirty days: no task of the match holds over 5 % of them."""
    n, seconds = 2_000_000, 30 * 86_400
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        at = lambda c: (F.lit(1_700_000_000) + c * seconds / n).cast("timestamp")
        left = spark.range(n).select(F.lit("hot").alias("k"), F.col("id"), at(F.col("id")).alias("t"))
        right = spark.range(0, n, 500).select(F.lit("hot").alias("k"), at(F.col("id") + 250.5).alias("at"))
        out = asof.neighbours(left, right, ["k"], "t", "at").withColumn("p", F.spark_partition_id())
        per = out.groupBy("p").agg(F.count("*").alias("n"), F.count("prev_ts").alias("with_prev"), F.count("next_ts").alias("with_next")).collect()
        assert sum(r.n for r in per) == n and max(r.n for r in per) <= 0.05 * n
        assert sum(r.with_prev for r in per) == n - 251 and sum(r.with_next for r in per) == n - 249
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
