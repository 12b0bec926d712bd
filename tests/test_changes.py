"""Versions, intervals, selections and segments in stretches of time against a walk in order, and with one hot key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes

T0 = datetime(2024, 1, 1)


def walk(rows):
    """(versions, intervals' ends, selections, segments) of rows (i, key, time, value, swap), told one by one."""
    first = (lambda x: (x is not None, x if x is not None else T0))
    ordered = sorted(rows, key=lambda r: (str(r[1]), first(r[2]), r[0]))
    version, ends, selected, segment = {}, {}, {}, {}
    for k in {r[1] for r in rows}:
        own = [r for r in ordered if r[1] == k]
        last, kept, n = None, [], 0
        for i, _, t, v, _ in own:
            if last is None or last[0] != v:
                n += 1
                version[i] = n
                kept.append((i, t))
            last = (v,)
        for (i, _), after in zip(kept, [*kept[1:], (None, None)], strict=True):
            ends[i] = after[1]
        before, n = None, 0
        for i, _, _, v, swap in own:
            if v:
                if before is None or swap or before != v:
                    n += 1
                    selected[i] = (n, "initial" if before is None else "explicit_swap" if swap else "observed_change")
                before = v
        before, n = None, 1
        for i, _, _, v, _ in own:
            if v:
                n += before is not None and before != v
                before = v
            segment[i] = n
    return version, ends, selected, segment


@pytest.mark.parametrize("stretch", [60, 3_600, 10**7])
def test_against_a_walk(spark, stretch):
    """Stretches of a minute, an hour, and one that holds all: the same rows, with blanks, nulls, equal times, null keys and null times."""
    r = random.Random(stretch)
    at = lambda: None if r.random() < 0.03 else T0 + timedelta(minutes=r.randint(0, 3_000), seconds=r.choice([0, 30]))
    rows = [(i, r.choice(["a", "b", None]), at(), r.choice(["x", "x", "x", "y", "", None]), r.choice([None, False, False, False, True])) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, k string, t timestamp, v string, s boolean").withColumn("_extra", F.lit(1))
    version, ends, selected, segment = walk(rows)
    order = ["t", "i"]
    assert {x.i: x.version for x in changes.versions(df, ["k"], order, "v", stretch_s=stretch).collect()} == version
    got = changes.intervals(df, ["k"], "t", order, "v", stretch_s=stretch)
    assert got.columns == [*df.columns, "version", "valid_from", "valid_to"]
    assert {x.i: (x.version, x.valid_from, x.valid_to) for x in got.collect()} == {i: (n, rows[i][2], ends[i]) for i, n in version.items()}
    assert {x.i: (x.seq, x.trigger) for x in changes.selections(df, ["k"], order, "v", F.col("s"), stretch_s=stretch).collect()} == selected
    assert {x.i: x.segment for x in changes.segments(df, ["k"], order, "v", stretch_s=stretch).collect()} == segment
    for f in (changes.versions, changes.segments, changes.selections):
        assert f(df.limit(0), ["k"], order, "v").count() == 0


def test_hot_key(spark):
    """A million rows of one key over thirty days: no task of the numbered rows holds over 5 % of them, and numbers run through."""
    n, seconds = 1_000_000, 30 * 86_400
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        at = (F.lit(1_700_000_000) + F.col("id") * seconds / n).cast("timestamp")
        df = spark.range(n).select(F.lit("hot").alias("k"), "id", at.alias("t"), F.floor(F.col("id") / 10).cast("string").alias("v"))
        out = changes.segments(df, ["k"], ["t", "id"], "v").withColumn("p", F.spark_partition_id())
        per = out.groupBy("p").agg(F.count("*").alias("n"), F.count(F.when(F.col("segment") == F.floor(F.col("id") / 10) + 1, 1)).alias("right")).collect()
        assert sum(r.n for r in per) == sum(r.right for r in per) == n and max(r.n for r in per) <= 0.05 * n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
