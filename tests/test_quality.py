"""Exact percentiles in narrowing brackets against sorted values, with ties, nulls and no rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import distincts, filters, pages, quality


@pytest.mark.parametrize("most", [5, 200, 10**6])
def test_exact_percentiles(spark, most):
    rng = np.random.default_rng(1)
    values = [*map(float, rng.normal(size=3000)), *[0.25] * 400, None, None]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    shares = [0.0, 0.1, 0.5, 0.55, 0.999, 1.0]
    want = np.quantile([x for x in values if x is not None], shares)
    assert quality.exact_percentiles(df, "x", shares, most) == pytest.approx(list(want), abs=1e-12)
    assert quality.exact_percentiles(df.limit(0), "x", [0.5]) == [None]


def test_filters_that_are_not_set_keep_all(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, " ")], "i int, org string, t string")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(filters.org_filter(df)) == ids(filters.equal_to(df, org=None, t="")) == ids(filters.one_of(df, "org", "")) == ids(filters.half_open(df, "i")) == [1, 2, 3]
    assert ids(filters.org_filter(df, "a")) == [1] and ids(filters.org_filter(df, None, ("b",))) == [1]
    assert ids(filters.nonblank(df, "t")) == [2] and ids(filters.half_open(df, "i", F.lit(2), F.lit(3))) == [2]
    assert ids(df.where(filters.like_any("t", ["X%"]))) == [2] and ids(df.where(filters.like_any("t", []))) == []


def test_pages_meet_without_gap(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "i int, g int")
    order, seen, last = [("g", True), ("i", False)], [], None
    while rows := pages.page_after(df, order, last, 4).collect():
        seen += [(r.g, r.i) for r in rows]
        last = [F.lit(rows[-1].g), F.lit(rows[-1].i)]
    assert seen == sorted(seen, key=lambda x: (-x[0], x[1])) and len(seen) == 10


@pytest.mark.parametrize("most", [10, 700, 10**6])
def test_grouped_percentiles(spark, most):
    """Groups of one value, of ties, of two and of many values, null keys and null values; buffers, ranges, and both."""
    rng = np.random.default_rng(2)
    rows = [("a", float(x)) for x in rng.normal(size=3_000)] + [("b", float(x)) for x in rng.integers(0, 900, 2_000)] + [("c", 1.5)] + [("d", 2.0), ("d", 4.0), ("d", None)] + [(None, float(x)) for x in range(500)] + [("e", 7.0)] * 300 + [("f", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(4)
    shares = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {r.k: r for r in quality.grouped_percentiles(df, ["k"], "x", shares, most).collect()}
    assert set(got) == {"a", "b", "c", "d", "e", None}
    for k, r in got.items():
        own = [x for q, x in rows if q == k and x is not None]
        assert r.n == len(own) and list(r.percentiles) == pytest.approx(list(np.quantile(own, shares)), abs=1e-12)
    assert quality.grouped_percentiles(df.limit(0), ["k"], "x", shares, most).count() == 0


def test_a_large_group_is_spread(spark):
    """Ten million rows of three million values in one group, beyond the buffer: exact ranks, picked from ranges."""
    n, kinds = 10_000_000, 3_000_000
    df = spark.range(n).select(F.lit("hot").alias("k"), ((F.col("id") * 7919) % kinds).cast("double").alias("x"))
    r = quality.grouped_percentiles(df, ["k"], "x", [0.5, 0.99]).first()
    ordered = np.sort((np.arange(n, dtype=np.int64) * 7919) % kinds)
    assert r.n == n and list(r.percentiles) == pytest.approx(list(np.quantile(ordered, [0.5, 0.99])), abs=1e-6)


def walked(value, path, out, depth):
    """Fields and kinds of a parsed text, told recursively."""
    name = {bool: "bool", int: "int", float: "float", str: "str", type(None): "null", dict: "object", list: "array"}
    if depth and isinstance(value, dict):
        for k, v in value.items():
            out.append((f"{path}.{k}"[1:] if not path else f"{path[1:]}.{k}", name[type(v)]))
            walked(v, f"{path}.{k}", out, depth - 1)
    elif depth and isinstance(value, list) and value:
        walked(value[0], f"{path}[]", out, depth - 1)


def test_field_inventory(spark):
    texts = [
        {"a": 1, "b": {"c": [{"d": None, "e": 1.5}, {"x": 1}], "f": []}, "g": "s"}, {"a": "text", "b": None, "g": True, "h": [[{"i": 1}]]}, {"a": {"b": {"c": {"d": {"e": {"f": {"g": 1}}}}}}}, [{"q": 1, "r": {"s": 2.5}}], "scalar", {},
    ]
    want = {}
    for t in texts:
        out = []
        walked(t, "", out, 6)
        for x in out:
            want[x] = want.get(x, 0) + 1
    df = spark.createDataFrame([("k", json.dumps(t)) for t in texts] + [("k", "{broken"), ("k", None)], "k string, data string")
    assert {(r.path, r.kind): r.n for r in quality.field_inventory(df, ["k"], "data").collect()} == want


def test_distincts_merge(spark):
    """Daily distincts from hourly bitmaps and sketches equal those of rows, over a dictionary that grows."""
    rows = [(i % 30, f"v{(i * i) % 4001}") for i in range(20_000)] + [(3, None)]
    df = spark.createDataFrame(rows, "h int, v string")
    first = distincts.dictionary(df.where("h < 10"), "v").persist()
    second = distincts.dictionary(df, "v", first).persist()
    assert first.join(second, ["value", "id"]).count() == first.count() and second.select("id").distinct().count() == second.count() == len({v for _, v in rows if v})
    hourly = distincts.bitmaps(df.join(second, F.col("v") == F.col("value"), "left"), ["h"], "id")
    day = (F.col("h") / 7).cast("int").alias("d")
    got = {r.d: r.n_distinct for r in distincts.counted(hourly.select(day, "bucket", "bitmap"), ["d"]).collect()}
    want = {d: len({v for h, v in rows if h // 7 == d and v}) for d in range(5)}
    assert got == want
    near = {r.d: r.n_distinct for r in distincts.estimated(distincts.sketches(df, ["h"], "v").select(day, "sketch"), ["d"]).collect()}
    assert all(abs(near[d] - n) <= 0.03 * n for d, n in want.items())


def test_build_diff_equals_diff_of_reports(spark):
    rows = spark.createDataFrame([(1, "a", True, True), (1, "a", True, True), (2, None, True, False), (3, "b", False, True)], "k long, v string, in_left boolean, in_right boolean")
    layers = lambda d: {"raw": {"same": d.where("k = 1"), "rows": d}, "late": {"none": d.where("k > 3"), "gone": d.where("k = 2")}}
    report = lambda side: quality.layer_report({a: {b: t.where(f"in_{side}").drop("in_left", "in_right") for b, t in ts.items()} for a, ts in layers(rows).items()})
    cols = ["layer", "table", "rows_left", "rows_right", "is_first"]
    got = sorted(map(tuple, quality.build_diff(layers(rows)).select(*cols).collect()))
    assert got == sorted(map(tuple, quality.layer_diff(report("left"), report("right")).select(*cols).collect()))
    assert got == [("late", "gone", 1, 0, False), ("raw", "rows", 3, 3, True)]
