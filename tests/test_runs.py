"""Runs in two phases: a write that dies between them, corrections, empty slices, damage, and metrics of the writing job."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.sources import runs

KIND = "org string, hour timestamp, key string, n long, part string"
H = [datetime(2024, 1, 1, h) for h in range(3)]


def at(day):
    return F.lit(f"2024-02-{day:02d}").cast("timestamp")


def current(spark, table):
    return sorted((r.org, r.hour, r.key, r.n, r.refresh_run_id) for r in runs.read_runs(spark, table, ["org", "hour"]).collect())


def test_two_phases(spark, tmp_path, monkeypatch):
    table, make = str(tmp_path / "t"), lambda *rows: spark.createDataFrame([(*r, None) for r in rows], KIND)
    first = make(("a", H[0], "x", 1), ("a", H[0], "x", 1), ("a", H[1], "y", 2), ("007", H[0], "z", None))
    seen = runs.write_run(first, table, "1", at(1), ["org", "hour"])
    assert seen["n_rows"] == 4
    before = current(spark, table)
    assert before == [("007", H[0], "z", None, "1"), ("a", H[0], "x", 1, "1"), ("a", H[0], "x", 1, "1"), ("a", H[1], "y", 2, "1")]
    # The second run dies after its rows: readers see the first one.
    second = make(("a", H[0], "new", 9))

    def dies(*a, **b):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(runs, "commit_run", dies)
        with pytest.raises(RuntimeError):
            runs.write_run(second, table, "2", at(2), ["org", "hour"], owned=first.where("org = 'a'"))
    assert current(spark, table) == before
    # Written again it counts, and the slice that it owns without rows is empty now.
    runs.write_run(second, table, "2", at(2), ["org", "hour"], owned=first.where("org = 'a'"))
    assert [r for r in current(spark, table) if r[0] == "a"] == [("a", H[0], "new", 9, "2")]
    # A run of an older time doesn't hide a newer one, and a correction under the same id replaces it.
    runs.write_run(make(("a", H[0], "old", 0)), table, "0", at(1), ["org", "hour"])
    runs.write_run(make(("a", H[0], "right", 10)), table, "2", at(2), ["org", "hour"], owned=first.where("org = 'a'"))
    assert [r for r in current(spark, table) if r[0] == "a"] == [("a", H[0], "right", 10, "2")]
    assert runs.broken_slices(spark, table, ["org", "hour"]).count() == 0
    # Rows that change behind the manifest's back are noticed.
    runs.write_rows(make(("a", H[0], "wrong", 11)), table, "2", at(2), ["org", "hour"])
    assert [(r.org, r.hour) for r in runs.broken_slices(spark, table, ["org", "hour"]).collect()] == [("a", H[0])]


def test_rows_that_get_lost_stop_the_commit(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", H[0], str(i), i, None) for i in range(9)], KIND)
    real = runs.write_rows

    def loses(df, *a, **b):
        seen = real(df, *a, **b)
        real(df.limit(5), *a, **b)
        return seen

    monkeypatch.setattr(runs, "write_rows", loses)
    with pytest.raises(ValueError):
        runs.write_run(rows, table, "1", at(1), ["org", "hour"])
    assert runs._committed(spark, table) == []


def test_metrics_of_the_write_are_those_of_a_scan(spark, tmp_path):
    rows = spark.createDataFrame([(o, H[i % 3], None if i % 4 else "k", i, "p") for i in range(50) for o in ("a", "b")], KIND)
    contract = quality.Contract(["key", "n"], {"org": ["a"]}, {"n": (3, 40)}, "hour")
    seen = runs.write_run(rows, str(tmp_path / "t"), "1", at(1), ["org", "hour"], contract=contract)
    want = rows.agg(*contract.metrics(), F.count("*").alias("n_rows")).first().asDict()
    assert {k: v for k, v in seen.items() if k != "checksum"} == want
    got = {r.metric: r.value for r in quality.metric_rows(spark, "t", seen).collect()}
    assert got["n_rows"] == "100" and got["org_not_accepted"] == "50"


def test_old_days_go_by_name(spark, tmp_path):
    from datetime import date

    from tidemark.operators import latest

    table = str(tmp_path / "days")
    spark.createDataFrame([(f"2024-01-{d:02d}", d) for d in range(1, 31)], "day string, n int").write.partitionBy("day").parquet(table)
    assert latest.drop_old_days(spark, table, "metadata", date(2024, 1, 30)) == [f"2024-01-{d:02d}" for d in range(1, 23)]
    assert latest.drop_old_days(spark, table, "raw", date(2024, 1, 30)) == [] == latest.drop_old_days(spark, str(tmp_path / "none"), "raw", date(2024, 1, 30))
    assert {r.n for r in spark.read.parquet(table).collect()} == set(range(23, 31))
