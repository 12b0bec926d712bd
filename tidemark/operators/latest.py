"""Latest rows, values and slices. Order is always total: the caller's order columns, then all other columns."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key. Spark drops rows beyond n before the shuffle where it can."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def latest_values(df: DataFrame, keys: list[str], values: list[str], version: list[str], where: Column | None = None) -> DataFrame:
    """One row for each key with the values of its highest version: a partial maximum in the map tasks, no sort."""
    packed = F.struct(*version, *(v for v in values if v not in version))
    got = df.groupBy(*keys).agg(F.max(F.when(where, packed) if where is not None else packed).alias("_m"))
    return got.select(*keys, *(F.col(f"_m.{v}").alias(v) for v in values))


def latest_slice(df: DataFrame, slice_keys: list[str], run: str, stamp: str) -> DataFrame:
    """All rows of the newest run of each slice. The newest run of each is found by a small aggregate and joined back."""
    newest = df.groupBy(*slice_keys).agg(F.max(F.struct(stamp, run)).alias("_n")).select(*slice_keys, F.col(f"_n.{run}").alias(run))
    return df.join(newest, [*slice_keys, run], "left_semi")


def replace_latest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    return latest_rows(df, keys, [F.desc(version), *(F.desc(c) for c in df.columns if c not in {*keys, version})])


# Fixed values of the event contract: days that rows of each kind of table are kept.
RETENTION_DAYS = {"raw": 90, "normalized": 90, "job": 90, "metadata": 7, "dirty": 30, "claims": 7, "work": 1}


def apply_retention(df: DataFrame, stamp: str, days: int, now: Column) -> DataFrame:
    return df.where(F.col(stamp) >= now - F.make_interval(days=F.lit(days)))


def kept_by_policy(df: DataFrame, kind: str, stamp: str, now: Column) -> DataFrame:
    """Rows no older than their kind of table is kept; kinds without a policy are kept for good."""
    limit = F.coalesce(*(F.when(F.col(kind) == k, F.lit(d)) for k, d in RETENTION_DAYS.items()))
    return df.where(limit.isNull() | (F.col(stamp) >= now - F.make_interval(days=limit)))


def drop_old_days(spark: SparkSession, table: str, kind: str, today: date, column: str = "day") -> list[str]:
    """Delete the day partitions of a stored table that its policy no longer keeps, by their names, without reading a row."""
    files = spark._jvm.org.apache.hadoop.fs
    pattern = files.Path(f"{table}/{column}=*")
    system, gone = pattern.getFileSystem(spark._jsc.hadoopConfiguration()), []
    for found in system.globStatus(pattern) or []:
        day = found.getPath().getName().partition("=")[2]
        if day < (today - timedelta(days=RETENTION_DAYS[kind])).isoformat():
            system.delete(found.getPath(), True)
            gone.append(day)
    return sorted(gone)
