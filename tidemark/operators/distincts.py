"""Distinct counts that can be merged: exact ones by bitmaps of dictionary ids, estimated ones by sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dictionary(df: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, id) of all values that aren't null: those of ``known`` keep their ids, new ones are numbered after the largest of them.

    Ids of one task's values follow one another, so that few bitmaps hold them. Store the result before it is used
    twice: numbers of new values aren't the same in another run.
    """
    values = df.select(F.col(column).alias("value")).where("value is not null").distinct()
    if known is None:
        return values.withColumn("id", F.monotonically_increasing_id())
    top = known.agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0]  # one number
    fresh = values.join(known, "value", "left_anti").withColumn("id", F.monotonically_increasing_id() + F.lit(top + 1))
    return known.select("value", "id").unionByName(fresh)


def bitmaps(df: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """(keys, bucket, bitmap): the ids of each group as bits, 32,768 to a bitmap; ids are 0 or more, nulls don't count."""
    rows = df.where(F.col(ident).isNotNull()).withColumns({"bucket": F.bitmap_bucket_number(ident), "_p": F.bitmap_bit_position(ident)})
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_p").alias("bitmap"))


def merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps at a coarser grain."""
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(rows: DataFrame, keys: list[str], name: str = "n_distinct") -> DataFrame:
    """Distinct ids of each group out of bitmaps of any finer grain."""
    return merged(rows, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(name))


def sketches(df: DataFrame, keys: list[str], column: str, log_k: int = 14) -> DataFrame:
    """(keys, sketch): HyperLogLog state of each group; 2**log_k registers, a standard error of about 0.8 over the root of their number."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, log_k).alias("sketch"))


def estimated(rows: DataFrame, keys: list[str], name: str = "n_distinct") -> DataFrame:
    """Estimated distinct values of each group out of sketches of any finer grain."""
    return rows.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
