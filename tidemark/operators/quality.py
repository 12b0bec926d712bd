"""Checks of tables: grains, reconciliation, coverage, density, fingerprints."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def grain_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.agg((F.count(key) - F.count_distinct(key)).alias("duplicates"))


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Keys whose values differ or that one side lacks; null keys match null keys."""
    x, y = a.alias("x"), b.alias("y")
    on = reduce(lambda p, q: p & q, (F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys))
    off = [F.col(f"x.{v}").isNull() | F.col(f"y.{v}").isNull() | (F.abs(F.col(f"x.{v}") - F.col(f"y.{v}")) > tolerance) for v in values]
    out = x.join(y, on, "full").where(reduce(lambda p, q: p | q, off))
    return out.select(*(F.coalesce(f"x.{k}", f"y.{k}").alias(k) for k in keys), *(F.col(f"{s}.{v}").alias(f"{v}_{n}") for v in values for s, n in (("x", "left"), ("y", "right"))))


def contract_counts(df: DataFrame, not_null: list[str], unique: list[str], accepted: dict[str, list]) -> DataFrame:
    """One row: violations by column."""
    return df.agg(
        *(F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in not_null),
        *((F.count(c) - F.count_distinct(c)).alias(f"{c}_repeated") for c in unique),
        *(F.count_if(~F.col(c).isin(v)).alias(f"{c}_not_accepted") for c, v in accepted.items()),
    )


@dataclass
class Contract:
    """What a table's rows must keep to: columns that are never null, accepted values, bounds, and the stamp whose freshness counts."""

    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    stamp: str | None = None

    def metrics(self) -> list[Column]:
        """Aggregates that a writing job can observe on its way: violations by column, and the newest stamp."""
        stamp = [F.max(F.unix_micros(self.stamp)).alias("newest_us")] if self.stamp else []
        return [
            *(F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in self.not_null), *(F.count_if(~F.col(c).isin(v)).alias(f"{c}_not_accepted") for c, v in self.accepted.items()),
            *(F.count_if(~F.col(c).between(a, b)).alias(f"{c}_out_of_bounds") for c, (a, b) in self.bounds.items()), *stamp,
        ]


def metric_rows(spark: SparkSession, table: str, metrics: dict[str, int | str | None]) -> DataFrame:
    """(table, metric, value) of what a writing job has observed."""
    return spark.createDataFrame([(table, k, None if v is None else str(v)) for k, v in sorted(metrics.items())], "table string, metric string, value string")


def coverage(source: DataFrame, derived: DataFrame, keys: list[str], least: float = 0.98, rows: int = 20) -> DataFrame:
    a, b = (d.groupBy(*keys).agg(F.count("*").alias(n)) for d, n in ((source, "source_rows"), (derived, "derived_rows")))
    got = a.join(b, keys, "left").fillna({"derived_rows": 0}).withColumn("coverage", F.col("derived_rows") / F.col("source_rows"))
    return got.withColumn("alert", (F.col("source_rows") >= rows) & (F.col("coverage") < least))


def density_collapse(df: DataFrame, keys: list[str], hour: str, back: int = 24, share: float = 0.2) -> DataFrame:
    """Hours with fewer rows than ``share`` of the exact median of the ``back`` hours before. Hours are counted first, so windows see one row for each."""
    counts = df.groupBy(*keys, hour).agg(F.count("*").alias("n_rows"))
    w = Window.partitionBy(*keys).orderBy(F.unix_micros(hour)).rangeBetween(-back * 3_600_000_000, -1)
    return counts.withColumn("median_before", F.expr("percentile(n_rows, 0.5)").over(w)).where(F.col("n_rows") < share * F.col("median_before"))


def fingerprint(df: DataFrame, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Rows and an order-independent 128-bit checksum; a null is a value of its own, and repeated rows count."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in sorted(df.columns) if c not in leave_out]
    one = df.select(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit("second"), *cols).alias("b"))
    return one.agg(F.count("*").alias("n_rows"), F.bit_xor("a").alias("xor_a"), F.bit_xor("b").alias("xor_b"), F.sum(F.col("a").cast("decimal(38,0)")).alias("sum_a"))


def text_fingerprint(df: DataFrame, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Rows and two order-independent sums of halves of each row's MD5, over its columns by name as text; other systems can compute it too."""
    one = df.select(_row_digest(df, leave_out).alias("m"))
    return one.agg(F.count("*").alias("n_rows"), _digest_sum(1).alias("sum_a"), _digest_sum(13).alias("sum_b"))


def _row_digest(df: DataFrame, leave_out: tuple[str, ...] = ()) -> Column:
    cols = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in sorted(df.columns) if c not in leave_out]
    return F.md5(F.concat_ws("|", *cols))


def _digest_sum(at: int, where: Column | None = None) -> Column:
    part = F.conv(F.substring("m", at, 12), 16, 10).cast("decimal(38,0)")
    return F.sum(part if where is None else F.when(where, part)).cast("string")


def field_inventory(df: DataFrame, keys: list[str], payload: str, depth: int = 6) -> DataFrame:
    """Fields of JSON texts by path, the kinds of their values and how often each stands: (keys, path, kind, n).

    Fields of objects are followed down to ``depth`` steps, of arrays the first element (a step that adds ``[]``). A text
    is parsed once and walked level by level in the row; counts are summed partly in the map tasks.
    """
    node = "array<struct<path:string,value:variant,named:boolean>>"

    def below(n):
        fields = F.try_variant_get(n.value, "$", "map<string,variant>")
        named = F.transform(F.map_entries(fields), lambda e: F.struct(F.concat(n.path, F.lit("."), e.key).alias("path"), e.value.alias("value"), F.lit(True).alias("named")))
        first = F.try_variant_get(n.value, "$[0]", "variant")
        inside = F.array(F.struct(F.concat(n.path, F.lit("[]")).alias("path"), first.alias("value"), F.lit(False).alias("named")))
        return F.when(fields.isNotNull(), named).when(first.isNotNull(), inside).otherwise(F.array().cast(node))

    rows = df.select(*keys, F.array(F.struct(F.lit("").alias("path"), F.try_parse_json(payload).alias("value"), F.lit(False).alias("named"))).alias("_0"))
    for k in range(depth):
        rows = rows.withColumn(f"_{k + 1}", F.flatten(F.transform(f"_{k}", below)))
    kind = F.schema_of_variant(F.col("f.value"))
    short = F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "str").when(kind == "BOOLEAN", "bool").when(kind == "BIGINT", "int").when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "float").when(kind == "VOID", "null").otherwise(F.lower(kind))
    flat = rows.select(*keys, F.explode(F.concat(*(f"_{k + 1}" for k in range(depth)))).alias("f")).where("f.named")
    return flat.groupBy(*keys, F.substring("f.path", 2, 1 << 20).alias("path"), short.alias("kind")).agg(F.count("*").alias("n"))


def lags(df: DataFrame, keys: list[str], event: str, ingested: str, now: Column) -> DataFrame:
    """Of each group: time since its newest event and its newest ingest, how far the newest event lies behind the newest ingest, and the longest way of a row, in microseconds."""
    us = F.unix_micros
    out = df.groupBy(*keys).agg(F.max(event).alias("_e"), F.max(ingested).alias("_i"), F.max(us(ingested) - us(event)).alias("longest_us"))
    return out.select(*keys, (us(now) - us("_e")).alias("lag_us"), (us(now) - us("_i")).alias("ingest_lag_us"), (us("_i") - us("_e")).alias("watermark_lag_us"), "longest_us")


def layer_report(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(layer, place, table, n_rows, checksum): a fingerprint of each table, in the order of the layers; rows may come in any order."""
    one = lambda place, layer, name, df: text_fingerprint(df).select(F.lit(layer).alias("layer"), F.lit(place).alias("place"), F.lit(name).alias("table"), "n_rows", F.concat_ws("-", "sum_a", "sum_b").alias("checksum"))
    return reduce(DataFrame.unionByName, (one(k, layer, name, df) for k, (layer, tables) in enumerate(layers.items()) for name, df in tables.items()))


def layer_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tables whose fingerprints differ between two reports, or that one lacks; ``is_first`` marks those of the first layer that diverges, where a cause is to be looked for."""
    side = lambda d, n: d.select("layer", "place", "table", F.col("n_rows").alias(f"rows_{n}"), F.col("checksum").alias(f"sum_{n}"))
    off = side(a, "left").join(side(b, "right"), ["layer", "place", "table"], "full").where(~F.col("sum_left").eqNullSafe(F.col("sum_right")))
    return _marked_first(off)


def _marked_first(off: DataFrame) -> DataFrame:
    first = F.min("place").over(Window.partitionBy())  # a row for each table: a join of them with their minimum would derive all tables twice
    return off.withColumn("is_first", F.col("place") == first).drop("place")


def build_diff(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """``layer_diff`` of two builds whose rows stand in the same tables, with ``in_left`` and ``in_right``: each table is derived once, and a row digested once, for both."""

    def one(place: int, layer: str, name: str, df: DataFrame) -> DataFrame:
        marks = ("in_left", "in_right")
        rows = df.select(_row_digest(df, marks).alias("m"), *marks)
        side = lambda n: (F.count_if(F.col(f"in_{n}")).alias(f"rows_{n}"), F.concat_ws("-", *(_digest_sum(at, F.col(f"in_{n}")) for at in (1, 13))).alias(f"sum_{n}"))
        return rows.agg(*side("left"), *side("right")).select(F.lit(layer).alias("layer"), F.lit(place).alias("place"), F.lit(name).alias("table"), "rows_left", "sum_left", "rows_right", "sum_right")

    each = reduce(DataFrame.unionByName, (one(k, layer, name, df) for k, (layer, tables) in enumerate(layers.items()) for name, df in tables.items()))
    return _marked_first(each.where(~F.col("sum_left").eqNullSafe(F.col("sum_right"))))


def guarded_rate(df: DataFrame, keys: list[str], hit: Column, least: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_if(hit).alias("hits")).where(F.col("n_rows") >= least).withColumn("rate", F.col("hits") / F.col("n_rows"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: nulls of each additive counter, and rows."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns), F.count("*").alias("n_rows"))


def missing_for_known(df: DataFrame, known: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of known keys whose column is blank though it must not be."""
    return df.where(F.coalesce(F.trim(column), F.lit("")) == "").join(known.select(key).distinct(), key, "left_semi")


def not_above(df: DataFrame, column: str, least: float = 0) -> DataFrame:
    """Rows whose value isn't above ``least``, or isn't there."""
    return df.where(~F.coalesce(F.col(column) > least, F.lit(False)))


def exact_percentiles(df: DataFrame, value: str, shares: list[float], most: int = 1_000_000) -> list[float | None]:
    """Exact interpolated percentiles of a whole column, by ``grouped_percentiles``; nulls without values."""
    rows = grouped_percentiles(df.select(F.lit(0).alias("_all"), F.col(value).alias("_v")), ["_all"], "_v", shares, most).first()
    return list(rows.percentiles) if rows else [None] * len(shares)


def grouped_percentiles(df: DataFrame, keys: list[str], value: str, shares: list[float], most: int = 1_000_000) -> DataFrame:
    """(keys, n, percentiles): exact interpolated percentiles of each group at ``shares``, and its values' number; nulls don't count.

    Values are counted by group first, and the counts are stored. Groups of up to ``most`` different values are sorted in
    a buffer each. Of larger ones the counts are sorted in ranges over many tasks; sums by group and range tell in which
    ranges a percentile's two ranks lie, and only these ranges are gone through, so that no task holds a whole group.
    """
    from tidemark.sources.runs import scratch

    spark = df.sparkSession

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = scratch(spark, name)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    counts = stored(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n")), "value-counts")
    sizes = counts.groupBy(*keys).agg(F.count("*").alias("_kinds"))
    large = sizes.where(F.col("_kinds") > most).drop("_kinds")
    same = lambda a, b: reduce(lambda p, q: p & q, (F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys))
    small = counts.alias("c").join(large.alias("l"), same("c", "l"), "left_anti") if large.limit(1).count() else counts
    wanted = F.array(*map(F.lit, shares))
    out = small.groupBy(*keys).agg(F.sum("_n").alias("n"), F.percentile("_v", wanted, F.col("_n")).alias("percentiles"))
    if small is counts:
        return out
    big = counts.alias("c").join(large.alias("l"), same("c", "l"), "left_semi")
    ordered = stored(big.repartitionByRange(*keys, "_v").sortWithinPartitions(*keys, "_v").withColumn("_at", F.monotonically_increasing_id()), "value-order").withColumn("_range", F.shiftright("_at", 33))
    per = ordered.groupBy(*keys, "_range").agg(F.sum("_n").alias("_k"))
    w = Window.partitionBy(*keys)  # a row for each range of a group
    per = per.withColumns({"n": F.sum("_k").over(w), "_before": F.sum("_k").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_k")})
    # Each share asks for two ranks of the sorted values, from 0; a range that holds one is looked through.
    place = lambda q: (F.col("n") - 1) * F.lit(float(q))
    asks = F.array(*(F.struct(F.lit(i).alias("share"), F.lit(up).alias("up"), f(place(q)).cast("long").alias("rank"), (place(q) - F.floor(place(q))).alias("part")) for i, q in enumerate(shares) for up, f in ((False, F.floor), (True, F.ceil))))
    asked = per.select(*keys, "_range", "n", "_before", "_k", F.explode(asks).alias("a")).where((F.col("a.rank") >= F.col("_before")) & (F.col("a.rank") < F.col("_before") + F.col("_k")))
    needed = asked.groupBy(*keys, "_range", "n", "_before").agg(F.collect_list("a").alias("_asks"))  # two a share at most
    inside = ordered.alias("o").join(needed.alias("d"), same("o", "d") & (F.col("o._range") == F.col("d._range"))).select("o.*", "d.n", "d._before", "d._asks")
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    found = inside.withColumn("_to", F.col("_before") + upto).withColumn("_hits", F.filter("_asks", lambda a: (a.rank < F.col("_to")) & (a.rank >= F.col("_to") - F.col("_n")))).where(F.size("_hits") > 0)
    hits = found.select(*keys, "n", "_v", F.explode("_hits").alias("a")).groupBy(*keys, "n", "a.share").agg(F.max(F.when(~F.col("a.up"), F.col("_v"))).alias("_low"), F.max(F.when(F.col("a.up"), F.col("_v"))).alias("_high"), F.max("a.part").alias("_part"))
    mixed = F.when(F.col("_part") == 0, F.col("_low")).otherwise((1 - F.col("_part")) * F.col("_low") + F.col("_part") * F.col("_high"))
    picked = hits.groupBy(*keys, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("share", mixed.alias("v")))), lambda x: x.v).alias("percentiles"))
    return out.unionByName(picked)
