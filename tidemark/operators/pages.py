"""Views, keyset pages, summaries and profiles that are served to users."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators.supply import listed


def fact_view(facts: DataFrame, family: str, names: dict[str, str]) -> DataFrame:
    """All columns of the facts, stamped with their family; ``names`` adds columns by another name."""
    return facts.withColumns({new: F.col(old) for new, old in names.items()}).withColumn("family", F.lit(family))


def observed(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(old).alias(new) for old, new in names.items()))


def page_before(df: DataFrame, stamp: str, key: str, at: Column | None, last: Column | None, n: int) -> DataFrame:
    """The ``n`` newest rows before (at, last), newest first: the filter reaches the scan, and each task keeps n rows."""
    if at is not None:
        df = df.where((F.col(stamp) < at) | ((F.col(stamp) == at) & (F.col(key) < last)))
    return df.orderBy(F.desc(stamp), F.desc(key)).limit(n)


def page_after(df: DataFrame, order: list[tuple[str, bool]], last: list[Column] | None, n: int) -> DataFrame:
    """The ``n`` rows after ``last`` in an order of (column, falling)."""
    if last is not None:
        step = lambda i: (F.col(order[i][0]) < last[i]) if order[i][1] else (F.col(order[i][0]) > last[i])
        same = lambda i: reduce(lambda a, b: a & b, (F.col(c) == v for (c, _), v in zip(order[:i], last[:i], strict=True)), F.lit(True))
        df = df.where(reduce(lambda a, b: a | b, (same(i) & step(i) for i in range(len(order)))))
    return df.orderBy(*(F.desc(c) if down else F.asc(c) for c, down in order)).limit(n)


def auth_hourly(auth: DataFrame) -> DataFrame:
    return auth.groupBy(F.date_trunc("hour", "event_ts").alias("window_start"), "org", "capability").agg(F.count("*").alias("auth_count"), F.count_if("success").alias("success_count"))


def payments_hourly(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.date_trunc("hour", "event_ts").alias("window_start"), "org", "capability", "currency").agg(F.count("*").alias("payment_count"), F.sum(F.col("amount").cast("decimal(28,6)")).cast("double").alias("amount_sum"))


def auth_summary(hours: DataFrame, keys: list[str]) -> DataFrame:
    out = hours.groupBy(*keys).agg(F.sum("auth_count").alias("total"), F.sum("success_count").alias("succeeded"))
    return out.withColumn("success_rate", F.round(expr.ratio(F.col("succeeded"), F.col("total")), 6))


def job_summary(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, success rate and mean duration from sums."""
    out = jobs.groupBy(*keys).agg(F.count("*").alias("jobs"), F.count_if(F.coalesce("success", F.lit(False))).alias("succeeded"), F.sum("duration_ms").alias("_d"))
    return out.select(*keys, "jobs", "succeeded", F.round(expr.ratio(F.col("succeeded"), F.col("jobs")), 6).alias("success_rate"), F.round(expr.ratio(F.col("_d"), F.col("jobs")), 4).alias("avg_duration_ms"))


def llm_summary(requests: DataFrame, keys: list[str]) -> DataFrame:
    n = F.count("*")
    mean = lambda c: F.round(expr.ratio(F.sum(F.col(c).cast("decimal(28,6)")), n), 4)
    return requests.groupBy(*keys).agg(n.alias("requests"), F.sum("total_tokens").alias("tokens"), mean("duration_ms").alias("avg_duration_ms"), mean("tokens_per_second").alias("avg_tokens_per_second"), mean("ttft_ms").alias("avg_ttft_ms"))


def worker_summary(workers: DataFrame, keys: list[str]) -> DataFrame:
    price = expr.ratio(F.sum(F.col("price_per_unit").cast("decimal(28,6)")), F.count("*"))
    return workers.groupBy(*keys).agg(F.count_distinct("worker_url").alias("workers"), listed("model").alias("models"), F.round(price, 4).alias("avg_price"))


def models_with_demand(offered: DataFrame, jobs: DataFrame, key: str) -> DataFrame:
    """Offers of each model, with the jobs that asked for it (0 without any)."""
    price = expr.ratio(F.sum(F.col("price_per_unit").cast("decimal(28,6)")), F.count("*"))
    own = offered.groupBy(key).agg(F.count("*").alias("workers"), F.round(price, 4).alias("avg_price"))
    return own.join(jobs.groupBy(key).agg(F.count("*").alias("jobs")), key, "left").fillna({"jobs": 0})


def request_profile(families: dict[str, DataFrame]) -> DataFrame:
    """Rows, success in percent of those that tell it, and mean duration, by family and its capability or model."""
    none = {"success": F.lit(None).cast("boolean"), "duration_ms": F.lit(None).cast("long")}
    parts = []
    for kind, rows in families.items():
        name = F.col("capability" if "capability" in rows.columns else "model")
        parts.append(rows.select(F.lit(kind).alias("kind"), name.alias("name"), *((F.col(c) if c in rows.columns else v).alias(c) for c, v in none.items())))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("kind", "name").agg(F.count("*").alias("n"), F.round(100.0 * expr.ratio(F.count_if(F.coalesce("success", F.lit(False))), F.count("success")), 4).alias("success_pct"), F.round(expr.ratio(F.sum("duration_ms"), F.count("duration_ms")), 4).alias("avg_duration_ms"))


def weighted_mean(value: str, weight: str) -> Column:
    """Mean by weight, from exact decimal sums."""
    return expr.ratio(F.sum((F.col(value) * F.col(weight)).cast("decimal(28,6)")), F.sum(F.col(weight).cast("decimal(28,6)")))
