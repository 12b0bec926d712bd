"""Registered queries of the engine's operators on the given tables, each with its DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import asof, changes, distincts, evidence, latest, quality, sessions
from tidemark.sources import envelopes, runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers started from another folder find this package too; where it is installed, that changes nothing.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def us(c: str | Column) -> Column:
    return F.unix_micros(c)


def hour() -> Column:
    return F.date_trunc("hour", F.col("ts"))


# Latest rows and slices ------------------------------------------------------------------------------------------------


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn = 1")
def w1_latest_rows(spark, sf_dir):
    return latest.latest_rows(events(spark, sf_dir), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max_by(value, (ts, event_id)) AS value FROM events WHERE event_type <> 'error' GROUP BY user_id")
def w2_latest_values(spark, sf_dir):
    rows = events(spark, sf_dir).where("event_type <> 'error'")
    return latest.latest_values(rows, ["user_id"], ["event_type", "value"], ["ts", "event_id"])


@query("WITH d AS (SELECT *, CAST(ts AS DATE) dy FROM events), m AS (SELECT dy, max_by(event_type, (ts, event_type)) et FROM d GROUP BY dy) SELECT event_id, user_id, d.event_type FROM d JOIN m ON d.dy = m.dy AND d.event_type = m.et")
def j1_latest_slice(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return latest.latest_slice(rows, ["day"], "event_type", "ts").select("event_id", "user_id", "event_type")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders) WHERE rn = 1")
def s10_replace_latest(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest.replace_latest(rows, ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice")


@query("WITH e AS (SELECT *, CASE event_type WHEN 'error' THEN 'metadata' WHEN 'click' THEN 'work' WHEN 'view' THEN 'raw' ELSE 'other' END AS kind, (SELECT max(ts) FROM events) AS now FROM events) SELECT event_id, kind FROM e WHERE kind = 'other' OR ts >= now - to_days(CAST(CASE kind WHEN 'metadata' THEN 7 WHEN 'work' THEN 1 ELSE 90 END AS INTEGER))")
def s11_retention(spark, sf_dir):
    """Each kind of row by the policy of its table; kinds without one are kept."""
    kind = F.when(F.col("event_type") == "error", "metadata").when(F.col("event_type") == "click", "work").when(F.col("event_type") == "view", "raw").otherwise("other")
    rows = events(spark, sf_dir).withColumn("kind", kind)
    return latest.kept_by_policy(rows, "kind", "ts", F.lit(rows.agg(F.max("ts")).first()[0])).select("event_id", "kind")


# Rollups ---------------------------------------------------------------------------------------------------------------


@query("SELECT epoch_us(date_trunc('hour', ts)) AS hour_us, event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users, CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS value_sum, round(CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) / count(*), 4) AS value_avg FROM events GROUP BY 1, 2")
def a6_hourly_rollup(spark, sf_dir):
    out = events(spark, sf_dir).groupBy(hour().alias("h"), "event_type").agg(F.count("*").alias("n_events"), F.count_distinct("user_id").alias("n_users"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("s"))
    return out.select(us("h").alias("hour_us"), "event_type", "n_events", "n_users", F.col("s").alias("value_sum"), F.round(expr.ratio(F.col("s"), F.col("n_events")), 4).alias("value_avg"))


@query("SELECT user_id, max_by(event_id, (ts, event_id)) FILTER (WHERE event_type = 'click') AS last_click, epoch_us(min(ts) FILTER (WHERE event_type = 'error')) AS first_error_us, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) AS n FROM events GROUP BY user_id")
def a1_conditional_rollup(spark, sf_dir):
    is_ = lambda t: F.col("event_type") == t
    return events(spark, sf_dir).groupBy("user_id").agg(F.max(F.when(is_("click"), F.struct("ts", "event_id")))["event_id"].alias("last_click"), us(F.min(F.when(is_("error"), F.col("ts")))).alias("first_error_us"), F.count_if(is_("error")).alias("errors"), F.count("*").alias("n"))


@query("SELECT epoch_us(date_trunc('hour', ts)) AS hour_us, round(avg(value), 4) AS avg_value, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99, count(*) AS n FROM events GROUP BY 1")
def a9_latency_percentiles(spark, sf_dir):
    e = events(spark, sf_dir).select(hour().alias("h"), "value")
    at = quality.grouped_percentiles(e, ["h"], "value", [0.5, 0.95, 0.99])
    p = [F.round(F.col("percentiles")[i], 4).alias(name) for i, name in enumerate(("p50", "p95", "p99"))]
    return e.groupBy("h").agg(F.round(F.avg("value"), 4).alias("avg_value")).join(at, "h").select(us("h").alias("hour_us"), "avg_value", *p, "n")


_BENCH = "SELECT p_brand AS brand, CAST(l_shipdate AS DATE) AS d, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS v, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, l_returnflag, l_linestatus"


def exact(c: str) -> Column:
    """A sum of money that doesn't depend on the order of rows."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def _benchmark(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    grain = rows.groupBy(F.col("p_brand").alias("brand"), F.to_date("l_shipdate").alias("d"), "l_returnflag", "l_linestatus").agg((exact("l_extendedprice") / exact("l_quantity")).alias("v"))
    at = quality.grouped_percentiles(grain, ["brand", "d"], "v", [0.1, 0.5, 0.9])
    return at.select("brand", "d", *(F.col("percentiles")[i].alias(f"p{q}") for i, q in enumerate((10, 50, 90))), "n")


# The exact percentile of sorted values, in the same steps as Spark's.
_Q = "CASE WHEN floor((n - 1) * {0}) = ceil((n - 1) * {0}) THEN x[CAST(floor((n - 1) * {0}) AS INTEGER) + 1] ELSE (ceil((n - 1) * {0}) - (n - 1) * {0}) * x[CAST(floor((n - 1) * {0}) AS INTEGER) + 1] + ((n - 1) * {0} - floor((n - 1) * {0})) * x[CAST(ceil((n - 1) * {0}) AS INTEGER) + 1] END"
_BENCH_Q = f"WITH g AS ({_BENCH}), l AS (SELECT brand, d, list_sort(list(v)) AS x, count(*) AS n FROM g GROUP BY 1, 2), b AS (SELECT brand, d, {_Q.format('CAST(0.1 AS DOUBLE)')} AS p10, {_Q.format('CAST(0.5 AS DOUBLE)')} AS p50, {_Q.format('CAST(0.9 AS DOUBLE)')} AS p90, n FROM l)"


@query(f"{_BENCH_Q} SELECT brand, epoch_us(CAST(d AS TIMESTAMP)) AS day_us, p10, p50, p90, n FROM b")
def a12_benchmark_daily(spark, sf_dir):
    return _benchmark(spark, sf_dir).select("brand", us(F.col("d").cast("timestamp")).alias("day_us"), "p10", "p50", "p90", "n")


@query(f"{_BENCH_Q} SELECT x.brand, epoch_us(CAST(x.d AS TIMESTAMP)) AS day_us, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS cohort_rows, CAST(sum(CAST(b.p50 AS DECIMAL(18, 8)) * b.n) AS DOUBLE) / sum(b.n) AS cohort_p50 FROM b x LEFT JOIN b ON b.brand = x.brand AND b.d < x.d AND b.d >= x.d - 7 GROUP BY 1, 2")
def a13_cohort_weighted(spark, sf_dir):
    b = _benchmark(spark, sf_dir)
    prior = b.select("brand", "d", F.explode(F.transform(F.sequence(F.lit(1), F.lit(7)), lambda o: F.date_sub("d", o))).alias("pd"))
    got = prior.join(b.select("brand", F.col("d").alias("pd"), "p50", "n"), ["brand", "pd"], "left").groupBy("brand", "d").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("cohort_rows"), (F.sum(F.col("p50").cast("decimal(18,8)") * F.col("n").cast("decimal(10,0)")).cast("double") / F.sum("n")).alias("cohort_p50"))
    return got.select("brand", us(F.col("d").cast("timestamp")).alias("day_us"), "cohort_rows", "cohort_p50")


@query("""WITH h AS (SELECT user_id, date_trunc('hour', ts) h, count(*) n, avg(value) v FROM events GROUP BY 1, 2), b AS (SELECT quantile_cont(v, 0.5) p50, quantile_cont(v, 0.1) p10, count(*) r FROM h)
SELECT user_id, epoch_us(h) AS hour_us, round(0.5 + least(n / 30.0, 1) * ((CASE WHEN r < 48 THEN 0.5 WHEN p50 <= p10 THEN (CASE WHEN v >= p50 THEN 1 ELSE 0 END) WHEN v >= p50 THEN 1 WHEN v <= p10 THEN 0 ELSE (v - p10) / (p50 - p10) END) - 0.5), 6) AS score FROM h, b""")
def d12_component_scores(spark, sf_dir):
    h = events(spark, sf_dir).groupBy("user_id", hour().alias("h")).agg(F.count("*").alias("n"), F.avg("value").alias("v"))
    p50, p10 = quality.exact_percentiles(h, "v", [0.5, 0.1])
    raw = expr.position_score(F.col("v"), F.lit(p50), F.lit(p10), F.lit(h.count()), rising=True)
    return h.select("user_id", us("h").alias("hour_us"), F.round(expr.dampened(raw, F.col("n"), 30.0), 6).alias("score"))


@query("""WITH f AS (SELECT o_custkey k, count(*) req, count(*) FILTER (WHERE o_orderstatus <> 'P') ok, count(*) FILTER (WHERE o_orderpriority LIKE '1%') sw FROM orders GROUP BY 1)
SELECT k AS o_custkey, round(100.0 * least(req / 3.0, 1.0) * (0.7 * (0.4 * (ok / req) + 0.2 * (1.0 - sw / req) + 0.4 * (ok / req)) + 0.3 * 0.5), 6) AS sla_score FROM f""")
def d13_sla_score(spark, sf_dir):
    f = orders(spark, sf_dir).groupBy("o_custkey").agg(F.count("*").alias("req"), F.count_if(F.col("o_orderstatus") != "P").alias("ok"), F.count_if(F.col("o_orderpriority").startswith("1")).alias("sw"))
    half = F.lit(0.5)
    rate = lambda c: expr.ratio(c, F.col("req"))
    return f.select("o_custkey", F.round(expr.sla_score(F.col("req"), F.least(F.col("req") / 3, F.lit(1.0)), rate(F.col("ok")), 1.0 - rate(F.col("sw")), rate(F.col("ok")), half, half, half), 6).alias("sla_score"))


@query("SELECT n_name, CASE WHEN cnt > 1 THEN n_name || ' #' || CAST(c_custkey AS VARCHAR) ELSE n_name END AS label, c_custkey FROM (SELECT c_custkey, lower(n_name) l, n_name, count(*) OVER (PARTITION BY lower(n_name)) cnt FROM customer JOIN nation ON c_nationkey = n_nationkey)")
def a23_identity_labels(spark, sf_dir):
    named = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    n = F.count("*").over(Window.partitionBy(F.lower("n_name")))
    return named.withColumn("_n", n).select("n_name", F.when(F.col("_n") > 1, F.concat("n_name", F.lit(" #"), F.col("c_custkey").cast("string"))).otherwise(F.col("n_name")).alias("label"), "c_custkey")


@query("SELECT event_type, count(*) AS n_rows, count(*) FILTER (WHERE value > 50) AS hits, count(*) FILTER (WHERE value > 50) / count(*) AS rate FROM events GROUP BY 1 HAVING count(*) >= 100")
def a33_guarded_rate(spark, sf_dir):
    return quality.guarded_rate(events(spark, sf_dir), ["event_type"], F.col("value") > 50, 100)


@query("SELECT DISTINCT user_id % 10 AS org, CAST(ts AS DATE) = CAST(ts AS DATE) AS touched, epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS day_us FROM events")
def a29_partition_listing(spark, sf_dir):
    return events(spark, sf_dir).select((F.col("user_id") % 10).alias("org"), F.lit(True).alias("touched"), us(F.date_trunc("day", "ts")).alias("day_us")).distinct()


# Changes and as-of -----------------------------------------------------------------------------------------------------

_W = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query(f"WITH x AS (SELECT *, lag(event_type) {_W} p FROM events) SELECT user_id, event_id, event_type, CASE WHEN p IS NULL THEN 'initial' WHEN value > 95 THEN 'explicit_swap' ELSE 'observed_change' END AS \"trigger\", row_number() {_W} AS seq FROM x WHERE p IS NULL OR value > 95 OR p <> event_type")
def w3_selection_boundaries(spark, sf_dir):
    return changes.selections(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "event_type", F.col("value") > 95).select("user_id", "event_id", "event_type", "trigger", F.col("seq").cast("long"))


@query(f"WITH x AS (SELECT *, lag(event_type) {_W} p FROM events), v AS (SELECT * FROM x WHERE p IS DISTINCT FROM event_type OR p IS NULL) SELECT user_id, event_id, event_type, CAST(row_number() {_W} AS BIGINT) AS version, epoch_us(ts) AS from_us, epoch_us(lead(ts) {_W}) AS to_us FROM v")
def w6_version_intervals(spark, sf_dir):
    out = changes.intervals(events(spark, sf_dir), ["user_id"], "ts", ["ts", "event_id"], "event_type")
    return out.select("user_id", "event_id", "event_type", F.col("version").cast("long"), us("valid_from").alias("from_us"), us("valid_to").alias("to_us"))


@query(f"WITH x AS (SELECT *, CASE WHEN lag(event_type) {_W} <> event_type THEN 1 ELSE 0 END s FROM events) SELECT user_id, event_id, CAST(1 + sum(s) {_W} AS BIGINT) AS segment FROM x")
def d20_segments(spark, sf_dir):
    return changes.segments(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "event_type").select("user_id", "event_id", F.col("segment").cast("long"))


@query("""WITH e AS (SELECT * FROM events WHERE event_type = 'error'), s AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'signup'),
m AS (SELECT e.event_id, any_value(e.ts) ts, max(s.ts) FILTER (WHERE s.ts < e.ts) p, max(s.ts) FILTER (WHERE s.ts = e.ts) q, min(s.ts) FILTER (WHERE s.ts > e.ts) n FROM e LEFT JOIN s USING (user_id) GROUP BY e.event_id)
SELECT event_id, CASE WHEN q IS NOT NULL THEN 'exact' WHEN p IS NOT NULL AND epoch_us(ts) - epoch_us(p) <= 86400000000 THEN 'exact' WHEN epoch_us(n) - epoch_us(ts) <= 3600000000 THEN 'future' WHEN p IS NOT NULL THEN 'stale' ELSE 'none' END AS match_class FROM m""")
def j15_asof_classes(spark, sf_dir):
    e = events(spark, sf_dir)
    near = asof.neighbours(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("valid_from")), ["user_id"], "ts", "valid_from")
    return asof.interval_class(near.withColumn("_end", F.lit(None).cast("timestamp")), "ts", "_end", fresh_s=86_400, skew_s=3_600).select("event_id", "match_class")


@query("""WITH c AS (SELECT * FROM events WHERE event_type = 'click'), v AS (SELECT * FROM events WHERE event_type = 'error')
SELECT c.event_id, max_by(v.event_id, (v.ts, v.event_id)) AS asof_event_id FROM c LEFT JOIN v ON v.user_id = c.user_id AND v.ts <= c.ts GROUP BY 1""")
def j16_asof_latest(spark, sf_dir):
    e = events(spark, sf_dir)
    right = e.where("event_type = 'error'").select("user_id", F.col("ts").alias("rts"), "event_id")
    left = e.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", "ts")
    return asof.latest_before(left, right, ["user_id"], "ts", "rts", "event_id").select(F.col("click_id").alias("event_id"), "asof_event_id")


# Joins, sets and pages -------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def j8_left_anti(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(done, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')")
def j2_owned_windows(spark, sf_dir):
    owned = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(owned, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("""WITH a AS (SELECT nullif(event_type, 'view') k, count(*) n FROM events WHERE user_id % 3 <> 0 GROUP BY 1), b AS (SELECT nullif(event_type, 'view') k, count(*) n FROM events WHERE event_type <> 'signup' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, a.n AS n_left, b.n AS n_right FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k WHERE a.n IS NULL OR b.n IS NULL OR a.n <> b.n""")
def j12_reconcile(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("k", F.nullif("event_type", F.lit("view")))
    count = lambda d: d.groupBy("k").agg(F.count("*").alias("n"))
    return quality.reconcile(count(e.where("user_id % 3 <> 0")), count(e.where("event_type <> 'signup'")), ["k"], ["n"])


@query("SELECT DISTINCT s_suppkey, s_name, n_name, coalesce(r_name, '') AS r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'")
def j20_inventory_distinct(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    out = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select("s_suppkey", "s_name", "n_name", F.coalesce("r_name", F.lit("")).alias("r_name")).distinct()


@query("SELECT c_nationkey, c_acctbal, c_name FROM (SELECT c_nationkey, c_acctbal, min(c_name) c_name FROM customer GROUP BY 1, 2) JOIN (SELECT c_nationkey, max(c_acctbal) c_acctbal FROM customer GROUP BY 1) USING (c_nationkey, c_acctbal)")
def j19_identity_ambiguity(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("_r", F.rank().over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal")))).where("_r = 1")
    return c.groupBy("c_nationkey", "c_acctbal").agg(F.min("c_name").alias("c_name"))


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def u3_union_distinct(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("SELECT o_orderkey, epoch_us(o_orderdate) AS date_us FROM orders WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1999-01-01 00:00:00', 500) ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 51")
def f7_keyset_page(spark, sf_dir):
    page = orders(spark, sf_dir).where("struct(o_orderdate, o_orderkey) < struct(timestamp '1999-01-01 00:00:00', 500L)")
    return page.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(51).select("o_orderkey", us("o_orderdate").alias("date_us"))


@query("SELECT o_orderkey, o_orderpriority, epoch_us(o_orderdate) AS date_us FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' OR (o_orderdate = TIMESTAMP '1999-01-01' AND (o_orderpriority, o_orderkey) > ('2-HIGH', 10)) ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey LIMIT 51")
def f8_keyset_page_mixed(spark, sf_dir):
    at = F.lit("1999-01-01 00:00:00").cast("timestamp")
    page = orders(spark, sf_dir).where((F.col("o_orderdate") < at) | ((F.col("o_orderdate") == at) & F.expr("struct(o_orderpriority, o_orderkey) > struct('2-HIGH', 10L)")))
    return page.orderBy(F.desc("o_orderdate"), "o_orderpriority", "o_orderkey").limit(51).select("o_orderkey", "o_orderpriority", us("o_orderdate").alias("date_us"))


@query("WITH t AS (SELECT user_id FROM events GROUP BY 1 ORDER BY avg(value) DESC, user_id LIMIT 8) SELECT epoch_us(date_trunc('day', ts)) AS day_us, user_id, round(avg(value), 4) AS v FROM events WHERE user_id IN (SELECT user_id FROM t) GROUP BY 1, 2")
def t1_topk_prefilter(spark, sf_dir):
    e = events(spark, sf_dir)
    top = e.groupBy("user_id").agg(F.avg("value").alias("m")).orderBy(F.desc("m"), "user_id").limit(8).select("user_id")
    return e.join(F.broadcast(top), "user_id", "left_semi").groupBy(F.date_trunc("day", "ts").alias("d"), "user_id").agg(F.round(F.avg("value"), 4).alias("v")).select(us("d").alias("day_us"), "user_id", "v")


@query("SELECT user_id, max_by(value, (ts, event_id)) AS latest_score FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def t2_top_by_latest(spark, sf_dir):
    return latest.latest_values(events(spark, sf_dir), ["user_id"], ["value"], ["ts", "event_id"]).select("user_id", F.col("value").alias("latest_score")).orderBy(F.desc("latest_score"), "user_id").limit(10)


@query("SELECT user_id, score FROM (SELECT user_id, avg(value) FILTER (WHERE event_type = 'error') score FROM events GROUP BY 1) ORDER BY score IS NULL, score DESC, user_id LIMIT 20")
def t3_nulls_last(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg(F.avg(F.when(F.col("event_type") == "error", F.col("value"))).alias("score")).orderBy(F.desc_nulls_last("score"), "user_id").limit(20)


@query("SELECT epoch_us(ts) AS ts_us, event_id, user_id FROM events WHERE event_type <> 'error' ORDER BY ts DESC, event_id DESC LIMIT 50")
def t5_recent_feed(spark, sf_dir):
    return events(spark, sf_dir).where("event_type <> 'error'").orderBy(F.desc("ts"), F.desc("event_id")).limit(50).select(us("ts").alias("ts_us"), "event_id", "user_id")


@query("""WITH h AS (SELECT date_trunc('hour', ts) h, count(*) n FROM events GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY h) rn, count(*) OVER () c FROM h), s AS (SELECT CAST(sum(n) FILTER (WHERE rn <= c // 2) AS BIGINT) AS before_n, CAST(sum(n) FILTER (WHERE rn > c // 2) AS BIGINT) AS after_n FROM r) SELECT before_n, after_n, round(100.0 * (after_n - before_n) / before_n, 4) AS change_pct FROM s""")
def w12_half_split_delta(spark, sf_dir):
    h = events(spark, sf_dir).groupBy(hour().alias("h")).agg(F.count("*").alias("n"))  # a row for each hour: these windows see no more
    r = h.withColumns({"rn": F.row_number().over(Window.orderBy("h")), "c": F.count("*").over(Window.partitionBy())})
    early = F.col("rn") <= F.floor(F.col("c") / 2)
    s = r.agg(F.sum(F.when(early, F.col("n"))).alias("before_n"), F.sum(F.when(~early, F.col("n"))).alias("after_n"))
    return s.withColumn("change_pct", F.round(100.0 * (F.col("after_n") - F.col("before_n")) / F.col("before_n"), 4))


# Quality ---------------------------------------------------------------------------------------------------------------


@query("SELECT o_custkey, o_orderdate = o_orderdate AS same, epoch_us(o_orderdate) AS date_us, count(*) AS n_rows FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1")
def c1_grain_unique(spark, sf_dir):
    return quality.grain_violations(orders(spark, sf_dir), ["o_custkey", "o_orderdate"]).select("o_custkey", F.lit(True).alias("same"), us("o_orderdate").alias("date_us"), "n_rows")


@query("SELECT count(*) FILTER (WHERE event_id IS NULL) AS event_id_null, count(user_id) - count(DISTINCT user_id) AS user_id_repeated, count(*) FILTER (WHERE event_type NOT IN ('click', 'error')) AS event_type_not_accepted FROM events")
def c2_column_contracts(spark, sf_dir):
    return quality.contract_counts(table(spark, sf_dir, "events"), ["event_id"], ["user_id"], {"event_type": ["click", "error"]})


@query("WITH s AS (SELECT event_type, count(*) n FROM events GROUP BY 1), d AS (SELECT event_type, count(*) n FROM events WHERE value < 90 GROUP BY 1) SELECT event_type, s.n AS source_rows, coalesce(d.n, 0) AS derived_rows, coalesce(d.n, 0) / s.n AS coverage, s.n >= 20 AND coalesce(d.n, 0) / s.n < 0.98 AS alert FROM s LEFT JOIN d USING (event_type)")
def c7_coverage(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return quality.coverage(e, e.where("value < 90"), ["event_type"])


@query("""WITH h AS (SELECT event_type, date_trunc('hour', ts) h, count(*) n FROM events GROUP BY 1, 2), m AS (SELECT a.event_type, a.h, any_value(a.n) n, quantile_cont(b.n, 0.5) md FROM h a JOIN h b ON b.event_type = a.event_type AND b.h < a.h AND b.h >= a.h - INTERVAL 24 HOUR GROUP BY 1, 2)
SELECT event_type, epoch_us(h) AS hour_us, n AS n_rows, md AS median_before FROM m WHERE n < 0.6 * md""")
def c8_density_collapse(spark, sf_dir):
    return quality.density_collapse(events(spark, sf_dir).withColumn("h", hour()), ["event_type"], "h", share=0.6).select("event_type", us("h").alias("hour_us"), "n_rows", "median_before")


@query("SELECT count(event_id) - count(DISTINCT event_id) AS duplicates FROM events")
def a32_duplicates(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "events"), "event_id")


@query("SELECT count(*) AS n_rows, CAST(sum(CAST(('0x' || substr(m, 1, 12)) AS BIGINT)) AS VARCHAR) AS sum_a, CAST(sum(CAST(('0x' || substr(m, 13, 12)) AS BIGINT)) AS VARCHAR) AS sum_b FROM (SELECT md5(concat_ws('|', coalesce('=' || CAST(c_acctbal AS DECIMAL(18, 2)), 'null'), coalesce('=' || c_custkey, 'null'), coalesce('=' || c_mktsegment, 'null'), coalesce('=' || c_name, 'null'), coalesce('=' || c_nationkey, 'null'))) AS m FROM customer)")
def c15_fingerprint(spark, sf_dir):
    return quality.text_fingerprint(table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)")))


@query()
def c15_checksum(spark, sf_dir):
    return quality.fingerprint(table(spark, sf_dir, "lineitem"))


@query("""WITH x AS (SELECT o_custkey, o_orderkey, o_totalprice, count(*) OVER w n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) lo, row_number() OVER (PARTITION BY o_custkey ORDER BY abs(o_totalprice - 250000), o_orderkey) mid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) hi FROM orders WINDOW w AS (PARTITION BY o_custkey))
SELECT o_custkey, o_orderkey, n, lo = 1 AS lowest, mid = 1 AS middle, hi = 1 AS highest FROM x WHERE n >= 5 AND (lo = 1 OR mid = 1 OR hi = 1)""")
def w10_cohort_bands(spark, sf_dir):
    by = Window.partitionBy("o_custkey")
    rn = lambda *o: F.row_number().over(by.orderBy(*o, "o_orderkey")) == 1
    x = table(spark, sf_dir, "orders").withColumns({"n": F.count("*").over(by), "lowest": rn(F.col("o_totalprice")), "middle": rn(F.abs(F.col("o_totalprice") - 250000)), "highest": rn(F.desc("o_totalprice"))})
    return x.where("n >= 5 and (lowest or middle or highest)").select("o_custkey", "o_orderkey", "n", "lowest", "middle", "highest")


@query("SELECT event_type, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) FILTER (WHERE json_extract(props, '$.k') IS NULL) AS parse_errors, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY 1")
def i1_event_type_profile(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), us(F.min("ts")).alias("first_us"), us(F.max("ts")).alias("last_us"), F.count_if(k.isNull()).alias("parse_errors"), F.sum(k.cast("long")).alias("k_sum"))


# The event pipeline on envelopes derived from ``events`` -----------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.with_raw_columns(envelopes.from_events(events(spark, sf_dir)), {"network_events": "north"})


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.route(raw(spark, sf_dir))[0]


_RAW = """WITH r AS (SELECT *, event_id % 10 k, (event_id // 10) % 12 t, 's' || user_id AS stream_id, 'north|s' || user_id || '|r' || strftime(ts, '%Y%m%d') AS session_key, epoch_us(ts) // 1000 AS ms FROM events)"""


@query(f"""{_RAW} SELECT CASE WHEN k = 9 THEN 'unsupported_event_family' WHEN k < 4 AND t = 10 THEN 'ignored_stream_trace_non_core_app' WHEN k < 4 AND t = 11 AND event_id % 20 = 11 THEN 'ignored_stream_trace_scope_client_noise' WHEN k < 4 AND t = 11 THEN 'unsupported_stream_trace_type' ELSE 'accepted' END AS reason, count(*) AS n FROM r GROUP BY 1""")
def s5_route_counts(spark, sf_dir):
    good, ignored = envelopes.route(raw(spark, sf_dir))
    return good.select(F.lit("accepted").alias("reason")).unionByName(ignored.select(F.col("ignore_reason").alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"{_RAW} SELECT CAST(event_id AS VARCHAR) AS event_id, session_key, CASE WHEN event_type = 'error' THEN 'OFFLINE' ELSE 'ONLINE' END AS state, value AS output_fps FROM r WHERE k BETWEEN 4 AND 6")
def p2_normalize_status(spark, sf_dir):
    return envelopes.stream_status(accepted(spark, sf_dir)).select("event_id", "session_key", "state", "output_fps")


@query(f"{_RAW} SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(floor(value * 100) AS BIGINT) AS face_value_wei, 'm' || (user_id % 7) AS pipeline_hint FROM r WHERE k = 7")
def p10_parse_payments(spark, sf_dir):
    return envelopes.payments(accepted(spark, sf_dir)).select("event_id", F.col("face_value_wei").cast("long"), "pipeline_hint")


@query(f"""{_RAW} SELECT session_key, min(ms) FILTER (WHERE t = 0) AS started_ms, min(ms) FILTER (WHERE t = 4) AS playable_ms, count(*) FILTER (WHERE t = 6) AS no_provider_count, count(*) FILTER (WHERE t = 7) AS swap_count FROM r WHERE k < 4 AND t < 8 GROUP BY 1""")
def a1_session_traces(spark, sf_dir):
    out = sessions.trace_rollup(envelopes.stream_trace(accepted(spark, sf_dir)))
    return out.select("session_key", F.unix_millis("started_at").alias("started_ms"), F.unix_millis("playable_at").alias("playable_ms"), "no_provider_count", "swap_count")


@query(f"{_RAW} SELECT session_key, epoch_ms(date_trunc('hour', ts)) AS hour_ms, count(*) AS status_samples, count(*) FILTER (WHERE value > 0) AS fps_positive_samples, count(*) FILTER (WHERE event_type <> 'error') AS running_samples, round(sum(value), 4) AS output_fps_sum FROM r WHERE k BETWEEN 4 AND 6 GROUP BY 1, 2")
def a6_session_status_hours(spark, sf_dir):
    out = sessions.status_rollup(envelopes.stream_status(accepted(spark, sf_dir)), hourly=True)
    return out.select("session_key", F.unix_millis("hour").alias("hour_ms"), "status_samples", "fps_positive_samples", "running_samples", F.round("output_fps_sum", 4).alias("output_fps_sum"))


_FACTS = f"""{_RAW}, f AS (SELECT session_key, min(ms) FILTER (WHERE k < 4 AND t = 0) started, bool_or(k < 4 AND t = 4) playable, count(*) FILTER (WHERE k < 4 AND t = 6) no_orch, count(*) FILTER (WHERE k BETWEEN 4 AND 6) samples, count(*) FILTER (WHERE k BETWEEN 4 AND 6 AND event_type = 'error') errs, count(*) FILTER (WHERE k BETWEEN 4 AND 6 AND event_type = 'error' AND event_id % 2 = 0) exc, count(*) FILTER (WHERE k BETWEEN 4 AND 6 AND value > 0) pos, coalesce(sum(value) FILTER (WHERE k BETWEEN 4 AND 6), 0) fps FROM r WHERE (k < 4 AND t < 8) OR k BETWEEN 4 AND 6 GROUP BY 1),
o AS (SELECT *, CASE WHEN started IS NULL THEN 'unknown' WHEN playable THEN 'success' ELSE 'failed' END outcome FROM f)"""


@query(f"{_FACTS} SELECT session_key, outcome AS startup_outcome, CASE WHEN outcome = 'failed' AND no_orch > 0 THEN 'no_orch' WHEN outcome = 'failed' AND errs > 0 AND errs = exc THEN 'excusable_error' ELSE '' END AS excusal_reason, samples AS status_samples, CAST(samples > 0 AND pos = 0 AS INTEGER) AS zero_output FROM o")
def d3_session_facts(spark, sf_dir):
    good = accepted(spark, sf_dir)
    return sessions.facts_of(evidence.session_evidence(envelopes.session_rows(good))).select("session_key", "startup_outcome", "excusal_reason", "status_samples", "zero_output")


@query(f"""{_RAW}, j AS (SELECT 'r' || strftime(ts, '%Y%m%d') AS request_id, event_id, ms, (event_id // 10) % 2 AS done, (event_id // 20) % 3 <> 0 AS ok, CAST(floor(value) AS BIGINT) AS ms_taken FROM r WHERE k = 8)
SELECT request_id, max_by(CASE WHEN done = 1 THEN ok END, (done, ms, CAST(event_id AS VARCHAR))) AS success, max_by(ms_taken, (done, ms, CAST(event_id AS VARCHAR))) AS duration_ms, min(ms) FILTER (WHERE done = 0) AS received_ms FROM j GROUP BY 1""")
def d10_ai_batch_facts(spark, sf_dir):
    out = sessions.job_facts(envelopes.ai_batch(accepted(spark, sf_dir)))
    return out.select("request_id", "success", "duration_ms", F.unix_millis("received_at").alias("received_ms"))


@query("""WITH h AS (SELECT * FROM (SELECT *, lag(event_type) OVER w AS before FROM events WHERE event_type <> 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE before IS DISTINCT FROM event_type),
s AS (SELECT * FROM events WHERE event_type = 'error'),
m AS (SELECT s.event_id, any_value(s.ts) AS ts, any_value(s.user_id) AS user_id, max(h.ts) FILTER (WHERE h.ts < s.ts) AS p, max(h.ts) FILTER (WHERE h.ts = s.ts) AS q, min(h.ts) FILTER (WHERE h.ts > s.ts) AS n FROM s LEFT JOIN h USING (user_id) GROUP BY 1),
c AS (SELECT *, CASE WHEN q IS NOT NULL THEN 'exact' WHEN p IS NOT NULL AND epoch_us(ts) - epoch_us(p) <= 600000000 THEN 'exact' WHEN n IS NOT NULL AND epoch_us(n) - epoch_us(ts) <= 30000000 THEN 'future' WHEN p IS NOT NULL THEN 'stale' END AS kind FROM m),
a AS (SELECT c.*, h.event_id AS hid, h.event_type AS model FROM c LEFT JOIN h ON h.user_id = c.user_id AND h.ts = CASE WHEN c.kind = 'future' THEN c.n WHEN c.q IS NOT NULL THEN c.q WHEN c.kind IS NOT NULL THEN c.p END)
SELECT md5(concat_ws('|', user_id % 5, user_id, event_id)) AS selection_id, CASE WHEN kind IS NULL THEN 'unresolved' WHEN hid % 5 = 0 THEN 'hardware_less' WHEN kind = 'stale' THEN 'stale' ELSE 'resolved' END AS status, CASE WHEN kind IS NULL THEN 'missing_candidate' WHEN hid % 5 = 0 THEN 'matched_without_hardware' WHEN kind = 'exact' THEN 'matched' WHEN kind = 'future' THEN 'future_skew' ELSE 'stale_candidate' END AS reason,
CASE WHEN kind IS NULL THEN 'low' WHEN kind = 'stale' THEN 'medium' ELSE 'high' END AS confidence, CASE WHEN kind IS NOT NULL THEN CAST(user_id AS VARCHAR) END AS address, CASE WHEN kind IS NOT NULL THEN 'https://u' || user_id END AS uri, CASE WHEN kind IS NOT NULL THEN 'live' END AS pipeline, model, CASE WHEN hid % 5 <> 0 THEN 'g' || (hid % 3) END AS gpu_id FROM a""")
def j15_attribution(spark, sf_dir):
    """The whole attribution chain on histories derived from ``events``: users are providers, event types their models."""
    e = events(spark, sf_dir)
    org = (F.col("user_id") % 5).cast("string")
    hist = changes.intervals(e.where("event_type <> 'error'").withColumn("org", org), ["org", "user_id"], "ts", ["ts", "event_id"], "event_type")
    hist = hist.select("org", F.concat(F.lit("https://u"), "user_id").alias("ident"), F.lit("uri").alias("ident_type"), "valid_from", "valid_to", F.col("user_id").cast("string").alias("address"), F.concat(F.lit("https://u"), "user_id").alias("uri"), F.lit("live").alias("pipeline"), F.col("event_type").alias("model"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("g"), F.col("event_id") % 3)).alias("gpu_id"), F.md5(F.col("event_id").cast("string")).alias("interval_hash"))
    sel = changes.selections(e.where("event_type = 'error'").withColumn("org", org), ["org", "user_id"], ["ts", "event_id"], "event_type", F.lit(True))
    sel = sel.select(expr.hash_id(F.col("org"), F.col("user_id"), F.col("event_id")).alias("selection_id"), "org", F.concat(F.lit("https://u"), "user_id").alias("ident"), "ts", F.lit("").alias("pipeline"), F.lit("").alias("model"))
    return asof.attribute(sel, hist)


@query(f"{_RAW} SELECT epoch_ms(date_trunc('minute', ts)) AS minute_ms, CASE WHEN k < 4 THEN 'stream_trace' WHEN k < 7 THEN 'ai_stream_status' WHEN k = 7 THEN 'create_new_payment' ELSE 'ai_batch_request' END AS event_type, count(*) AS n_events FROM r WHERE k < 9 AND NOT (k < 4 AND t > 9) GROUP BY 1, 2")
def r9_minute_throughput(spark, sf_dir):
    w = accepted(spark, sf_dir).groupBy(F.window("event_ts", "1 minute").alias("w"), "event_type").agg(F.count("*").alias("n_events"))
    return w.select(F.unix_millis("w.start").alias("minute_ms"), "event_type", "n_events")


@query("SELECT ps_brand AS pipeline, list_aggregate(list_sort(list(DISTINCT p_type)), 'string_agg', ',') AS models FROM (SELECT p_brand ps_brand, p_type FROM part) GROUP BY 1")
def q5_pipeline_catalog(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("pipeline")).agg(F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("models"))


@query("SELECT l_partkey, l_suppkey, l_extendedprice / l_quantity AS unit_price FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) rn FROM lineitem) WHERE rn = 1")
def w9_latest_price(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    order = [F.desc(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")]
    return latest.latest_rows(rows, ["l_partkey", "l_suppkey"], order).select("l_partkey", "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))


# Fields of the events' payloads: what each family has, from its derivation.
_FIELDS = f"""{_RAW}, a AS (SELECT *, CASE WHEN k < 4 THEN 'stream_trace' WHEN k < 7 THEN 'ai_stream_status' WHEN k = 7 THEN 'create_new_payment' ELSE 'ai_batch_request' END AS family FROM r WHERE k < 9 AND NOT (k < 4 AND t > 9)),
f AS (SELECT family, unnest(list_concat([('stream_id', 'str'), ('request_id', 'str'), ('pipeline', 'str'), ('client_source', 'str'), ('state', 'str'), ('inference_status', 'object'), ('inference_status.fps', 'float'), ('orchestrator_info', 'object'), ('orchestrator_info.address', 'str'), ('orchestrator_info.url', 'str'), ('faceValue', 'str'), ('sender', 'str'), ('recipient', 'str'), ('manifestID', 'str'), ('success', 'bool'), ('duration_ms', 'int')], CASE WHEN k < 4 OR k = 8 THEN [('type', 'str')] ELSE [] END, CASE WHEN event_type = 'error' THEN [('inference_status.last_error', 'str')] ELSE [] END)) AS x FROM a)"""


@query(f"{_FIELDS} SELECT family AS event_type, x[1] AS path, x[2] AS kind, count(*) AS n FROM f GROUP BY 1, 2, 3")
def i2_field_inventory(spark, sf_dir):
    return quality.field_inventory(accepted(spark, sf_dir), ["event_type"], "data")


@query("SELECT event_type, epoch_us(date_trunc('day', ts)) AS day_us, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1, 2")
def a4_daily_users_from_hours(spark, sf_dir):
    """Distinct users of a day out of hourly bitmaps."""
    hourly = distincts.bitmaps(events(spark, sf_dir).withColumn("h", hour()), ["event_type", "h"], "user_id")
    days = distincts.counted(hourly.withColumn("d", F.date_trunc("day", "h")), ["event_type", "d"], "n_users")
    return days.select("event_type", us("d").alias("day_us"), "n_users")


@query("SELECT o_orderpriority, EXTRACT(year FROM o_orderdate) AS y, count(DISTINCT o_custkey % 5003) AS n_senders FROM orders GROUP BY 1, 2")
def a19_yearly_senders_from_months(spark, sf_dir):
    """Distinct senders of a year, texts that a dictionary numbers, out of monthly bitmaps."""
    o = orders(spark, sf_dir).select("o_orderpriority", F.date_trunc("month", "o_orderdate").alias("m"), F.concat(F.lit("sender-"), F.col("o_custkey") % 5003).alias("sender"))
    path = runs.scratch(spark, "dictionary")
    distincts.dictionary(o, "sender").write.parquet(path)
    named = o.join(spark.read.parquet(path).withColumnRenamed("value", "sender"), "sender")
    monthly = distincts.bitmaps(named, ["o_orderpriority", "m"], "id")
    years = distincts.counted(monthly.withColumn("y", F.year("m").cast("long")), ["o_orderpriority", "y"], "n_senders")
    return years.select("o_orderpriority", "y", "n_senders")
