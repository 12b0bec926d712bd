"""Registered supply, request, serving, check and profile queries; they join those of ``catalog``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import changes, evidence, latest, quality, sessions, supply
from tidemark.plans.catalog import _FACTS, _RAW, accepted, events, hour, orders, query, raw, table, us
from tidemark.sources import envelopes

_OFFERS = "WITH o AS (SELECT l_suppkey AS provider, p_brand AS pipeline, p_type AS model, l_partkey AS gpu, l_quantity AS capacity, l_extendedprice / l_quantity AS price, l_shipdate AS seen, l_orderkey, l_linenumber, l_returnflag AS kind FROM lineitem JOIN part ON l_partkey = p_partkey)"
_RECENT = f"{_OFFERS}, w AS (SELECT * FROM o WHERE seen >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 90 DAY)"
_NEW = "(seen, l_orderkey, l_linenumber, price)"


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers derived from ``lineitem`` and ``part``: suppliers are providers, parts GPUs, brands pipelines, types models."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gpu"), F.col("p_brand").alias("pipeline"), F.col("p_type").alias("model"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("provider"), F.col("l_partkey").alias("gpu"), F.col("l_quantity").alias("capacity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_shipdate").cast("timestamp").alias("seen"), "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("kind"))
    return rows.join(part, "gpu")


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = table(spark, sf_dir, "lineitem").agg(F.max(F.col("l_shipdate").cast("timestamp"))).first()[0]  # one value: the injected clock
    return latest.apply_retention(offers(spark, sf_dir), "seen", 90, F.lit(now))


# Supply ----------------------------------------------------------------------------------------------------------------


@query(f"{_OFFERS} SELECT pipeline, epoch_us(date_trunc('month', seen)) AS month_us, count(*) AS n, CAST(sum(CAST(price * capacity AS DECIMAL(18, 4))) AS DOUBLE) / sum(capacity) AS average, round(quantile_cont(price, 0.95), 8) AS p95, count(*) FILTER (WHERE kind = 'R') / count(*) AS return_rate FROM o GROUP BY 1, 2")
def a14_gpu_metrics(spark, sf_dir):
    rows = offers(spark, sf_dir).withColumn("m", F.date_trunc("month", "seen"))
    own = rows.groupBy("pipeline", "m").agg(expr.ratio(F.sum((F.col("price") * F.col("capacity")).cast("decimal(18,4)")), F.sum("capacity")).alias("average"), (F.count_if(F.col("kind") == "R") / F.count("*")).alias("return_rate"))
    at = quality.grouped_percentiles(rows, ["pipeline", "m"], "price", [0.95]).select("pipeline", "m", "n", F.round(F.col("percentiles")[0], 8).alias("p95"))
    return own.join(at, ["pipeline", "m"]).select("pipeline", us("m").alias("month_us"), "n", "average", "p95", "return_rate")


@query()
def a15_gpu_metrics_reaggregate(spark, sf_dir):
    """Monthly sums and sketches merged by pipeline; tests hold its quantiles against exact ones."""
    monthly = supply.metrics(offers(spark, sf_dir).withColumn("month", F.date_trunc("month", "seen")), ["pipeline", "month"], "price", "capacity")
    return supply.merge_metrics(monthly, ["pipeline"])


@query(f"{_RECENT} SELECT provider, count(DISTINCT gpu) AS gpus, list_aggregate(list_sort(list(DISTINCT pipeline)), 'string_agg', ',') AS pipelines, count(DISTINCT (pipeline, model)) AS pairs, round(sum(price * capacity) / sum(capacity), 4) AS weighted_price, max_by(price, {_NEW}) AS latest_price FROM w GROUP BY 1")
def a20_provider_snapshot(spark, sf_dir):
    return supply.provider_snapshot(recent(spark, sf_dir)).withColumn("weighted_price", F.round("weighted_price", 4))


@query(f"{_RECENT} SELECT provider, gpu, max_by(pipeline, {_NEW}) AS pipeline, max_by(model, {_NEW}) AS model, max_by(price, {_NEW}) AS price, epoch_us(max(seen)) AS last_us FROM w GROUP BY 1, 2")
def a21_gpu_inventory(spark, sf_dir):
    out = supply.gpu_inventory(recent(spark, sf_dir))
    return out.select("provider", "gpu", "pipeline", "model", "price", us("last_seen").alias("last_us"))


@query(f"""{_OFFERS}, a AS (SELECT provider, pipeline, count(*) n, max_by(price, {_NEW}) p FROM o WHERE kind = 'A' GROUP BY 1, 2), b AS (SELECT provider, pipeline, count(*) n FROM o WHERE kind = 'R' AND (provider, pipeline) NOT IN (SELECT (provider, pipeline) FROM a) GROUP BY 1, 2),
u AS (SELECT *, 'offer' AS origin FROM a UNION ALL SELECT provider, pipeline, n, NULL, 'worker' FROM b) SELECT provider, pipeline, n AS n_rows, p AS price, origin, s_name AS name FROM u LEFT JOIN supplier ON s_suppkey = provider""")
def a22_capability_spine(spark, sf_dir):
    o = offers(spark, sf_dir)
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("provider"), F.col("s_name").alias("name"))
    return supply.spine(o.where("kind = 'A'"), o.where("kind = 'R'"), names)


@query(f"{_OFFERS} SELECT provider, pipeline, model, max_by(price, {_NEW}) AS price, bool_or(capacity >= 45) AS warm FROM o WHERE price > 0 GROUP BY 1, 2, 3")
def q6_pricing(spark, sf_dir):
    return supply.prices(offers(spark, sf_dir), ["provider", "pipeline", "model"], 45.0)


@query(f"""{_OFFERS}, t AS (SELECT pipeline, model, count(DISTINCT gpu) gpus FROM o GROUP BY 1, 2), a AS (SELECT pipeline, model, count(DISTINCT l_orderkey) n FROM o WHERE capacity > 49 GROUP BY 1, 2)
SELECT t.pipeline, t.model, gpus, coalesce(n, 0) AS in_use, greatest(gpus - coalesce(n, 0), 0) AS available FROM t LEFT JOIN a USING (pipeline, model)""")
def q4_gpu_capacity(spark, sf_dir):
    o = offers(spark, sf_dir)
    return supply.capacity(o, o.where("capacity > 49").withColumn("stream", F.col("l_orderkey")), ["pipeline", "model"])


@query(f"{_OFFERS} SELECT provider, list_aggregate(list_sort(list(DISTINCT pipeline || ':' || model)), 'string_agg', ',') AS offered FROM o WHERE kind = 'A' GROUP BY 1")
def q17_requests_orchestrators(spark, sf_dir):
    return offers(spark, sf_dir).where("kind = 'A'").groupBy("provider").agg(supply.listed(F.concat_ws(":", "pipeline", "model")).alias("offered"))


@query("SELECT DISTINCT p_brand || ':' || p_type AS pair FROM part")
def a31_distinct_lists(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.concat_ws(":", "p_brand", "p_type").alias("pair")).distinct()


@query(f"{_OFFERS}, m AS (SELECT pipeline, model, count(*) n, sum(price * capacity) v, sum(capacity) c FROM o GROUP BY 1, 2) SELECT pipeline, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS models, round(sum(v) / sum(c), 4) AS price FROM m GROUP BY 1 ORDER BY n_rows DESC, pipeline LIMIT 5")
def t4_topn_after_regroup(spark, sf_dir):
    m = offers(spark, sf_dir).groupBy("pipeline", "model").agg(F.count("*").alias("n"), F.sum(F.col("price") * F.col("capacity")).alias("v"), F.sum("capacity").alias("c"))
    return m.groupBy("pipeline").agg(F.sum("n").alias("n_rows"), F.count("*").alias("models"), F.round(F.sum("v") / F.sum("c"), 4).alias("price")).orderBy(F.desc("n_rows"), "pipeline").limit(5)


# Joins -----------------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND c_acctbal > 0")
def j4_catalog_double_left(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, (F.col("n_regionkey") == F.col("r_regionkey")) & (F.col("c_acctbal") > 0), "left").select("c_custkey", "n_name", "r_name")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS offer FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'")
def j6_pricing_catalog(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_type")).alias("offer"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN c_name END AS stream_name, CASE WHEN o_orderstatus <> 'F' THEN s_name END AS request_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus = 'F' LEFT JOIN supplier ON s_suppkey = o_custkey AND o_orderstatus <> 'F'")
def j9_conditional_routed_join(spark, sf_dir):
    stream = F.col("o_orderstatus") == "F"
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), (F.col("c_custkey") == F.col("o_custkey")) & stream, "left")
    return rows.join(table(spark, sf_dir, "supplier"), (F.col("s_suppkey") == F.col("o_custkey")) & ~stream, "left").select("o_orderkey", F.col("c_name").alias("stream_name"), F.col("s_name").alias("request_name"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_partkey, l_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_quantity >= 50)")
def j10_semi_in_tuple(spark, sf_dir):
    rows, keys = table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]
    return rows.join(rows.where("l_quantity >= 50").select(*keys), keys, "left_semi").select("l_orderkey", "l_linenumber", *keys)


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)")
def j11_in_subquery_or(spark, sf_dir):
    """The two memberships as rows of one semi join, instead of a join on an OR."""
    ident = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id"))
    wanted = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(ident("c", "c_custkey").alias("i")).unionByName(table(spark, sf_dir, "lineitem").where("l_quantity >= 50").select(ident("o", "l_orderkey").alias("i")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.array(ident("c", "o_custkey"), ident("o", "o_orderkey"))).alias("i"))
    return rows.join(wanted, "i", "left_semi").select("o_orderkey").distinct()


@query("""WITH p AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE 'u' || user_id || '|' || strftime(ts, '%Y%m%d') END AS request FROM events WHERE event_type = 'purchase'), s AS (SELECT 'u' || user_id || '|' || strftime(ts, '%Y%m%d') AS request, min(event_id) AS session_id FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT event_id, session_id, CASE WHEN p.request = '' THEN 'no_request' WHEN session_id IS NULL THEN 'unlinked' ELSE 'linked' END AS link_status FROM p LEFT JOIN s ON s.request = p.request AND p.request <> ''""")
def j14_payment_session_link(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("request", F.concat(F.lit("u"), "user_id", F.lit("|"), F.date_format("ts", "yyyyMMdd")))
    paid = e.where("event_type = 'purchase'").select("event_id", F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("request")).alias("request"))
    return supply.payment_links(paid, e.where("event_type = 'signup'").groupBy("request").agg(F.min("event_id").alias("session_id")), "request").select("event_id", "session_id", "link_status")


@query("""WITH j AS (SELECT *, event_id % 3 AS url FROM events WHERE event_type = 'purchase'), w AS (SELECT *, event_id % 3 AS url FROM events WHERE event_type = 'click'), a AS (SELECT j.event_id, max_by(w.event_id, (w.ts, w.event_id)) FILTER (WHERE w.url = j.url) AS x, max_by(w.event_id, (w.ts, w.event_id)) AS y FROM j LEFT JOIN w ON w.user_id = j.user_id AND w.ts <= j.ts GROUP BY 1)
SELECT event_id, coalesce(x, y) AS worker_event_id FROM a""")
def j16_worker_model(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("url", F.col("event_id") % 3)
    jobs = e.where("event_type = 'purchase'").select(F.col("event_id").alias("job"), "user_id", "url", "ts")
    got = supply.worker_model(jobs, e.where("event_type = 'click'").select("user_id", "url", "ts", "event_id"), ["user_id", "url"], ["user_id"], "ts", "event_id")
    return got.select(F.col("job").alias("event_id"), "worker_event_id")


@query("SELECT c.event_id, epoch_us(min(r.ts) FILTER (WHERE r.ts <= c.ts)) AS received_us FROM events c LEFT JOIN events r ON r.user_id = c.user_id AND r.event_type = 'view' WHERE c.event_type = 'purchase' GROUP BY 1")
def j17_received_before_completed(spark, sf_dir):
    """The earliest receipt of a key decides: it is at or before the completion, or none is."""
    e = events(spark, sf_dir)
    first = e.where("event_type = 'view'").groupBy("user_id").agg(F.min("ts").alias("first"))
    return e.where("event_type = 'purchase'").join(first, "user_id", "left").select("event_id", us(F.when(F.col("first") <= F.col("ts"), F.col("first"))).alias("received_us"))


@query(f"{_RAW} SELECT CAST(event_id AS VARCHAR) AS event_id, session_key, 'network_events' AS source_topic, event_id AS source_offset FROM r WHERE k < 4 AND t = 6")
def j18_event_lineage(spark, sf_dir):
    good = accepted(spark, sf_dir)
    hits = envelopes.stream_trace(good).where("trace_type = 'gateway_no_orchestrators_available'").select("event_id", "session_key")
    return hits.join(good.select("event_id", "source_topic", "source_offset"), "event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderpriority = '5-LOW'")
def d16_row_change_filter(spark, sf_dir):
    """Rows that an older copy of the table lacks or has with another status; the older copy is derived from the table."""
    now = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    old = now.where("o_orderkey % 3 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderpriority") == "5-LOW", "?").otherwise(F.col("o_orderstatus")))
    return supply.changed_rows(now, old, ["o_orderkey"], ["o_orderstatus", "o_totalprice"]).select("o_orderkey")


# Requests and sessions -------------------------------------------------------------------------------------------------

_JOBS = f"""{_RAW}, j AS (SELECT 'r' || strftime(ts, '%Y%m%d') AS request_id, event_id, ms, (event_id // 10) % 2 AS done, CAST(floor(value) AS BIGINT) AS took, (event_id // 20) % 3 <> 0 AS ok FROM r WHERE k = 8),
f AS (SELECT request_id, max_by(ms, (done, ms, CAST(event_id AS VARCHAR))) AS ms, max_by(took, (done, ms, CAST(event_id AS VARCHAR))) AS took, max_by(CASE WHEN done = 1 THEN ok ELSE NULL END, (done, ms, CAST(event_id AS VARCHAR))) AS ok FROM j GROUP BY 1)"""


@query(f"{_JOBS} SELECT ms // 3600000 * 3600000 AS hour_ms, count(*) AS job_count, count(*) FILTER (WHERE ok) AS success_count, CAST(sum(took) AS BIGINT) AS duration_ms_sum, round(count(*) FILTER (WHERE ok) / count(*), 6) AS success_rate FROM f GROUP BY 1")
def a17_request_demand_hourly(spark, sf_dir):
    out = sessions.request_demand_hourly(sessions.job_facts(envelopes.ai_batch(accepted(spark, sf_dir))), [])
    return out.select(F.unix_millis("window_start").alias("hour_ms"), "job_count", "success_count", "duration_ms_sum", F.round("success_rate", 6).alias("success_rate"))


@query(f"{_FACTS}, d AS (SELECT started // 86400000 * 86400000 AS day_ms, count(*) n, count(*) FILTER (WHERE outcome = 'success') ok, sum(samples) s, sum(fps) v FROM o WHERE started IS NOT NULL GROUP BY 1) SELECT day_ms, n AS sessions, ok AS success_sessions, CAST(s AS BIGINT) AS status_samples, round(ok / n, 6) AS success_rate, round(v / nullif(s, 0), 4) AS avg_fps FROM d")
def a16_demand_reaggregate(spark, sf_dir):
    """Hourly counters summed by day, every ratio from the sums."""
    good = accepted(spark, sf_dir)
    hours = sessions.demand_hourly(sessions.facts_of(evidence.session_evidence(envelopes.session_rows(good))))
    days = hours.groupBy(F.date_trunc("day", "window_start").alias("d")).agg(*(F.sum(c).alias(c) for c in ("sessions", "requested_sessions", "success_sessions", "status_samples", "output_fps_sum")))
    return days.select(F.unix_millis("d").alias("day_ms"), "sessions", "success_sessions", "status_samples", F.round(expr.ratio(F.col("success_sessions"), F.col("requested_sessions")), 6).alias("success_rate"), F.round(expr.ratio(F.col("output_fps_sum"), F.col("status_samples")), 4).alias("avg_fps"))


@query("WITH x AS (SELECT user_id, max_by(value, (ts, event_id)) v, count(DISTINCT event_type) n FROM events GROUP BY 1) SELECT user_id, CASE WHEN v >= 50 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM x")
def a27_decision_with_ambiguity(spark, sf_dir):
    x = events(spark, sf_dir).groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "value"))["value"].alias("v"), F.count_distinct("event_type").alias("n"))
    resolved, none = F.col("v") >= 50, F.lit(False)
    return x.select("user_id", expr.attribution_status(resolved, ~resolved & (F.col("n") > 1), none, none).alias("status"))


@query("SELECT epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n FROM events")
def a30_raw_bounds(spark, sf_dir):
    return events(spark, sf_dir).agg(us(F.min("ts")).alias("first_us"), us(F.max("ts")).alias("last_us"), F.count("*").alias("n"))


@query("""WITH h AS (SELECT user_id, date_trunc('hour', ts) h, count(*) FILTER (WHERE event_type = 'purchase') f, count(*) FILTER (WHERE event_type = 'error') g, count(*) n FROM events GROUP BY 1, 2), b AS (SELECT user_id, min(ts) a, max(ts) z FROM events GROUP BY 1), x AS (SELECT *, f = 0 AND g = 0 AND n < 3 AS idle FROM h JOIN b USING (user_id))
SELECT user_id, epoch_us(h) AS hour_us, CAST(idle AND coalesce(lag(idle) OVER (PARTITION BY user_id ORDER BY h), false) AND a < h AND z >= h AND z < h + INTERVAL 1 HOUR AS INTEGER) AS is_tail_artifact FROM x""")
def w7_tail_artifact(spark, sf_dir):
    e = events(spark, sf_dir)
    kinds = {"fps_positive_samples": "purchase", "running_samples": "error"}
    hours = e.groupBy("user_id", hour().alias("h")).agg(*(F.count_if(F.col("event_type") == t).alias(c) for c, t in kinds.items()), F.count("*").alias("status_samples"), F.min("ts").alias("a"), F.max("ts").alias("z"))
    bounds = hours.groupBy("user_id").agg(F.min("a").alias("started_at"), F.max("z").alias("last_seen"))
    # An hour's own first row is in it, so only hours before the first can start a session earlier: the window sees one row for each hour.
    return changes.tail_artifacts(hours.join(bounds, "user_id"), ["user_id"], "h").select("user_id", us("h").alias("hour_us"), "is_tail_artifact")


@query("WITH p AS (SELECT user_id, max_by(props, (ts, event_id)) AS prompt FROM events GROUP BY 1) SELECT md5(regexp_replace(lower(prompt), '[^a-z0-9]+', ' ', 'g')) AS label, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, label LIMIT 15")
def w11_latest_prompt(spark, sf_dir):
    p = latest.latest_values(events(spark, sf_dir), ["user_id"], ["props"], ["ts", "event_id"])
    return p.groupBy(F.md5(F.regexp_replace(F.lower("props"), "[^a-z0-9]+", " ")).alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(15)


@query(f"{_RAW} SELECT CAST(event_id AS VARCHAR) AS event_id, session_key, CASE WHEN k < 4 THEN 'trace' ELSE 'status' END AS kind FROM r WHERE (k < 4 AND t = 6) OR (k BETWEEN 4 AND 6 AND event_type = 'error')")
def u2_union_failures(spark, sf_dir):
    good = accepted(spark, sf_dir)
    part = lambda rows, kind: rows.select("event_id", "session_key", F.lit(kind).alias("kind"))
    return part(envelopes.stream_trace(good).where("trace_type = 'gateway_no_orchestrators_available'"), "trace").unionByName(part(envelopes.stream_status(good).where(~expr.running(F.col("state"))), "status"))


@query(f"{_RAW} SELECT DISTINCT session_key FROM r WHERE k < 7 AND NOT (k < 4 AND t > 9) AND ts >= (SELECT max(ts) FROM events) - INTERVAL 2 DAY")
def u4_touched_sessions(spark, sf_dir):
    now = events(spark, sf_dir).agg(F.max("ts")).first()[0]
    good = accepted(spark, sf_dir).where(F.col("event_ts") >= F.date_trunc("millisecond", F.lit(now)) - F.make_interval(days=F.lit(2)))
    return envelopes.stream_trace(good).select("session_key").union(envelopes.stream_status(good).select("session_key")).distinct()


@query(f"{_FACTS}, l AS (SELECT session_key, max(ms) AS z FROM r WHERE (k < 4 AND t < 8) OR k BETWEEN 4 AND 6 GROUP BY 1) SELECT session_key, started // 3600000 * 3600000 AS hour_ms, (z - started) / CAST(60000 AS DOUBLE) AS minutes FROM o JOIN l USING (session_key) WHERE started IS NOT NULL")
def d5_demand_input(spark, sf_dir):
    good = accepted(spark, sf_dir)
    facts = sessions.facts_of(evidence.session_evidence(envelopes.session_rows(good))).where("started_at is not null")
    return facts.select("session_key", F.unix_millis(F.date_trunc("hour", "started_at")).alias("hour_ms"), ((F.unix_millis("last_seen") - F.unix_millis("started_at")) / F.lit(60000.0)).alias("minutes"))


@query("""WITH x AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'pip_sdxl-turbo' WHEN 'view' THEN 'Text-To-Image' WHEN 'signup' THEN 'llm' WHEN 'error' THEN 'unknown' ELSE '' END p, CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'StreamDiffusion' ELSE 'llm' END m FROM events), y AS (SELECT event_id, CASE WHEN m = '' AND p = 'pip_sdxl-turbo' THEN 'streamdiffusion-sdxl' WHEN m = 'StreamDiffusion' THEN 'streamdiffusion' ELSE m END m, CASE WHEN p IN ('Text-To-Image', 'llm') THEN lower(p) ELSE '' END p FROM x), z AS (SELECT event_id, m, CASE WHEN p <> '' THEN p WHEN m LIKE 'streamdiffusion%' THEN 'live-video-to-video' ELSE '' END p FROM y)
SELECT event_id, CASE WHEN p = m THEN '' ELSE p END AS pipeline, m AS model FROM z""")
def d8_normalize_hints(spark, sf_dir):
    kind, third = F.col("event_type"), F.col("user_id") % 3
    p = F.when(kind == "click", "pip_sdxl-turbo").when(kind == "view", "Text-To-Image").when(kind == "signup", "llm").when(kind == "error", "unknown").otherwise("")
    pipeline, model = expr.normal_hints(p, F.when(third == 0, "").when(third == 1, "StreamDiffusion").otherwise("llm"))
    return table(spark, sf_dir, "events").select("event_id", pipeline.alias("pipeline"), model.alias("model"))


# Serving and checks ----------------------------------------------------------------------------------------------------


@query("WITH m AS (SELECT max(ts) z FROM events) SELECT count(*) FILTER (WHERE ts > z - INTERVAL 72 HOUR) AS current_n, count(*) FILTER (WHERE ts <= z - INTERVAL 72 HOUR) AS previous_n, count(DISTINCT CASE WHEN ts > z - INTERVAL 72 HOUR THEN user_id END) AS active, round(100.0 * (count(*) FILTER (WHERE ts > z - INTERVAL 72 HOUR) - count(*) FILTER (WHERE ts <= z - INTERVAL 72 HOUR)) / count(*) FILTER (WHERE ts <= z - INTERVAL 72 HOUR), 4) AS change_pct FROM events, m WHERE ts > z - INTERVAL 144 HOUR")
def q1_dashboard_kpi(spark, sf_dir):
    e = events(spark, sf_dir)
    return supply.window_delta(e, "ts", F.lit(e.agg(F.max("ts")).first()[0]), 72)


@query(f"""{_OFFERS}, r AS (SELECT provider, sum(CASE WHEN kind = 'R' THEN 0 ELSE capacity END) / sum(capacity) AS v FROM o WHERE kind <> 'N' GROUP BY 1), s AS (SELECT provider, max_by(v, m) AS v FROM (SELECT provider, date_trunc('month', seen) m, sum(price * capacity) / sum(capacity) v FROM o GROUP BY 1, 2) GROUP BY 1)
SELECT coalesce(s_suppkey, r.provider) AS provider, s_name AS name, round(r.v, 6) AS reliability, round(s.v, 4) AS latest FROM supplier FULL JOIN r ON s_suppkey = r.provider LEFT JOIN s ON s.provider = coalesce(s_suppkey, r.provider)""")
def q3_dashboard_providers(spark, sf_dir):
    o = offers(spark, sf_dir)
    kept = F.when(F.col("kind") == "R", 0.0).otherwise(F.col("capacity"))
    reliable = o.where("kind <> 'N'").groupBy("provider").agg(F.round(expr.ratio(F.sum(kept), F.sum("capacity")), 6).alias("reliability"))
    monthly = o.groupBy("provider", F.date_trunc("month", "seen").alias("m")).agg(expr.ratio(F.sum(F.col("price") * F.col("capacity")), F.sum("capacity")).alias("v"))
    newest = monthly.groupBy("provider").agg(F.round(F.max(F.struct("m", "v"))["v"], 4).alias("latest"))
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("provider"), F.col("s_name").alias("name"))
    return names.join(reliable, "provider", "full").join(newest, "provider", "left")


@query(f"{_RAW} SELECT CASE WHEN k = 8 THEN 'ai_batch' ELSE 'stream' END AS kind, count(*) AS n, count(DISTINCT user_id) AS streams FROM r WHERE k < 7 AND NOT (k < 4 AND t > 9) OR k = 8 GROUP BY 1")
def q8_jobs_overview(spark, sf_dir):
    kind = F.when(F.col("event_type") == "ai_batch_request", "ai_batch").otherwise("stream")
    rows = accepted(spark, sf_dir).where(F.col("event_type").isin("stream_trace", "ai_stream_status", "ai_batch_request"))
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_distinct(F.get_json_object("data", "$.stream_id")).alias("streams"))


@query(f"{_RAW} SELECT 'm' || (user_id % 7) AS pipeline, count(*) AS n, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS DECIMAL(30,0))::VARCHAR AS total_wei, count(DISTINCT user_id % 13) AS senders, count(DISTINCT event_id % 17) AS recipients FROM r WHERE k = 7 GROUP BY 1")
def i5_payment_profile(spark, sf_dir):
    paid = envelopes.payments(accepted(spark, sf_dir)).groupBy(F.col("pipeline_hint").alias("pipeline"))
    return paid.agg(F.count("*").alias("n"), F.sum("face_value_wei").cast("string").alias("total_wei"), F.count_distinct("sender").alias("senders"), F.count_distinct("recipient").alias("recipients"))


_STREAMS = f"""{_RAW}, e AS (SELECT 's' || user_id AS stream_id, 'r' || strftime(ts, '%Y%m%d') AS request_id, ms, CAST(event_id AS VARCHAR) AS eid, k < 4 AS trace, k BETWEEN 4 AND 6 AS status, CASE WHEN event_id % 3 = 0 THEN '0x' || lpad(lower(to_hex(event_id % 17)), 40, '0') ELSE '' END AS addr, CASE WHEN event_type = 'error' THEN 'OFFLINE' ELSE 'ONLINE' END AS state, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'ICE connection state failed' WHEN event_type = 'error' THEN 'decoder broke' END AS err, value FROM r WHERE (k < 4 AND t < 10) OR k BETWEEN 4 AND 6),
p AS (SELECT *, lag(addr) OVER (PARTITION BY stream_id, request_id ORDER BY ms, eid) AS b FROM e WHERE addr <> ''), pr AS (SELECT stream_id, request_id, string_agg(addr, ',' ORDER BY ms, eid) AS providers, count(*) - 1 AS swaps FROM p WHERE b IS DISTINCT FROM addr GROUP BY 1, 2),
st AS (SELECT *, lag(state) OVER (PARTITION BY stream_id, request_id ORDER BY ms, eid) AS b FROM e WHERE status), sr AS (SELECT stream_id, request_id, string_agg(state, ',' ORDER BY ms, eid) AS states FROM st WHERE b IS DISTINCT FROM state GROUP BY 1, 2),
a AS (SELECT stream_id, request_id, min(ms) FILTER (WHERE trace) AS f, max(ms) AS l, count(*) FILTER (WHERE status) AS n, CAST(sum(CAST(value AS DECIMAL(18, 6))) FILTER (WHERE status) AS DOUBLE) AS fps, max_by(err, (ms, eid)) FILTER (WHERE status AND err IS NOT NULL) AS err FROM e GROUP BY 1, 2),
m AS (SELECT 's' || o_custkey AS stream_id, 'r' || (o_orderkey // 16) AS request_id, sum(o_custkey % 5) AS lost, max(epoch_ms(o_orderdate)) AS l FROM orders WHERE o_orderkey % 8 = 1 GROUP BY 1, 2), w AS (SELECT 's' || user_id AS stream_id, 'r' || strftime(ts, '%Y%m%d') AS request_id, count(*) AS c, sum(CAST(floor(value * 100) AS BIGINT)) AS wei FROM r WHERE k = 7 GROUP BY 1, 2), keys AS (SELECT stream_id, request_id FROM a UNION SELECT stream_id, request_id FROM m UNION SELECT stream_id, request_id FROM w)"""


@query(f"{_STREAMS} SELECT stream_id, request_id, coalesce(providers, '') AS providers, coalesce(swaps, 0) AS swaps, coalesce(states, '') AS states, coalesce(n, 0) AS fps_samples, round(fps / nullif(n, 0), 6) AS avg_fps, err AS last_error, CAST(coalesce(lost, 0) AS BIGINT) AS video_packets_lost, coalesce(c, 0) AS payments, CAST(coalesce(wei, 0) AS BIGINT) AS paid_wei, (greatest(a.l, m.l) - f) / 1000.0::DOUBLE AS duration_s, err IS NOT NULL AS had_failure, coalesce(states, '') NOT LIKE '%OFFLINE%' AS is_active FROM keys LEFT JOIN a USING (stream_id, request_id) LEFT JOIN pr USING (stream_id, request_id) LEFT JOIN sr USING (stream_id, request_id) LEFT JOIN m USING (stream_id, request_id) LEFT JOIN w USING (stream_id, request_id)")
def i3_stream_profile(spark, sf_dir):
    """Sessions and payments derived from ``events``, ingest metrics from ``orders``."""
    good = accepted(spark, sf_dir)
    paid = envelopes.payments(good, stream=True)
    more = envelopes.route(envelopes.with_raw_columns(envelopes.from_orders(orders(spark, sf_dir)), {"network_events": "north"}))[0]
    out = supply.stream_profile(envelopes.session_rows(good), paid, envelopes.ingest_metrics(more))
    return out.select("stream_id", "request_id", F.array_join("providers", ",").alias("providers"), F.col("swaps").cast("long"), F.array_join("states", ",").alias("states"), "fps_samples", F.round("avg_fps", 6).alias("avg_fps"), "last_error", "video_packets_lost", "payments", F.col("paid_wei").cast("long"), "duration_s", "had_failure", "is_active")


@query("SELECT 'orders' AS name, count(*) AS n_rows, count(o_custkey) AS with_key FROM orders UNION ALL SELECT 'lineitem', count(*), count(l_orderkey) FROM lineitem UNION ALL SELECT 'events', count(*), count(user_id) FROM events")
def c14_quality_snapshot(spark, sf_dir):
    one = lambda t, key: table(spark, sf_dir, t).agg(F.count("*").alias("n_rows"), F.count(key).alias("with_key")).withColumn("name", F.lit(t))
    return one("orders", "o_custkey").unionByName(one("lineitem", "l_orderkey")).unionByName(one("events", "user_id"))


@query("SELECT l_returnflag, l_linestatus, count(*) FILTER (WHERE l_discount NOT BETWEEN 0 AND 1) AS ratio_out, count(*) FILTER (WHERE l_tax > l_discount) AS order_broken, count(*) FILTER (WHERE l_quantity IS NULL) AS missing FROM lineitem GROUP BY 1, 2")
def c17_rollup_bounds(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count_if(~F.col("l_discount").between(0, 1)).alias("ratio_out"), F.count_if(F.col("l_tax") > F.col("l_discount")).alias("order_broken"), F.count_if(F.col("l_quantity").isNull()).alias("missing"))


@query("WITH e AS (SELECT *, ts + to_minutes(CAST(event_id % 20 AS BIGINT)) AS ing FROM events), m AS (SELECT max(ing) z FROM e) SELECT event_type, epoch_us(any_value(z)) - epoch_us(max(ts)) AS lag_us, epoch_us(any_value(z)) - epoch_us(max(ing)) AS ingest_lag_us, epoch_us(max(ing)) - epoch_us(max(ts)) AS watermark_lag_us, max(epoch_us(ing) - epoch_us(ts)) AS longest_us FROM e, m GROUP BY 1")
def c11_freshness_lag(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("ing", F.col("ts") + F.make_interval(mins=F.col("event_id") % 20))
    return quality.lags(e, ["event_type"], "ts", "ing", F.lit(e.agg(F.max("ing")).first()[0]))
