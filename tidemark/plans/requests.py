"""Registered queries of the request families, on envelopes derived from ``orders``; filters, pages, summaries and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import evidence, filters, pages, quality, supply
from tidemark.plans.catalog import orders, query, table
from tidemark.sources import envelopes, runs

_ORG = {"network_events": "north"}
_O = """WITH q AS (SELECT *, o_orderkey % 8 k, o_orderkey // 8 t, (o_orderkey // 8) % 2 = 1 AS done, 'o' || o_orderkey AS event_id, '0x' || lpad(lower(to_hex(o_custkey % 23)), 40, '0') AS addr, 'https://o' || (o_custkey % 23) AS url, 'r' || (o_orderkey // 16) AS request_id, 's' || o_custkey AS stream, 'cap' || (o_custkey % 4) AS capability, o_custkey * 10 + (o_orderkey // 8) % 100 AS dur, (o_orderkey // 8) % 5 <> 0 AS ok, epoch_ms(o_orderdate) AS ms, 'm' || (o_custkey % 5) AS model, 'http://w' || (o_custkey % 11) AS worker_url, CAST(o_custkey % 7 + 1 AS DOUBLE) AS price FROM orders)"""


def raw(spark, sf_dir: str) -> DataFrame:
    return envelopes.route(envelopes.with_raw_columns(envelopes.from_orders(orders(spark, sf_dir)), _ORG))[0]


def ms(c: str):
    return F.unix_millis(c)


# Typed families --------------------------------------------------------------------------------------------------------


@query(f"{_O} SELECT event_id, 'north|' || stream || '|' || request_id AS session_key, CASE WHEN done THEN 'error' ELSE 'params_update' END AS event_name, o_orderstatus AS message, addr AS orch_address FROM q WHERE k = 0")
def p3_stream_events(spark, sf_dir):
    return envelopes.stream_events(raw(spark, sf_dir)).select("event_id", "session_key", "event_name", "message", "orch_address")


@query(f"{_O} SELECT event_id, request_id, model, o_custkey % 100 AS prompt_tokens, t % 50 AS completion_tokens, o_custkey % 100 + t % 50 AS total_tokens FROM q WHERE k = 2 AND done")
def p5_llm_requests(spark, sf_dir):
    return envelopes.llm_requests(raw(spark, sf_dir)).select("event_id", "request_id", "model", "prompt_tokens", "completion_tokens", "total_tokens")


@query(f"{_O} SELECT event_id, CASE WHEN k = 3 THEN 'job_gateway' ELSE 'job_orchestrator' END AS source_event_type, request_id, capability, CASE WHEN done THEN ok END AS success, dur AS duration_ms, CASE WHEN ok THEN 200 ELSE 500 END AS http_status, addr AS orch_address FROM q WHERE k IN (3, 4)")
def p6_byoc_jobs(spark, sf_dir):
    return envelopes.byoc_jobs(raw(spark, sf_dir)).select("event_id", "source_event_type", "request_id", "capability", "success", "duration_ms", "http_status", "orch_address")


@query(f"{_O} SELECT event_id, request_id, capability, addr AS orch_address, ok AS success, CASE WHEN ok THEN '' ELSE 'refused' END AS error FROM q WHERE k = 5")
def p7_byoc_auth(spark, sf_dir):
    return envelopes.byoc_auth(raw(spark, sf_dir)).select("event_id", "request_id", "capability", "orch_address", "success", "error")


@query(f"{_O} SELECT event_id, capability, addr AS orch_address, worker_url, price AS price_per_unit, model FROM q WHERE k = 6")
def p8_workers(spark, sf_dir):
    return envelopes.workers(raw(spark, sf_dir)).select("event_id", "capability", "orch_address", "worker_url", "price_per_unit", "model")


@query(f"{_O} SELECT event_id, 'payment_created' AS payment_type, capability, CAST(o_custkey % 50 AS DOUBLE) AS amount, 'USD' AS currency FROM q WHERE k = 7")
def p9_byoc_payments(spark, sf_dir):
    return envelopes.byoc_payments(raw(spark, sf_dir)).select("event_id", "payment_type", "capability", "amount", "currency")


@query(f"{_O} SELECT event_id, stream AS stream_id, CASE WHEN o_custkey % 2 = 0 THEN 'good' ELSE 'bad' END AS conn_quality, CAST(o_custkey % 9 AS DOUBLE) AS video_jitter, o_custkey % 5 AS video_packets_lost, o_custkey % 3 AS audio_packets_lost, o_custkey * 3 AS audio_packets_received FROM q WHERE k = 1")
def p11_ingest_metrics(spark, sf_dir):
    return envelopes.ingest_metrics(raw(spark, sf_dir)).select("event_id", "stream_id", "conn_quality", "video_jitter", "video_packets_lost", "audio_packets_lost", "audio_packets_received")


@query(f"{_O} SELECT event_id, CASE WHEN k = 3 THEN ms + 3600000 ELSE ms END AS ms FROM q WHERE k <> 4")
def p12_final_rows(spark, sf_dir):
    """Rows of one family arrive again an hour later; those of another have blank ids."""
    rows = raw(spark, sf_dir).withColumn("event_id", F.when(F.col("event_type") != "job_orchestrator", F.col("event_id")).otherwise(" "))
    again = rows.where("event_type = 'job_gateway'").withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 1 HOUR"))
    return envelopes.final_rows(rows.unionByName(again)).select("event_id", ms("event_ts").alias("ms"))


@query(f"{_O} SELECT event_id, 'byoc' AS family, capability, dur AS duration_ms FROM q WHERE k IN (3, 4) UNION ALL SELECT event_id, 'builtin', model, dur FROM q WHERE k = 2 AND done")
def p14_fact_views(spark, sf_dir):
    good = raw(spark, sf_dir)
    views = pages.fact_view(envelopes.byoc_jobs(good), "byoc", {}), pages.fact_view(envelopes.llm_requests(good), "builtin", {"capability": "model"})
    return reduce(DataFrame.unionByName, (v.select("event_id", "family", "capability", "duration_ms") for v in views))


@query(f"{_O} SELECT addr AS provider, capability, worker_url AS endpoint, price AS price FROM q WHERE k = 6")
def p15_observed_workers(spark, sf_dir):
    return pages.observed(envelopes.workers(raw(spark, sf_dir)), {"orch_address": "provider", "capability": "capability", "worker_url": "endpoint", "price_per_unit": "price"})


@query(f"{_O} SELECT event_id, request_id, capability FROM q WHERE k IN (5, 7)")
def p16_passthrough(spark, sf_dir):
    good, columns = raw(spark, sf_dir), ["event_id", "request_id", "capability"]
    kept = [filters.nonblank(f(good), "event_id", "capability").select(columns) for f in (envelopes.byoc_auth, envelopes.byoc_payments)]
    return kept[0].unionByName(kept[1])


# Filters ---------------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey FROM customer WHERE c_mktsegment NOT LIKE 'MACH%' AND c_mktsegment NOT LIKE 'AUTO%'")
def f1_org_filter(spark, sf_dir):
    return filters.org_filter(table(spark, sf_dir, "customer"), None, ("MACH", "AUTO"), "c_mktsegment").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'")
def f3_half_open(spark, sf_dir):
    at = lambda d: F.lit(d).cast("timestamp")
    return filters.half_open(orders(spark, sf_dir), "o_orderdate", at("1996-01-01"), at("1996-02-01")).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def f4_optional_equality(spark, sf_dir):
    return filters.equal_to(orders(spark, sf_dir), o_orderstatus="F", o_orderpriority="", o_custkey=None).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def f5_multiselect(spark, sf_dir):
    rows = filters.one_of(filters.one_of(orders(spark, sf_dir), "o_orderpriority", "1-URGENT, 2-HIGH"), "o_orderstatus", "")
    return rows.select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1999-06-01', 500)")
def f6_watermark(spark, sf_dir):
    return filters.after_watermark(orders(spark, sf_dir), "o_orderdate", "o_orderkey", F.lit("1999-06-01").cast("timestamp"), F.lit(500)).select("o_orderkey")


@query(f"{_O} SELECT event_id FROM q WHERE k = 1 AND o_custkey % 4 <> 0")
def f9_nonblank_stream(spark, sf_dir):
    rows = envelopes.ingest_metrics(raw(spark, sf_dir)).withColumn("stream_id", F.when(F.substring("stream_id", 2, 20).cast("long") % 4 == 0, " ").otherwise(F.col("stream_id")))
    return filters.nonblank(rows, "stream_id").select("event_id")


@query("SELECT p_partkey FROM part WHERE p_name ILIKE '%RING%' OR p_name ILIKE 'red%'")
def f12_like_any(spark, sf_dir):
    return table(spark, sf_dir, "part").where(filters.like_any("p_name", ["%RING%", "red%"])).select("p_partkey")


@query("SELECT epoch_us(h) AS hour_us, count(*) AS n FROM (SELECT date_trunc('hour', ts) h FROM events) WHERE h < date_trunc('hour', (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE) GROUP BY 1")
def f13_settled_hours(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    now = F.lit(e.agg(F.max("ts")).first()[0])
    hours = e.groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count("*").alias("n"))
    return filters.settled_hours(hours, "h", now).select(F.unix_micros("h").alias("hour_us"), "n")


@query("SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 90 MINUTE")
def f14_fresh(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return filters.fresh(e, "ts", F.lit(e.agg(F.max("ts")).first()[0]), 90).select("event_id")


@query("SELECT p_partkey, p_name ILIKE '%error%' OR p_name ILIKE '%widget%' AS hit FROM part")
def f11_contains(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", expr.contains_any(F.col("p_name"), ["error", "widget"]).alias("hit"))


# Facts, pages, summaries -----------------------------------------------------------------------------------------------

_JOBS = f"""{_O}, j AS (SELECT * FROM q WHERE k IN (3, 4)), f AS (SELECT request_id, max_by(event_id, (done, ms, event_id)) AS last_id, max_by(capability, (done, ms, event_id)) AS capability, max_by(CASE WHEN done THEN ok END, (done, ms, event_id)) AS ok_last, max_by(dur, (done, ms, event_id)) AS dur, max_by(addr, (done, ms, event_id)) AS addr, max(ms) FILTER (WHERE done) AS done_ms FROM j GROUP BY 1)"""


@query(f"""{_O}, w AS (SELECT capability, addr, ms, max(model) AS model FROM q WHERE k = 6 GROUP BY 1, 2, 3), j AS (SELECT * FROM q WHERE k = 3 AND done)
SELECT j.event_id, j.capability, coalesce((SELECT max_by(w.model, w.ms) FROM w WHERE w.capability = j.capability AND w.addr = j.addr AND w.ms <= j.ms), (SELECT max_by(v.model, v.ms) FROM (SELECT capability, ms, max(model) AS model FROM w GROUP BY 1, 2) v WHERE v.capability = j.capability AND v.ms <= j.ms), '') AS model, j.ok AS success FROM j""")
def d11_byoc_facts(spark, sf_dir):
    good = raw(spark, sf_dir)
    jobs = envelopes.byoc_jobs(good).where("source_event_type = 'job_gateway' and event_subtype = 'job_gateway_completed'")
    got = supply.worker_model(jobs, envelopes.workers(good).select("capability", "orch_address", "event_ts", "model"), ["capability", "orch_address"], ["capability"], "event_ts", "model")
    return got.select("event_id", "capability", F.coalesce("worker_model", F.lit("")).alias("model"), "success")


@query(f"{_O} SELECT epoch_ms(date_trunc('hour', o_orderdate)) AS hour_ms, model, count(*) AS job_count, CAST(sum(dur) AS BIGINT) AS duration_ms_sum, CAST(sum(o_custkey % 100 + t % 50) AS BIGINT) AS tokens_sum FROM q WHERE k = 2 AND done GROUP BY 1, 2")
def a17_llm_demand_hourly(spark, sf_dir):
    rows = envelopes.llm_requests(raw(spark, sf_dir))
    out = rows.groupBy(F.date_trunc("hour", "event_ts").alias("h"), "model").agg(F.count("*").alias("job_count"), F.sum("duration_ms").alias("duration_ms_sum"), F.sum("total_tokens").alias("tokens_sum"))
    return out.withColumn("hour_ms", ms("h")).drop("h")


@query(f"{_O} SELECT epoch_ms(date_trunc('hour', o_orderdate)) AS hour_ms, capability, count(*) AS n, count(*) FILTER (WHERE ok) AS ok_count FROM q WHERE k = 5 GROUP BY 1, 2")
def a18_byoc_auth_hourly(spark, sf_dir):
    return _auth_hourly(spark, sf_dir).select(ms("window_start").alias("hour_ms"), "capability", F.col("auth_count").alias("n"), F.col("success_count").alias("ok_count"))


def _auth_hourly(spark, sf_dir) -> DataFrame:
    return pages.auth_hourly(envelopes.byoc_auth(raw(spark, sf_dir)))


@query(f"{_O} SELECT epoch_ms(date_trunc('hour', o_orderdate)) AS hour_ms, capability, 'USD' AS currency, count(*) AS n, CAST(sum(o_custkey % 50) AS DOUBLE) AS amount FROM q WHERE k = 7 GROUP BY 1, 2")
def a19_byoc_payments_hourly(spark, sf_dir):
    return pages.payments_hourly(envelopes.byoc_payments(raw(spark, sf_dir))).select(ms("window_start").alias("hour_ms"), "capability", "currency", F.col("payment_count").alias("n"), F.col("amount_sum").alias("amount"))


def _jobs(spark, sf_dir) -> DataFrame:
    from tidemark.operators import sessions

    return sessions.job_facts(envelopes.byoc_jobs(raw(spark, sf_dir)))


@query(f"{_JOBS} SELECT capability, count(*) AS jobs, count(*) FILTER (WHERE ok_last) AS succeeded, round(count(*) FILTER (WHERE ok_last) / count(*), 6) AS success_rate, round(sum(dur) / count(*), 4) AS avg_duration_ms FROM f GROUP BY 1")
def q10_jobs_by_capability(spark, sf_dir):
    return pages.job_summary(_jobs(spark, sf_dir), ["capability"])


_LLM = f"{_O}, l AS (SELECT * FROM q WHERE k = 2 AND done)"


@query(f"{_O} SELECT model, count(*) AS workers, round(avg(price), 4) AS avg_price, coalesce(max(d.jobs), 0) AS jobs FROM (SELECT DISTINCT model, worker_url, addr, price FROM q WHERE k = 6) w LEFT JOIN (SELECT model AS dm, count(*) AS jobs FROM q WHERE k = 2 AND done GROUP BY 1) d ON d.dm = w.model GROUP BY 1")
def q16_requests_models(spark, sf_dir):
    good = raw(spark, sf_dir)
    offered = envelopes.workers(good).select("model", "worker_url", "orch_address", "price_per_unit").distinct()
    return pages.models_with_demand(offered, envelopes.llm_requests(good), "model").select("model", "workers", "avg_price", "jobs")


@query(f"{_JOBS} SELECT count(*) AS jobs, count(*) FILTER (WHERE ok_last) AS succeeded, round(count(*) FILTER (WHERE ok_last) / count(*), 6) AS success_rate, round(sum(dur) / count(*), 4) AS avg_duration_ms FROM f")
def q20_byoc_summary(spark, sf_dir):
    return pages.job_summary(_jobs(spark, sf_dir), [])


@query(f"{_LLM} SELECT model, count(*) AS requests, CAST(sum(o_custkey % 100 + t % 50) AS BIGINT) AS tokens, round(sum(dur) / count(*), 4) AS avg_duration_ms, round(sum((o_custkey % 100) / 2.0) / count(*), 4) AS avg_tokens_per_second, round(sum(o_custkey % 300) / count(*), 4) AS avg_ttft_ms FROM l GROUP BY 1")
def q19_llm_summary(spark, sf_dir):
    return pages.llm_summary(envelopes.llm_requests(raw(spark, sf_dir)), ["model"])


@query(f"{_JOBS} SELECT request_id, last_id AS event_id, capability, dur AS duration_ms, done_ms AS ms FROM f WHERE done_ms IS NOT NULL AND (done_ms, last_id) < (epoch_ms(TIMESTAMP '2000-01-01'), 'o9') ORDER BY done_ms DESC, last_id DESC LIMIT 25")
def q22_byoc_jobs_page(spark, sf_dir):
    done = _jobs(spark, sf_dir).where("event_subtype like '%_completed'")
    return pages.page_before(done, "event_ts", "event_id", F.lit("2000-01-01").cast("timestamp"), F.lit("o9"), 25).select("request_id", "event_id", "capability", "duration_ms", ms("event_ts").alias("ms"))


@query(f"{_O} SELECT capability, count(DISTINCT worker_url) AS workers, string_agg(DISTINCT model, ',' ORDER BY model) AS models, round(sum(price) / count(*), 4) AS avg_price FROM q WHERE k = 6 GROUP BY 1")
def q23_byoc_workers(spark, sf_dir):
    return pages.worker_summary(envelopes.workers(raw(spark, sf_dir)), ["capability"])


@query(f"{_O} SELECT capability, count(*) AS total, count(*) FILTER (WHERE ok) AS succeeded, round(count(*) FILTER (WHERE ok) / count(*), 6) AS success_rate FROM q WHERE k = 5 GROUP BY 1")
def q24_byoc_auth(spark, sf_dir):
    return pages.auth_summary(_auth_hourly(spark, sf_dir), ["capability"])


@query(f"{_O} SELECT capability, count(*) AS payments, CAST(sum(o_custkey % 50) AS DOUBLE) AS amount, count(DISTINCT addr) AS recipients FROM q WHERE k = 7 GROUP BY 1")
def q32_payments_by_capability(spark, sf_dir):
    p = envelopes.byoc_payments(raw(spark, sf_dir))
    return p.groupBy("capability").agg(F.count("*").alias("payments"), F.sum("amount").alias("amount"), F.count_distinct("orch_address").alias("recipients"))


@query(f"{_O} SELECT CASE WHEN k IN (3, 4) THEN 'byoc_job' WHEN k = 5 THEN 'auth' WHEN k = 6 THEN 'worker' WHEN k = 2 THEN 'llm' END AS kind, CASE WHEN k = 2 THEN model ELSE capability END AS name, count(*) AS n, round(100.0 * count(*) FILTER (WHERE k IN (2, 3, 4, 5) AND (done OR k = 5) AND ok) / nullif(count(*) FILTER (WHERE k IN (2, 3, 4, 5) AND (done OR k = 5)), 0), 4) AS success_pct, round(avg(dur) FILTER (WHERE k IN (2, 3, 4)), 4) AS avg_duration_ms FROM q WHERE k IN (3, 4, 5, 6) OR (k = 2 AND done) GROUP BY 1, 2")
def i6_request_job_profile(spark, sf_dir):
    good = raw(spark, sf_dir)
    llm = envelopes.llm_requests(good).withColumn("success", F.col("error") == "")
    families = {"byoc_job": envelopes.byoc_jobs(good), "auth": envelopes.byoc_auth(good), "worker": envelopes.workers(good), "llm": llm}
    return pages.request_profile(families)


# Checks ----------------------------------------------------------------------------------------------------------------


@query(f"{_O}, h AS (SELECT date_trunc('hour', o_orderdate) h, capability, count(*) n, count(*) FILTER (WHERE ok) s FROM q WHERE k = 5 GROUP BY 1, 2) SELECT count(*) FILTER (WHERE n IS NULL) AS auth_count_null, count(*) FILTER (WHERE s IS NULL) AS success_count_null, count(*) AS n_rows FROM h")
def c3_additive_primitives(spark, sf_dir):
    return quality.null_counts(_auth_hourly(spark, sf_dir), ["auth_count", "success_count"])


@query(f"{_O} SELECT capability, count(*) AS auth_count_left, CASE WHEN capability = 'cap1' THEN NULL ELSE count(*) END AS auth_count_right FROM q WHERE k = 5 AND capability = 'cap1' GROUP BY 1")
def c4_rollup_matches_facts(spark, sf_dir):
    """Facts against a rollup from which one capability is missing: that one alone is reported."""
    facts = envelopes.byoc_auth(raw(spark, sf_dir)).groupBy("capability").agg(F.count("*").alias("auth_count"))
    rolled = _auth_hourly(spark, sf_dir).where("capability <> 'cap1'").groupBy("capability").agg(F.sum("auth_count").alias("auth_count"))
    return quality.reconcile(facts, rolled, ["capability"], ["auth_count"])


@query(f"{_O} SELECT event_id FROM q WHERE k = 6 AND o_custkey % 6 = 0 AND o_custkey % 23 < 20")
def c5_missing_uri(spark, sf_dir):
    """Workers of known providers whose endpoint is blank."""
    w = envelopes.workers(raw(spark, sf_dir))
    w = w.withColumn("worker_url", F.when(F.col("price_per_unit").isNotNull() & (F.conv(F.substring("orch_address", 3, 40), 16, 10).cast("int") < 23), F.col("worker_url")))
    known = w.select("orch_address").distinct().where(F.conv(F.substring("orch_address", 3, 40), 16, 10).cast("int") < 20)
    blanked = orders(spark, sf_dir).where("o_custkey % 6 = 0").select(F.concat(F.lit("o"), "o_orderkey").alias("event_id"), F.lit(1).alias("_b"))
    rows = w.join(blanked, "event_id", "left").withColumn("worker_url", F.when(F.col("_b").isNull(), F.col("worker_url")).otherwise(""))
    return quality.missing_for_known(rows, known, "orch_address", "worker_url").select("event_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_extendedprice > 10000)")
def c6_positive_pricing(spark, sf_dir):
    return quality.not_above(table(spark, sf_dir, "lineitem"), "l_extendedprice", 10000).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"{_O} SELECT capability, count(*) AS n_rows, count(*) FILTER (WHERE NOT ok) AS hits, count(*) FILTER (WHERE NOT ok) / count(*) AS rate, count(*) FILTER (WHERE NOT ok) / count(*) > 0.19 AS alert FROM q WHERE k = 5 GROUP BY 1 HAVING count(*) >= 20")
def c9_unserved_demand(spark, sf_dir):
    rows = quality.guarded_rate(envelopes.byoc_auth(raw(spark, sf_dir)), ["capability"], ~F.col("success"), 20)
    return rows.withColumn("alert", F.col("rate") > 0.19)


_RUNS = "WITH r AS (SELECT *, date_trunc('year', o_orderdate) AS y, EXTRACT(year FROM o_orderdate) % 2 = 0 AS again FROM orders)"


@query(f"{_RUNS} SELECT o_orderkey, epoch_us(y) AS year_us, CASE WHEN again THEN 'second' ELSE 'first' END AS refresh_run_id FROM r WHERE NOT again OR o_orderstatus = 'O'")
def s9_append_runs(spark, sf_dir):
    """A run of all years, a second one that replaces every other year by fewer rows, and a third that never commits."""
    o = orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderstatus", F.date_trunc("year", "o_orderdate").alias("y"))
    even, at = F.year("y") % 2 == 0, lambda d: F.lit(f"2030-01-0{d}").cast("timestamp")
    table = runs.scratch(spark, "runs")
    runs.write_run(o, table, "first", at(1), ["y"])
    runs.write_run(o.where(even & (F.col("o_orderstatus") == "O")), table, "second", at(2), ["y"], owned=o.where(even))
    runs.write_rows(o.limit(0), table, "third", at(3), ["y"])
    return runs.read_runs(spark, table, ["y"]).select("o_orderkey", F.unix_micros("y").alias("year_us"), "refresh_run_id")


@query(f"{_RUNS}, m AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_custkey IS NULL) AS a, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS b, count(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 100000) AS c, epoch_us(max(o_orderdate)) AS d FROM r) SELECT 'orders' AS \"table\", x.metric, CAST(x.value AS VARCHAR) AS value FROM (SELECT 'n_rows' AS metric, n_rows AS value FROM m UNION ALL SELECT 'o_custkey_null', a FROM m UNION ALL SELECT 'o_orderstatus_not_accepted', b FROM m UNION ALL SELECT 'o_totalprice_out_of_bounds', c FROM m UNION ALL SELECT 'newest_us', d FROM m) x")
def c14_quality_on_write(spark, sf_dir):
    """Violations that the job counts which writes a run: no scan of its own."""
    o = orders(spark, sf_dir).withColumn("y", F.date_trunc("year", "o_orderdate"))
    contract = quality.Contract(["o_custkey"], {"o_orderstatus": ["F", "O"]}, {"o_totalprice": (1_000, 100_000)}, "o_orderdate")
    seen = runs.write_run(o, runs.scratch(spark, "quality"), "one", F.lit("2030-01-01").cast("timestamp"), ["y"], contract=contract)
    return quality.metric_rows(spark, "orders", {k: v for k, v in seen.items() if k != "checksum"})


@query(f"{_O} SELECT 'north|' || stream || '|' || request_id AS session_key, count(*) AS message_count, max(ms) AS last_ms, 'live-video-to-video' AS pipeline_hint FROM q WHERE k = 0 GROUP BY 1")
def a3_session_events(spark, sf_dir):
    return evidence.event_rollup(envelopes.stream_events(raw(spark, sf_dir))).select("session_key", "message_count", ms("last_seen").alias("last_ms"), "pipeline_hint")
