"""Registered queries of capability snapshots, on envelopes derived from ``lineitem`` and ``part``: fan-outs, inventories, offers, supply panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import filters, offers, pages, supply
from tidemark.plans.catalog import accepted, orders, query, table
from tidemark.sources import envelopes, runs

_ORG = {"network_events": "north"}
# A small catalog of our own: two capabilities of live video, two of requests, and a blank row that cleaning drops.
SEED = [(35, " live video ", "builtin", "live-video-to-video", "model", True, False), (36, "brand one", "builtin", "Brand#1", "model", True, False), (40, "brand two", "builtin", "Brand#2", " ", False, True), (37, "other", "byoc", "", "", False, True), (0, "dropped", "", "", "", False, False)]
_N = """WITH o AS (SELECT l_suppkey AS s, date_trunc('month', l_shipdate) AS m, p_brand, p_type, l_partkey, l_quantity, 'n' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m') AS event_id, '0x' || lpad(lower(to_hex(l_suppkey)), 40, '0') AS addr FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT s, m, event_id, addr, event_id || '#' || addr AS row_id, max(CAST(l_quantity AS BIGINT)) AS q, epoch_ms(m) AS ms FROM o GROUP BY ALL),
g AS (SELECT DISTINCT s, m, event_id || '#' || addr AS row_id, addr, epoch_ms(m) AS ms, p_brand AS pipeline, p_type AS model, 'g' || (l_partkey % 9) AS gpu_id, 'card' || (l_partkey % 3) AS gpu_name, (l_partkey % 9 + 1) * 1024 AS mem FROM o WHERE s % 3 <> 0),
c AS (SELECT s, m, event_id || '#' || addr AS row_id, addr, p_type AS model, count(*) AS capacity, max(CAST(l_quantity AS BIGINT)) AS q FROM o GROUP BY ALL)"""


def raw(spark, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return envelopes.route(envelopes.with_raw_columns(envelopes.from_offers(lines, table(spark, sf_dir, "part")), _ORG))[0]


def snapshots(spark, sf_dir: str, *parts: str) -> DataFrame:
    """Snapshots of providers with these parts of their payloads."""
    return envelopes.capabilities(raw(spark, sf_dir), parts=parts)


def catalog(spark) -> DataFrame:
    return offers.capability_catalog(spark, SEED)


def ms(c: str):
    return F.unix_millis(c)


@query("SELECT row_number() OVER (ORDER BY p_brand) AS capability_id, p_brand AS capability_name, CASE WHEN n % 2 = 0 THEN 'builtin' ELSE 'byoc' END AS capability_family, CASE WHEN n % 3 > 0 THEN lower(p_brand) END AS canonical_pipeline FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)")
def s7_seed_catalog(spark, sf_dir):
    """A seed file, derived from ``part``: untrimmed names, blank pipelines, and rows of ids that aren't positive, which cleaning drops."""
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    name, half = F.concat(F.lit("  "), "p_brand", F.lit(" ")), F.when(F.col("n") % 2 == 0, "builtin").otherwise(" byoc")
    rows = brands.select(F.row_number().over(Window.orderBy("p_brand")).alias("capability_id"), name.alias("capability_name"), half.alias("capability_family"), F.when(F.col("n") % 3 > 0, F.lower("p_brand")).otherwise(" ").alias("canonical_pipeline"), F.lit("model_id").alias("constraint_kind"), F.lit(True).alias("supports_stream"), F.lit(False).alias("supports_request"))
    path = runs.scratch(spark, "seed")
    rows.unionByName(rows.withColumn("capability_id", -F.col("capability_id") + 1)).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return offers.capability_catalog(spark, path).select(F.col("capability_id").cast("long"), "capability_name", "capability_family", "canonical_pipeline")


@query(f"{_N} SELECT addr AS orch_address, max_by('v' || (s % 3), ms) AS version, max(ms) AS ms FROM n GROUP BY 1")
def s8_metadata(spark, sf_dir):
    return offers.latest_metadata(snapshots(spark, sf_dir), "orch_address", ["version", "event_ts"], "event_ts").select("orch_address", "version", ms("event_ts").alias("ms"))


@query(f"{_N} SELECT row_id, ms, 'https://S' || s AS orch_uri, 'v' || (s % 3) AS version FROM n")
def p13_snapshots(spark, sf_dir):
    return filters.nonblank(snapshots(spark, sf_dir), "orch_address").select("row_id", ms("event_ts").alias("ms"), "orch_uri", "version")


@query(f"{_N} SELECT event_id, addr AS orch_address, CASE WHEN s % 4 = 0 THEN '0x' || lpad(lower(to_hex(s + 1000)), 40, '0') ELSE 'alias' END AS alias FROM n")
def g1_capabilities(spark, sf_dir):
    return snapshots(spark, sf_dir).select("event_id", "orch_address", "alias")


@query(f"{_N} SELECT 'd' || (s % 10) || '-' || strftime(m, '%Y%m') AS event_id, CAST(row_number() OVER (PARTITION BY s % 10, m ORDER BY addr) AS INTEGER) AS idx, addr AS orch_address, CAST(s * 1.5 AS DOUBLE) AS latency_ms FROM n")
def g2_discovery(spark, sf_dir):
    return envelopes.discovery(raw(spark, sf_dir)).select("event_id", "idx", "orch_address", "latency_ms")


@query(f"{_N} SELECT row_id, pipeline, model AS model_id, gpu_id, gpu_name, mem AS gpu_memory FROM g")
def g3_gpus(spark, sf_dir):
    return envelopes.gpus(snapshots(spark, sf_dir, "hardware")).select("row_id", "pipeline", "model_id", "gpu_id", "gpu_name", "gpu_memory")


@query(f"{_N} SELECT row_id, 35 AS capability_id, model FROM c WHERE s % 3 = 0")
def g4_offers_of_capabilities(spark, sf_dir):
    return envelopes.offers(snapshots(spark, sf_dir, "hardware", "per_capability")).where("hardware_present = 0").select("row_id", "capability_id", "model")


@query(f"{_N} SELECT DISTINCT row_id, pipeline, model FROM g")
def g5_offers_of_hardware(spark, sf_dir):
    return envelopes.offers(snapshots(spark, sf_dir, "hardware", "per_capability")).where("hardware_present = 1").select("row_id", "pipeline", "model").distinct()


@query(f"{_N} SELECT row_id, model AS constraint_name, CAST(q AS DOUBLE) AS price_per_unit FROM c WHERE q > 0")
def g6_prices(spark, sf_dir):
    return envelopes.prices(snapshots(spark, sf_dir, "prices")).select("row_id", "constraint_name", "price_per_unit")


@query(f"{_N} SELECT row_id, q / 2.0 AS price_per_pixel FROM n WHERE q > 0")
def g7_global_price(spark, sf_dir):
    return envelopes.global_price(snapshots(spark, sf_dir, "price_info")).select("row_id", "price_per_pixel")


@query(f"{_N} SELECT row_id, 'address' AS ident_type, addr AS ident FROM n UNION ALL SELECT row_id, 'uri', 'https://s' || s FROM n UNION ALL SELECT row_id, 'alias', '0x' || lpad(lower(to_hex(s + 1000)), 40, '0') FROM n WHERE s % 4 = 0")
def g8_identity_candidates(spark, sf_dir):
    return offers.identity_candidates(snapshots(spark, sf_dir)).select("row_id", "ident_type", "ident")


@query(f"""{_N}, h AS (SELECT *, '{{"id":"' || gpu_id || '","name":"' || gpu_name || '","memory_total":' || mem || '}}' AS info FROM g) SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY '{{"pipeline":"' || pipeline || '","model_id":"' || model || '","gpu_info":' || CASE WHEN s % 2 = 0 THEN '[' || info || ']' ELSE '{{"0":' || info || '}}' END || '}}') AS INTEGER) AS seq, pipeline, model, gpu_id, gpu_name, mem AS gpu_memory, 1 AS hardware_present FROM h
UNION ALL SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY capacity % 2, capacity DESC, model) AS INTEGER), 'live-video-to-video', model, NULL, NULL, NULL, 0 FROM c WHERE s % 3 = 0""")
def g10_templates(spark, sf_dir):
    return offers.templates(snapshots(spark, sf_dir, "hardware", "per_capability"), catalog(spark))


@query(f"{_N} SELECT 'https://S' || s AS orch_uri, addr AS orch_address, 'v' || (s % 3) AS version, max(ms) AS last_ms FROM n GROUP BY ALL")
def a7_snapshot_latest(spark, sf_dir):
    return offers.snapshot_latest(snapshots(spark, sf_dir)).select("orch_uri", "orch_address", "version", ms("last_seen").alias("last_ms"))


_J5 = f"""{_N}, i AS (SELECT s, addr, gpu_id, min_by(pipeline, (pipeline, model)) FILTER (WHERE last) AS pipeline, min_by(gpu_name, (pipeline, model)) FILTER (WHERE last) AS gpu_name FROM (SELECT *, (ms, row_id) = max((ms, row_id)) OVER (PARTITION BY addr, gpu_id) AS last FROM g) GROUP BY 1, 2, 3)"""


@query(f"{_J5} SELECT addr AS orch_address, gpu_id, pipeline, 'https://S' || s AS orch_uri, CASE pipeline WHEN 'Brand#1' THEN 36 WHEN 'Brand#2' THEN 40 ELSE 37 END AS capability_id, CASE WHEN pipeline IN ('Brand#1', 'Brand#2') THEN 'builtin' ELSE 'byoc' END AS capability_family FROM i")
def j5_hardware_inventory(spark, sf_dir):
    return _inventory(spark, sf_dir).select("orch_address", "gpu_id", "pipeline", "orch_uri", "capability_id", "capability_family")


def _inventory(spark, sf_dir) -> DataFrame:
    return offers.hardware_inventory(snapshots(spark, sf_dir, "hardware"), catalog(spark))


@query(f"""{_N} SELECT DISTINCT row_id, model, CASE pipeline WHEN 'Brand#1' THEN 36 WHEN 'Brand#2' THEN 40 ELSE 37 END AS capability_id, CASE pipeline WHEN 'Brand#1' THEN 'brand one' WHEN 'Brand#2' THEN 'brand two' ELSE pipeline END AS capability_name, pipeline AS pipeline_id, pipeline = 'Brand#1' AS supports_stream FROM g
UNION ALL SELECT row_id, model, 35, 'live video', 'live-video-to-video', TRUE FROM c WHERE s % 3 = 0""")
def d15_offer_classification(spark, sf_dir):
    return offers.classified(envelopes.offers(snapshots(spark, sf_dir, "hardware", "per_capability")), catalog(spark)).select("row_id", "model", "capability_id", "capability_name", "pipeline_id", "supports_stream").distinct()


@query(f"{_J5} SELECT gpu_name, count(*) AS gpus, count(DISTINCT addr) AS providers FROM i GROUP BY 1")
def q30_gpu_by_type(spark, sf_dir):
    return _inventory(spark, sf_dir).groupBy("gpu_name").agg(F.count("*").alias("gpus"), F.count_distinct("orch_address").alias("providers"))


@query(f"{_N}, w AS (SELECT addr, count(DISTINCT pipeline || ':' || model) AS pairs, count(DISTINCT gpu_id) AS gpus, string_agg(DISTINCT pipeline, ',' ORDER BY pipeline) AS pipelines FROM g GROUP BY 1) SELECT addr AS orch_address, pairs, gpus, pipelines FROM w WHERE pairs > 0")
def q12_streaming_orchestrators(spark, sf_dir):
    g = envelopes.gpus(snapshots(spark, sf_dir, "hardware"))
    out = g.groupBy("orch_address").agg(F.count_distinct(F.concat_ws(":", "pipeline", "model_id")).alias("pairs"), F.count_distinct("gpu_id").alias("gpus"), supply.listed("pipeline").alias("pipelines"))
    return out.where("pairs > 0")


@query(f"""{_N}, cap AS (SELECT pipeline, model, count(DISTINCT gpu_id || addr) AS gpus FROM g GROUP BY 1, 2), act AS (SELECT p_brand, p_type, count(DISTINCT l_partkey) AS streams, sum(CAST(l_quantity AS DECIMAL(18, 2))) / count(*) AS fps FROM o WHERE l_quantity > 40 GROUP BY 1, 2)
SELECT pipeline, model, gpus, coalesce(streams, 0) AS active_streams, round(fps, 4) AS avg_fps FROM cap LEFT JOIN act ON p_brand = pipeline AND p_type = model""")
def q11_streaming_models(spark, sf_dir):
    g = envelopes.gpus(snapshots(spark, sf_dir, "hardware"))
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 40").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    active = lines.select(F.col("p_brand").alias("pipeline"), F.col("p_type").alias("model"), F.col("l_partkey").alias("stream"), F.col("l_quantity").alias("fps"))
    return supply.models_in_use(g.withColumnRenamed("model_id", "model"), active)


@query(f"""{_N}, b AS (SELECT addr, max_by('https://S' || s, (q, event_id)) AS uri, max(q) AS best FROM n GROUP BY 1), t AS (SELECT addr, string_agg(DISTINCT model, ',' ORDER BY model) AS models, CAST(sum(capacity) AS DOUBLE) AS request_score, CAST(count(DISTINCT model) AS DOUBLE) AS stream_score FROM c GROUP BY 1)
SELECT addr AS orch_address, uri AS orch_uri, models, CASE WHEN s % 2 = 0 THEN stream_score ELSE request_score END AS score FROM b JOIN t USING (addr) JOIN (SELECT DISTINCT addr, s FROM n) USING (addr) WHERE best >= 49""")
def q25_discover(spark, sf_dir):
    """The best endpoint of each provider, its models, and the score of the work it is asked for, among providers that pass a filter."""
    own = snapshots(spark, sf_dir, "price_info")
    priced = own.where("price_info.pricePerUnit > 0 and price_info.pixelsPerUnit > 0")
    best = priced.groupBy("orch_address").agg(F.max(F.struct(F.col("price_info.pricePerUnit").alias("price_per_unit"), "event_id", "orch_uri")).alias("b")).where("b.price_per_unit >= 49")
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    types = lines.groupBy(F.col("l_suppkey").alias("s"), "p_type").agg(F.count("*").alias("n"))
    able = types.groupBy("s").agg(supply.listed("p_type").alias("models"), F.sum("n").cast("double").alias("request_score"), F.count("p_type").cast("double").alias("stream_score"))
    able = able.withColumn("orch_address", F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("s")), 40, "0")))
    score = F.when(F.col("s") % 2 == 0, offers.routed_score(F.col("stream_score"), F.col("request_score"), "stream")).otherwise(offers.routed_score(F.col("stream_score"), F.col("request_score"), "request"))
    return best.join(able, "orch_address").select("orch_address", F.col("b.orch_uri").alias("orch_uri"), "models", score.alias("score"))


@query(f"{_N} SELECT model, round(sum(q * capacity) / sum(capacity), 4) AS weighted_price, max_by(q, (m, row_id)) AS latest_price FROM c GROUP BY 1")
def q31_latest_pricing(spark, sf_dir):
    prices = envelopes.prices(snapshots(spark, sf_dir, "prices")).withColumnRenamed("constraint_name", "model")
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    # Lines are counted by short keys; names are made of the counts, by a generator, so that no filter on them goes down to the lines.
    counts = lines.groupBy("l_suppkey", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m"), F.col("p_type").alias("model")).agg(F.count("*").alias("capacity"))
    row = F.concat(F.lit("n"), "l_suppkey", F.lit("-"), F.date_format("m", "yyyyMM"), F.lit("#0x"), F.lpad(F.lower(F.hex("l_suppkey")), 40, "0"))
    capacity = counts.select("model", "capacity", F.inline(F.array(F.struct(row.alias("row_id")))))
    both = prices.join(capacity, ["row_id", "model"])
    return both.groupBy("model").agg(F.round(pages.weighted_mean("price_per_unit", "capacity"), 4).alias("weighted_price"), F.max(F.struct("event_ts", "row_id", "price_per_unit"))["price_per_unit"].cast("long").alias("latest_price"))


@query(f"""{_N}, p AS (SELECT addr, count(*) AS n_snapshots, max(q) AS top_price, CAST(max(s) * 1.5 AS DOUBLE) AS latency_ms FROM n GROUP BY 1), pg AS (SELECT addr, count(DISTINCT gpu_id) AS gpus FROM g GROUP BY 1), pm AS (SELECT addr, count(DISTINCT model) AS models FROM c GROUP BY 1),
ev AS (SELECT event_id % 17 AS pv, event_id % 3 = 0 AS named, event_id % 10 AS k, (event_id // 10) % 12 AS t, user_id, ts FROM events), se AS (SELECT '0x' || lpad(lower(to_hex(pv)), 40, '0') AS addr, count(DISTINCT 'north|s' || user_id || '|r' || strftime(ts, '%Y%m%d')) AS streams, count(*) AS stream_rows FROM ev WHERE named AND ((k < 4 AND t < 10) OR k BETWEEN 4 AND 6) GROUP BY 1),
pa AS (SELECT '0x' || lpad(lower(to_hex(o_custkey % 23)), 40, '0') AS addr, count(*) AS payments, CAST(sum(o_custkey % 50) AS DOUBLE) AS paid FROM orders WHERE o_orderkey % 8 = 7 GROUP BY 1), k AS (SELECT addr FROM p UNION SELECT addr FROM se UNION SELECT addr FROM pa)
SELECT addr AS orch_address, coalesce(n_snapshots, 0) AS n_snapshots, coalesce(gpus, 0) AS gpus, coalesce(models, 0) AS models, top_price, latency_ms, coalesce(streams, 0) AS streams, coalesce(stream_rows, 0) AS stream_rows, coalesce(payments, 0) AS payments, paid FROM k LEFT JOIN p USING (addr) LEFT JOIN pg USING (addr) LEFT JOIN pm USING (addr) LEFT JOIN se USING (addr) LEFT JOIN pa USING (addr)""")
def i4_provider_profile(spark, sf_dir):
    """Providers of snapshots, of sessions (derived from ``events``) and of payments (from ``orders``) share their addresses."""
    good = raw(spark, sf_dir)
    streams = envelopes.session_rows(accepted(spark, sf_dir)).select("orch_address", "session_key")
    paid = envelopes.byoc_payments(envelopes.route(envelopes.with_raw_columns(envelopes.from_orders(orders(spark, sf_dir)), _ORG))[0])
    return supply.provider_profile(envelopes.capabilities(good), envelopes.discovery(good), streams, paid)
