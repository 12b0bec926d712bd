"""Supply and request operators: offers, prices and snapshots of providers, mergeable metrics, links and profiles.

Offers have provider, pipeline, model, gpu, capacity, price, seen, and order columns that make ties definite.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import asof, changes

ORDER = ["seen", "l_orderkey", "l_linenumber", "price"]


def listed(c: str | Column) -> Column:
    """Distinct values in order, joined by commas; lists of names stay short however many rows a group has."""
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def newest(value: str, order: list[str] = ORDER) -> Column:
    """The value at the highest order: a partial maximum in the map tasks."""
    return F.max(F.struct(*order, F.col(value).alias("_value")))["_value"]


def metrics(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Additive sums and a mergeable quantile sketch of each key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col(value) * F.col(weight)).alias("weighted_sum"), F.sum(weight).alias("weight_sum"), F.expr(f"kll_sketch_agg_double({value})").alias("sketch"))


def merge_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``metrics`` at a coarser grain: averages from sums, quantiles from merged sketches."""
    out = rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("n", "weighted_sum", "weight_sum")), F.expr("kll_merge_agg_double(sketch)").alias("_s"))
    quantile = lambda q: F.expr(f"kll_sketch_get_quantile_double(_s, {q}D)")
    return out.withColumns({"average": expr.ratio(F.col("weighted_sum"), F.col("weight_sum")), "p50": quantile(0.5), "p95": quantile(0.95)}).drop("_s")


def provider_snapshot(offers: DataFrame) -> DataFrame:
    return offers.groupBy("provider").agg(
        F.count_distinct("gpu").alias("gpus"), listed("pipeline").alias("pipelines"), F.count_distinct("pipeline", "model").alias("pairs"),
        expr.ratio(F.sum(F.col("price") * F.col("capacity")), F.sum("capacity")).alias("weighted_price"), newest("price").alias("latest_price"),
    )


def gpu_inventory(offers: DataFrame) -> DataFrame:
    keys = ["provider", "gpu"]
    return offers.groupBy(*keys).agg(newest("pipeline").alias("pipeline"), newest("model").alias("model"), newest("price").alias("price"), F.max("seen").alias("last_seen"))


def prices(offers: DataFrame, keys: list[str], warm_at: float) -> DataFrame:
    """Newest positive price of each offer, and whether any of its rows was warm."""
    return offers.where("price > 0").groupBy(*keys).agg(newest("price").alias("price"), F.max(F.col("capacity") >= warm_at).alias("warm"))


def spine(offers: DataFrame, workers: DataFrame, identity: DataFrame) -> DataFrame:
    """Offers and the workers that none of them covers, with newest prices and names of providers."""
    keys = ["provider", "pipeline"]
    own = offers.groupBy(*keys).agg(F.count("*").alias("n_rows"), newest("price").alias("price")).withColumn("origin", F.lit("offer"))
    more = workers.groupBy(*keys).agg(F.count("*").alias("n_rows")).join(own.select(*keys), keys, "left_anti").withColumns({"price": F.lit(None).cast("double"), "origin": F.lit("worker")})
    return own.unionByName(more).join(identity, "provider", "left")


def capacity(offers: DataFrame, active: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct GPUs, those in use by active streams, and those left (never below 0)."""
    total = offers.groupBy(*keys).agg(F.count_distinct("gpu").alias("gpus"))
    used = active.groupBy(*keys).agg(F.count_distinct("stream").alias("in_use"))
    return total.join(used, keys, "left").fillna({"in_use": 0}).withColumn("available", F.greatest(F.col("gpus") - F.col("in_use"), F.lit(0).cast("long")))


def payment_links(payments: DataFrame, sessions: DataFrame, key: str) -> DataFrame:
    """Payments with the session of their request (of several the smallest, so that a payment stays one row); blank requests link with nothing and keep out of the join's hot key."""
    s = sessions.where(F.col(key) != "").groupBy(F.col(key).alias("_key")).agg(F.min("session_id").alias("session_id"))
    joined = payments.join(s, (F.col(key) == F.col("_key")) & (F.col(key) != ""), "left").drop("_key")
    return joined.withColumn("link_status", F.when(F.col(key) == "", "no_request").when(F.col("session_id").isNull(), "unlinked").otherwise("linked"))


def worker_model(jobs: DataFrame, workers: DataFrame, exact: list[str], fallback: list[str], stamp: str, value: str) -> DataFrame:
    """The newest worker value at or before each job: of the exact keys, else of the fallback keys."""
    right = workers.withColumnRenamed(stamp, "_wt")
    got = asof.latest_before(jobs, right, exact, stamp, "_wt", value).withColumnRenamed(f"asof_{value}", "_exact")
    got = asof.latest_before(got, right, fallback, stamp, "_wt", value)
    return got.withColumn(f"worker_{value}", F.coalesce("_exact", f"asof_{value}")).drop("_exact", f"asof_{value}")


def changed_rows(new: DataFrame, old: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """New rows that the old table lacks or has with other fields; nulls and empty texts differ."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("null")) for f in fields)))
    before = old.select(*keys, digest.alias("_old"))
    return new.withColumn("_new", digest).join(before, keys, "left").where(~F.col("_new").eqNullSafe(F.col("_old"))).drop("_new", "_old")


def stream_profile(rows: DataFrame, payments: DataFrame, metrics: DataFrame) -> DataFrame:
    """A row for each stream (stream_id, request_id) of sessions' rows, payments and ingest metrics, nulls and blanks as ''.

    Providers and states are listed in the order of their runs, repeated where one comes back; swaps are changes of the
    provider. Besides: mean frame rate, greatest restart count, latest error, lost video packets, payments, first trace,
    last row, duration, and whether the stream failed or is active (was never seen offline).
    """
    keys = ["stream_id", "request_id"]
    named = lambda d: d.withColumns({k: F.coalesce(k, F.lit("")) for k in keys})
    trace, status = F.col("family") == "stream_trace", F.col("family") == "ai_stream_status"
    told = named(rows).withColumn("state", F.when(status, F.col("state")))  # only statuses tell a stream's state
    own = changes.run_starts(told, keys, "event_ts", "event_id", ["orch_address", "state"])
    listed_runs = lambda v: F.transform(F.array_sort(F.collect_list(F.when(F.col(f"{v}_starts"), F.struct("event_ts", "event_id", v)))), lambda x: x[v])
    fps = F.when(status, F.col("output_fps").cast("decimal(18,6)"))
    out = own.groupBy(*keys).agg(
        F.min(F.when(trace, F.col("event_ts"))).alias("first_ts"), F.max("event_ts").alias("last_row"), F.count_if(status).alias("fps_samples"), F.sum(fps).cast("double").alias("_fps"), F.coalesce(F.max(F.when(status, F.col("restart_count"))), F.lit(0)).alias("restart_count"),
        F.max(F.when(status & (F.col("last_error") != ""), F.struct("event_ts", "event_id", "last_error")))["last_error"].alias("last_error"), listed_runs("orch_address").alias("providers"), listed_runs("state").alias("states"),
    )
    lost = named(metrics).groupBy(*keys).agg(F.coalesce(F.sum("video_packets_lost"), F.lit(0)).alias("video_packets_lost"), F.max("event_ts").alias("last_metric"))
    paid = named(payments).groupBy(*keys).agg(F.count("*").alias("payments"), F.sum("face_value_wei").alias("paid_wei"))
    for part in (lost, paid):
        out = out.join(part, keys, "full")
    empty = F.array().cast("array<string>")
    out = out.withColumns({"providers": F.coalesce("providers", empty), "states": F.coalesce("states", empty), "last_ts": F.greatest("last_row", "last_metric"), "avg_fps": expr.ratio(F.col("_fps"), F.col("fps_samples"))})
    out = out.fillna(0, ["fps_samples", "restart_count", "video_packets_lost", "payments"])
    return out.select(
        *keys, "providers", F.greatest(F.size("providers") - 1, F.lit(0)).alias("swaps"), "states", "fps_samples", "avg_fps", "restart_count", "last_error", "video_packets_lost", "payments", F.coalesce("paid_wei", F.lit(0).cast("decimal(20,0)")).alias("paid_wei"), "first_ts", "last_ts",
        ((F.unix_millis("last_ts") - F.unix_millis("first_ts")) / 1000.0).alias("duration_s"), ((F.col("restart_count") > 0) | F.col("last_error").isNotNull()).alias("had_failure"), (~F.array_contains("states", "OFFLINE")).alias("is_active"),
    )


def window_delta(df: DataFrame, stamp: str, now: Column, hours: int) -> DataFrame:
    """One row: counts of the window up to ``now`` and of the one before it, with the change in percent."""
    start, before = now - F.make_interval(hours=F.lit(hours)), now - F.make_interval(hours=F.lit(2 * hours))
    at = F.col(stamp)
    rows = df.where((at > before) & (at <= now))
    out = rows.agg(F.count_if(at > start).alias("current_n"), F.count_if(at <= start).alias("previous_n"), F.count_distinct(F.when(at > start, F.col("user_id"))).alias("active"))
    return out.withColumn("change_pct", F.round(100.0 * expr.ratio(F.col("current_n") - F.col("previous_n"), F.col("previous_n")), 4))


def models_in_use(gpus: DataFrame, active: DataFrame) -> DataFrame:
    """GPUs of each pipeline and model, with active streams and their mean frame rate."""
    keys = ["pipeline", "model"]
    own = gpus.groupBy(*keys).agg(F.count_distinct(F.concat("gpu_id", "orch_address")).alias("gpus"))
    fps = expr.ratio(F.sum(F.col("fps").cast("decimal(18,2)")), F.count("*"))
    used = active.groupBy(*keys).agg(F.count_distinct("stream").alias("active_streams"), F.round(fps, 4).alias("avg_fps"))
    return own.join(used, keys, "left").fillna({"active_streams": 0})


def provider_profile(snapshots: DataFrame, discovery: DataFrame, sessions: DataFrame, payments: DataFrame) -> DataFrame:
    """Snapshots, GPUs, models, top price, discovery latency, streams handled and payments of each provider that any source names.

    A snapshot's parts are told apart by kind and counted in one pass; the other sources (sessions: orch_address,
    session_key; payments: orch_address, amount) are summed before they are joined. Blank providers are left out.
    """
    key = "orch_address"
    part = lambda kind, name, price: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), price.cast("double").alias("price"))
    parts = F.concat(
        F.array(part("snapshot", F.col("row_id"), F.lit(None))), F.coalesce(F.transform(F.flatten(F.transform("hardware", lambda h: h.gpus)), lambda g: part("gpu", g.id, F.lit(None))), F.array()),
        F.coalesce(F.transform("prices", lambda p: part("model", p.constraint, p.pricePerUnit)), F.array()),
    )
    each = snapshots.select(key, F.explode(parts).alias("p")).groupBy(key, "p.kind", "p.name").agg(F.count("*").alias("n"), F.max("p.price").alias("price"))
    kinds = lambda k: F.count_if(F.col("kind") == k)
    out = each.groupBy(key).agg(F.coalesce(F.sum(F.when(F.col("kind") == "snapshot", F.col("n"))), F.lit(0)).alias("n_snapshots"), kinds("gpu").alias("gpus"), kinds("model").alias("models"), F.max("price").cast("long").alias("top_price"))
    out = out.join(discovery.groupBy(key).agg(F.max("latency_ms").alias("latency_ms")), key, "full")
    out = out.join(sessions.groupBy(key, "session_key").agg(F.count("*").alias("n")).groupBy(key).agg(F.count("*").alias("streams"), F.sum("n").alias("stream_rows")), key, "full")
    out = out.join(payments.groupBy(key).agg(F.count("*").alias("payments"), F.sum(F.col("amount").cast("decimal(20,4)")).cast("double").alias("paid")), key, "full")
    return out.where(f"{key} <> ''").fillna(0, ["n_snapshots", "gpus", "models", "streams", "stream_rows", "payments"])


def lists(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The distinct non-blank values of some columns, one row for each list; lists of names stay short."""
    pairs = F.array(*(F.struct(F.lit(name).alias("list"), F.col(c).alias("value")) for name, c in columns.items()))
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where("value <> ''").distinct()
    return values.groupBy("list").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("names"))
