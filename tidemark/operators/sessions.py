"""Session rollups and facts, and hourly rollups of additive counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.sources.envelopes import CORE_TRACES


def _first(trace: str):
    return F.min(F.when(F.col("trace_type") == trace, F.col("event_ts")))


def trace_rollup(trace: DataFrame) -> DataFrame:
    """One row for each session: lifecycle times, counts, latest hints; one aggregate, partial in the map tasks."""
    rows = trace.where((F.col("session_key") != "") & F.col("trace_type").isin(CORE_TRACES))
    hint = F.max(F.when(F.col("pipeline_hint") != "", F.struct("event_ts", "event_id", "pipeline_hint")))
    return rows.groupBy("org", "session_key").agg(
        _first("gateway_receive_stream_request").alias("started_at"), _first("gateway_receive_first_processed_segment").alias("first_processed_at"), _first("gateway_receive_few_processed_segments").alias("playable_at"), _first("gateway_ingest_stream_closed").alias("closed_at"),
        F.count_if(F.col("trace_type") == "gateway_no_orchestrators_available").alias("no_provider_count"), F.count_if(F.col("trace_type") == "orchestrator_swap").alias("swap_count"),
        hint["pipeline_hint"].alias("pipeline_hint"), F.max("event_ts").alias("trace_last_seen"),
    )


def status_rollup(status: DataFrame, hourly: bool = False) -> DataFrame:
    keys = ["org", "session_key", *(["hour"] if hourly else [])]
    rows = status.where("session_key <> ''").withColumn("hour", F.date_trunc("hour", "event_ts"))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("status_samples"), F.count_if(F.col("output_fps") > 0).alias("fps_positive_samples"), F.count_if(expr.running(F.col("state"))).alias("running_samples"),
        F.count_if(F.coalesce(F.col("last_error"), F.lit("")) != "").alias("error_samples"), F.count_if(expr.contains_any(F.col("last_error"))).alias("excusable_error_samples"), F.sum("output_fps").alias("output_fps_sum"), F.max("event_ts").alias("status_last_seen"),
    )


def facts_of(evidence: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Outcome, excusal, latencies (null where negative) and flags of each session; ``keep`` names columns of the evidence that stay."""
    requested, playable = F.col("started_at").isNotNull().cast("int"), F.col("playable_at").isNotNull().cast("int")
    outcome = expr.startup_outcome(requested, playable)
    latency = (F.unix_millis("first_processed_at") - F.unix_millis("started_at")).cast("double")
    count = lambda c: F.coalesce(c, F.lit(0))
    zero = (count("status_samples") > 0) & (count("fps_positive_samples") == 0)
    return evidence.select(
        "org", "session_key", "started_at", "last_seen", "closed_at", requested.alias("requested_seen"), playable.alias("playable_seen"), outcome.alias("startup_outcome"),
        expr.startup_excusal(outcome, count("no_provider_count") > 0, count("error_samples"), count("excusable_error_samples")).alias("excusal_reason"), F.when(latency >= 0, latency).alias("startup_latency_ms"),
        count("swap_count").alias("swap_count"), count("status_samples").alias("status_samples"), zero.cast("int").alias("zero_output"), F.coalesce("output_fps_sum", F.lit(0.0)).alias("output_fps_sum"), "pipeline_hint", *keep,
    )


def demand_hourly(facts: DataFrame) -> DataFrame:
    """Sessions counted in their start hour: additive counters, and rates from their sums."""
    hours = facts.where("started_at is not null").groupBy(F.date_trunc("hour", "started_at").alias("window_start"), "org").agg(
        F.count("*").alias("sessions"), F.sum("requested_seen").alias("requested_sessions"), F.count_if(F.col("startup_outcome") == "success").alias("success_sessions"), F.count_if(F.col("excusal_reason") == "no_orch").alias("no_orch_sessions"),
        F.sum(F.greatest(F.unix_millis("last_seen") - F.unix_millis("started_at"), F.lit(0))).alias("session_ms_sum"), F.sum("startup_latency_ms").alias("startup_latency_ms_sum"), F.count("startup_latency_ms").alias("startup_latency_samples"),
        F.sum("zero_output").alias("zero_output_sessions"), F.sum("status_samples").alias("status_samples"), F.sum("output_fps_sum").alias("output_fps_sum"),
    )
    return hours.withColumns({"success_rate": expr.ratio(F.col("success_sessions"), F.col("requested_sessions")), "avg_output_fps": expr.ratio(F.col("output_fps_sum"), F.col("status_samples")), "session_minutes": F.col("session_ms_sum") / F.lit(60000.0), "avg_startup_latency_ms": expr.ratio(F.col("startup_latency_ms_sum"), F.col("startup_latency_samples"))})


def job_facts(jobs: DataFrame) -> DataFrame:
    """The latest completed event of each request, or else the latest received one, with the first receipt: one aggregate, partial in the map tasks."""
    keys, order = ["org", "request_id"], ["_done", "event_ts", "event_id"]
    done = F.col("event_subtype").endswith("_completed")
    rows = jobs.where("org is not null and request_id is not null").withColumn("_done", done)
    rest = [c for c in jobs.columns if c not in {*keys, *order}]
    one = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_m"), F.min(F.when(~F.col("_done"), F.col("event_ts"))).alias("received_at"))
    return one.select(*keys, *(F.col(f"_m.{c}").alias(c) for c in jobs.columns if c not in keys), "received_at")


def request_demand_hourly(facts: DataFrame, keys: list[str]) -> DataFrame:
    out = facts.groupBy(F.date_trunc("hour", "event_ts").alias("window_start"), "org", *keys).agg(F.count("*").alias("job_count"), F.count_if(F.col("success")).alias("success_count"), F.sum("duration_ms").alias("duration_ms_sum"))
    return out.withColumns({"success_rate": expr.ratio(F.col("success_count"), F.col("job_count")), "avg_duration_ms": expr.ratio(F.col("duration_ms_sum"), F.col("job_count"))})


def touched_slices(facts: DataFrame, status_hours: DataFrame) -> DataFrame:
    """(org, hour) that a change of these sessions dirties."""
    hours = facts.select("org", F.explode(F.array_distinct(F.array(F.date_trunc("hour", "started_at"), F.date_trunc("hour", "last_seen")))).alias("hour"))
    return hours.unionByName(status_hours.select("org", "hour")).where("hour is not null").distinct()


def dirty_slices(rows: DataFrame, now: Column, *, lateness_min: int = 10, quiet_min: int = 2) -> DataFrame:
    """Slices that late rows dirty: (org, hour) for rows of the day of ``now``, (org, day) for older ones.

    A row is late if it was ingested more than ``lateness_min`` after it happened; a slice is ready when nothing has come
    for ``quiet_min``.
    """
    late = rows.where(F.col("ingested_at") > F.col("event_ts") + F.make_interval(mins=F.lit(lateness_min)))
    today = F.to_date("event_ts") == F.to_date(now)
    mode = F.when(today, "hour").otherwise("day")
    start = F.when(today, F.date_trunc("hour", "event_ts")).otherwise(F.date_trunc("day", "event_ts"))
    out = late.groupBy("org", mode.alias("mode"), start.alias("slice_start")).agg(F.count("*").alias("late_rows"), F.max("ingested_at").alias("last_ingested"))
    return out.withColumn("ready", F.col("last_ingested") <= now - F.make_interval(mins=F.lit(quiet_min))).drop("last_ingested")


def with_decision(jobs: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Job facts with the latest decision on them; jobs without any are unresolved."""
    own = decisions.select(*keys, "status", "address", F.col("model").alias("decided_model"))
    return jobs.join(own, keys, "left").fillna({"status": "unresolved"})


JOB = ["job_id", "job_type", "org", "gateway", "pipeline", "model", "orchestrator_address", "orchestrator_uri", "gpu_id", "gpu_model_name", "success", "duration_ms", "event_ts", "price_per_unit"]


def all_jobs(streams: DataFrame, ai_batch: DataFrame, byoc: DataFrame) -> DataFrame:
    """Sessions, AI jobs and capability jobs in one shape of fourteen columns; what a kind lacks is blank or 0.

    ``streams`` are facts with gateway, model, address, gpu_id; ``ai_batch`` and ``byoc`` job facts with received_at and
    the model and GPU that a decision or a worker gave them. Jobs without id or pipeline are left out.
    """
    text = lambda d, c: F.coalesce(F.col(c), F.lit("")) if c in d.columns else F.lit("")

    def shaped(d: DataFrame, kind: str, job: str, own: dict[str, Column]) -> DataFrame:
        named = {"job_id": F.col(job), "job_type": F.lit(kind), "org": F.col("org"), "gateway": text(d, "gateway"), "pipeline": text(d, "pipeline"), "model": text(d, "model"), "orchestrator_address": text(d, "orch_address"), "orchestrator_uri": text(d, "orch_url"), "gpu_id": text(d, "gpu_id"), "gpu_model_name": text(d, "gpu_name")} | own
        return d.select(*(named[c].alias(c) for c in JOB)).where("coalesce(job_id, '') <> '' and pipeline <> ''")

    done = {"success": F.coalesce(F.col("success"), F.lit(False)).cast("int"), "duration_ms": F.coalesce(F.col("duration_ms"), F.lit(0)).cast("long"), "event_ts": F.coalesce("event_ts", "received_at")}
    price = lambda d: F.coalesce(F.col("price_per_unit"), F.lit(0.0)).cast("double") if "price_per_unit" in d.columns else F.lit(0.0)
    stream = {"success": (F.col("startup_outcome") == "success").cast("int"), "duration_ms": F.coalesce("startup_latency_ms", F.lit(0)).cast("long"), "event_ts": F.coalesce("started_at", "last_seen"), "price_per_unit": F.lit(0.0), "pipeline": text(streams, "pipeline_hint"), "orchestrator_address": text(streams, "address")}
    parts = [shaped(streams, "stream", "session_key", stream), shaped(ai_batch, "ai-batch", "request_id", done | {"price_per_unit": price(ai_batch)}), shaped(byoc, "byoc", "request_id", done | {"pipeline": text(byoc, "capability"), "price_per_unit": price(byoc)})]
    return reduce(DataFrame.unionByName, parts)
