"""Evidence of sessions from their rows, their latest decisions, and additive inputs of hourly scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import latest
from tidemark.sources.envelopes import CORE_TRACES

KEYS = ["org", "session_key"]


def newest(value: str, where: Column | None = None) -> Column:
    """The latest value that isn't blank, by time and event id: a partial maximum in the map tasks."""
    set_ = F.coalesce(F.col(value), F.lit("")) != ""
    return F.max(F.when(set_ if where is None else set_ & where, F.struct("event_ts", "event_id", value)))[value]


def event_rollup(rows: DataFrame) -> DataFrame:
    """Of each session's events: latest hint, messages, last seen."""
    return rows.where("session_key <> ''").groupBy(*KEYS).agg(newest("pipeline_hint").alias("pipeline_hint"), F.count_if(F.col("message") != "").alias("message_count"), F.max("event_ts").alias("last_seen"))


def observations(rows: DataFrame) -> DataFrame:
    """Of each session, over all families: number of providers seen, and the identity seen last."""
    ident = expr.candidate_identity(F.col("orch_address"), F.col("orch_url"))
    return rows.groupBy(*KEYS).agg(F.count_distinct(F.nullif(ident, F.lit(""))).alias("providers_seen"), newest("orch_address").alias("last_address"), newest("orch_url").alias("last_url"))


def attribution_input(rows: DataFrame) -> DataFrame:
    """``observations`` with the latest hint of each family and the number of swaps."""
    of = lambda f: F.col("family") == f
    hints = {f"{name}_hint": newest("pipeline_hint", of(f)) for name, f in (("trace", "stream_trace"), ("status", "ai_stream_status"), ("event", "ai_stream_events"))}
    wide = rows.groupBy(*KEYS).agg(*(c.alias(n) for n, c in hints.items()), F.count_if(of("stream_trace") & (F.col("event_subtype") == "orchestrator_swap")).alias("swap_count"), F.max("event_ts").alias("last_seen"))
    return observations(rows).join(wide, KEYS)


def gateway_of_session(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(newest("gateway").alias("gateway"))


def session_evidence(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """All that facts need of each session, from rows of ``session_rows``: one aggregate over all families, whose partial sums are made in the map tasks. ``keys`` may have more columns, such as a build."""
    trace, status = F.col("family") == "stream_trace", F.col("family") == "ai_stream_status"
    core = trace & F.col("event_subtype").isin(CORE_TRACES)
    first = lambda t: F.min(F.when(trace & (F.col("event_subtype") == t), F.col("event_ts")))
    times = lambda t: F.count_if(trace & (F.col("event_subtype") == t))
    failed = status & (F.col("last_error") != "")
    return rows.where(core | ~trace).groupBy(*keys).agg(
        first("gateway_receive_stream_request").alias("started_at"), first("gateway_receive_first_processed_segment").alias("first_processed_at"), first("gateway_receive_few_processed_segments").alias("playable_at"), first("gateway_ingest_stream_closed").alias("closed_at"),
        times("gateway_no_orchestrators_available").alias("no_provider_count"), times("orchestrator_swap").alias("swap_count"),
        F.count_if(status).alias("status_samples"), F.count_if(status & (F.col("output_fps") > 0)).alias("fps_positive_samples"), F.count_if(status & expr.running(F.col("state"))).alias("running_samples"),
        F.count_if(status & F.upper("state").startswith("DEGRADED")).alias("degraded_samples"), F.coalesce(F.sum(F.when(status, F.col("restart_count"))), F.lit(0)).alias("restart_count"), F.min(F.when(status, F.col("start_time"))).alias("first_start_time"),
        F.count_if(failed).alias("error_samples"), F.count_if(failed & expr.contains_any(F.col("last_error"))).alias("excusable_error_samples"),
        F.coalesce(F.sum(F.when(status, F.col("output_fps").cast("decimal(18,6)"))), F.lit(0)).cast("double").alias("output_fps_sum"),
        F.count_if((F.col("family") == "ai_stream_events") & (F.col("message") != "")).alias("message_count"),
        newest("pipeline_hint").alias("pipeline_hint"), newest("gateway").alias("gateway"), F.max("event_ts").alias("last_seen"),
    )


def latest_decision(decisions: DataFrame, values: list[str]) -> DataFrame:
    """The newest decision of each session, by selection and then decision time."""
    return latest.latest_values(decisions, KEYS, values, ["selection_ts", "decided_at", "decision_id"])


def attribution_latest(decisions: DataFrame) -> DataFrame:
    """The newest attribution of each session with its flags as 0 or 1."""
    newest_row = latest.latest_rows(decisions, KEYS, [F.desc("decided_at"), F.desc("decision_id")])
    is_ = lambda s: (F.col("status") == s).cast("int")
    return newest_row.select(*KEYS, "decision_id", "status", "address", "pipeline", "model", "gpu_id", is_("resolved").alias("is_attributed"), is_("ambiguous").alias("is_ambiguous"), is_("stale").alias("is_stale"), is_("hardware_less").alias("is_hardware_less"), F.col("gpu_id").isNotNull().cast("int").alias("has_gpu"))


_OUTCOMES, _STATUSES = ("selected", "no_orch", "unknown"), ("resolved", "hardware_less", "stale", "ambiguous", "unresolved")


def attribution_breakdown(jobs: DataFrame, dimensions: list[str], sets: list[list[str]]) -> DataFrame:
    """Jobs (outcome, status, swapped, and the dimensions) counted by outcome and status at several levels in one pass.

    ``sets`` are the levels' dimensions. ``level`` names those of a row, so that a null dimension of a level is told
    from one that the level leaves out; statuses count among selected jobs only.
    """
    selected = F.col("outcome") == "selected"
    counts = [F.count("*").alias("jobs"), *(F.count_if(F.col("outcome") == o).alias(f"{o}_jobs") for o in _OUTCOMES), *(F.count_if(selected & (F.col("status") == s)).alias(f"{s}_jobs") for s in _STATUSES), F.count_if(F.col("swapped")).alias("swapped_jobs")]
    own = [F.col(d) for d in dimensions]
    shown = [F.when(F.grouping(d) == 0, d).alias(f"_{d}") for d in dimensions]
    out = jobs.groupingSets([[F.col(d) for d in s] for s in sets], *own).agg(*shown, *counts)
    level = F.concat_ws("+", *(f"_{d}" for d in dimensions))
    return out.withColumn("level", F.when(level == "", "overall").otherwise(level)).drop(*(f"_{d}" for d in dimensions))


def session_hours(rows: DataFrame) -> DataFrame:
    """A row for each session and hour with rows of ``session_rows``: the hour's counters, and what is known of the whole session.

    Counters are summed by session and hour, partly in the map tasks; windows over a session's hours, a row each, give
    its start, outcome, excusal, swaps and output, and which last hours are idle tails. The payloads are read once.
    """
    trace, status = F.col("family") == "stream_trace", F.col("family") == "ai_stream_status"
    first = lambda t: F.min(F.when(trace & (F.col("event_subtype") == t), F.col("event_ts")))
    times = lambda t: F.count_if(trace & (F.col("event_subtype") == t))
    failed = status & (F.col("last_error") != "")
    core = rows.where((trace & F.col("event_subtype").isin(CORE_TRACES)) | ~trace)
    hours = core.groupBy(*KEYS, F.date_trunc("hour", "event_ts").alias("hour")).agg(
        first("gateway_receive_stream_request").alias("_start"), first("gateway_receive_few_processed_segments").alias("_play"), times("gateway_no_orchestrators_available").alias("_none"), times("orchestrator_swap").alias("_swaps"),
        F.count_if(status).alias("status_samples"), F.count_if(status & (F.col("output_fps") > 0)).alias("fps_positive_samples"), F.count_if(status & expr.running(F.col("state"))).alias("running_samples"),
        F.count_if(failed).alias("_errors"), F.count_if(failed & expr.contains_any(F.col("last_error"))).alias("_excusable"), F.coalesce(F.sum(F.when(status, F.col("output_fps").cast("decimal(18,6)"))), F.lit(0)).cast("decimal(28,6)").alias("output_fps_sum"), F.max("event_ts").alias("_last"),
        F.max(F.when(F.col("gateway") != "", F.struct("event_ts", "event_id", "gateway"))).alias("_gateway"), F.max(F.when(F.col("pipeline_hint") != "", F.struct("event_ts", "event_id", "pipeline_hint"))).alias("_pipeline"),
    )
    w = Window.partitionBy(*KEYS)
    total = lambda c: F.sum(c).over(w)
    whole = hours.withColumns({
        "started_at": F.min("_start").over(w), "playable_at": F.min("_play").over(w), "last_seen": F.max("_last").over(w), "_none": total("_none"), "swap_count": total("_swaps"),
        "_errors": total("_errors"), "_excusable": total("_excusable"), "_samples": total("status_samples"), "_positive": total("fps_positive_samples"),
        "gateway": F.max("_gateway").over(w)["gateway"], "pipeline_hint": F.max("_pipeline").over(w)["pipeline_hint"],
    })
    outcome = expr.startup_outcome(F.col("started_at").isNotNull().cast("int"), F.col("playable_at").isNotNull().cast("int"))
    facts = whole.withColumns({"startup_outcome": outcome, "zero_output": ((F.col("_samples") > 0) & (F.col("_positive") == 0)).cast("int")})
    facts = facts.withColumn("excusal_reason", expr.startup_excusal(F.col("startup_outcome"), F.col("_none") > 0, F.col("_errors"), F.col("_excusable")))
    # An idle tail: an hour of few samples without output, after another such hour, in which the session ends.
    idle = (F.col("fps_positive_samples") == 0) & (F.col("running_samples") == 0) & (F.col("status_samples") < 3)
    before = F.last(F.when(F.col("status_samples") > 0, idle), ignorenulls=True).over(w.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1))
    ends = (F.col("started_at") < F.col("hour")) & (F.col("last_seen") < F.col("hour") + F.expr("INTERVAL 1 HOUR"))
    facts = facts.withColumn("is_tail_artifact", F.coalesce((F.col("status_samples") > 0) & idle & before & ends, F.lit(False)).cast("int"))
    return facts.select(*KEYS, "hour", "status_samples", "fps_positive_samples", "running_samples", "output_fps_sum", "started_at", "last_seen", "startup_outcome", "excusal_reason", "swap_count", "zero_output", "is_tail_artifact", "gateway", "pipeline_hint", "_none")


def demand_hourly(hours: DataFrame, attribution: DataFrame) -> DataFrame:
    """Additive demand by hour, gateway, pipeline and model out of ``session_hours``: sessions that start in the hour and what became of them, and the performance of all sessions in it.

    A session counts in its start hour; its samples count in the hours they fell in, also where no session started. Its
    model is that of its latest attribution.
    """
    start = F.coalesce(F.date_trunc("hour", "started_at") == F.col("hour"), F.lit(False))
    rows = hours.withColumn("_start", start).where(F.col("_start") | (F.col("status_samples") > 0)).join(attribution.select(*KEYS, "model"), KEYS, "left")
    keys = {"gateway": F.coalesce("gateway", F.lit("")), "pipeline": F.coalesce("pipeline_hint", F.lit("")), "model": F.coalesce("model", F.lit(""))}
    counted = lambda c: F.count_if(F.col("_start") & c)
    minutes = F.sum(F.when(F.col("_start"), F.greatest(F.unix_millis("last_seen") - F.unix_millis("started_at"), F.lit(0)))) / F.lit(60000.0)
    out = rows.withColumns(keys).groupBy(F.col("hour").alias("window_start"), "org", *keys).agg(
        F.count_if("_start").alias("sessions"), counted(F.col("startup_outcome") == "success").alias("success_sessions"), counted((F.col("startup_outcome") == "failed") & (F.col("_none") > 0)).alias("no_orch_sessions"), counted(F.col("excusal_reason") != "").alias("excused_sessions"),
        counted(F.col("swap_count") > 0).alias("swapped_sessions"), counted(F.col("zero_output") == 1).alias("zero_output_sessions"), F.coalesce(minutes, F.lit(0.0)).alias("minutes"), F.sum("status_samples").alias("status_samples"), F.sum("output_fps_sum").cast("double").alias("output_fps_sum"),
    )
    return out.withColumns({"success_rate": expr.ratio(F.col("success_sessions"), F.col("sessions")), "avg_output_fps": expr.ratio(F.col("output_fps_sum"), F.col("status_samples"))})


def pipeline_usage(demand: DataFrame, limit: int) -> DataFrame:
    """The pipelines of most sessions with minutes and frame rate, and the same of each of their models, nested; every rate from sums."""
    exact = demand.withColumns({"output_fps_sum": F.col("output_fps_sum").cast("decimal(28,6)"), "_ms": F.round(F.col("minutes") * 60000).cast("long")})
    models = exact.where("pipeline <> ''").groupBy("pipeline", "model").agg(*(F.sum(c).alias(c) for c in ("sessions", "_ms", "output_fps_sum", "status_samples"))).withColumn("minutes", F.col("_ms") / F.lit(60000.0))
    each = F.struct((-F.col("sessions")).alias("_o"), "model", F.col("minutes"), F.col("sessions"), expr.ratio(F.col("output_fps_sum"), F.col("status_samples")).alias("avg_fps"))
    out = models.groupBy("pipeline").agg(F.sum("sessions").alias("sessions"), F.sum("minutes").alias("minutes"), expr.ratio(F.sum("output_fps_sum"), F.sum("status_samples")).alias("avg_fps"), F.array_sort(F.collect_list(each)).alias("models"))
    return out.orderBy(F.desc("sessions"), "pipeline").limit(limit)


def cohort_bands(rows: DataFrame, cohort: list[str], score: str, stamp: str, ident: list[str], largest: int = 3) -> DataFrame:
    """Of the ``largest`` cohorts the row of the lowest score, of the one nearest to 50, and of the highest, the newest of equal ones: three aggregates, no sort of a cohort."""
    newest = lambda: (-F.unix_micros(stamp)).alias("n")
    row = F.struct(stamp, score, *ident).alias("row")
    band = lambda s: F.min(F.struct(s.alias("s"), newest(), *ident, row))
    out = rows.groupBy(*cohort).agg(F.count("*").alias("cohort_rows"), F.array(F.struct(F.lit("low").alias("band"), band(F.col(score)).row.alias("row")), F.struct(F.lit("medium").alias("band"), band(F.abs(F.col(score) - 50)).row.alias("row")), F.struct(F.lit("high").alias("band"), band(-F.col(score)).row.alias("row"))).alias("b"))
    top = out.orderBy(F.desc("cohort_rows"), *cohort).limit(largest)
    return top.select(*cohort, "cohort_rows", F.explode("b").alias("b")).select(*cohort, "cohort_rows", "b.band", "b.row.*")


def sla_input_hourly(hours: DataFrame, attribution: DataFrame, inventory: DataFrame) -> DataFrame:
    """Additive counters by hour, provider, pipeline, model and GPU out of ``session_hours``; rates are null where nothing was counted.

    An idle tail's samples don't count; a session's start counts in its start hour. Sessions without attribution count
    under blank names; the inventory gives a GPU's name.
    """
    live = (F.col("status_samples") > 0) & (F.col("is_tail_artifact") == 0)
    start = F.coalesce(F.date_trunc("hour", "started_at") == F.col("hour"), F.lit(False))
    named = hours.where(live | start).withColumns({"_live": live, "_start": start}).join(attribution.select(*KEYS, "address", "pipeline", "model", "gpu_id"), KEYS, "left").join(inventory.select("gpu_id", "gpu_name"), "gpu_id", "left")
    keys = ["address", "pipeline", "model", "gpu_id", "gpu_name"]
    named = named.withColumns({k: F.coalesce(k, F.lit("")) for k in keys})
    ok, excused = F.col("startup_outcome") == "success", F.col("excusal_reason") != ""
    counted = lambda c: F.count_if(F.col("_start") & c)
    sampled = lambda c: F.coalesce(F.sum(F.when(F.col("_live"), F.col(c))), F.lit(0))
    out = named.groupBy(F.col("hour").alias("window_start"), "org", *keys).agg(
        F.count_if("_start").alias("requested_sessions"), counted(ok).alias("startup_success_sessions"), counted(~ok & excused).alias("startup_excused_sessions"), counted(~ok & ~excused).alias("startup_failed_sessions"),
        counted(ok & (F.col("zero_output") == 1)).alias("output_failed_sessions"), counted(F.col("swap_count") > 0).alias("swapped_sessions"), sampled("status_samples").cast("long").alias("status_samples"), sampled("fps_positive_samples").cast("long").alias("health_signal_count"),
        sampled("output_fps_sum").cast("double").alias("output_fps_sum"),
    )
    return out.withColumns({
        "effective_failed_sessions": F.col("startup_failed_sessions") + F.col("output_failed_sessions"),
        "startup_success_rate": expr.ratio(F.col("startup_success_sessions"), F.col("requested_sessions") - F.col("startup_excused_sessions")),
        "avg_output_fps": expr.ratio(F.col("output_fps_sum"), F.col("status_samples")), "health_coverage": expr.ratio(F.col("health_signal_count"), F.col("status_samples")),
    })
