"""Column expressions of the event domain. Each takes and returns columns; none reads the clock."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the event contract.
PIPELINES = ["live-video-to-video", "text-to-image", "image-to-image", "image-to-video", "text-to-video", "audio-to-text", "text-to-speech", "upscale", "llm", "image-to-text", "segment-anything-2", "noop"]
MODEL_ALIASES = {"streamdiffusion-sdxl": "streamdiffusion-sdxl", "streamdiffusion-sdxl-v2v": "streamdiffusion-sdxl-v2v", "streamdiffusion-sdxl-faceid": "streamdiffusion-sdxl-faceid", "streamdiffusion": "streamdiffusion", "pip_sdxl-turbo": "streamdiffusion-sdxl", "pip_sd-turbo": "streamdiffusion-sdxl", "pip_sdxl-turbo-v2v": "streamdiffusion-sdxl-v2v", "pip_sdxl-turbo-faceid": "streamdiffusion-sdxl-faceid"}
EXCUSABLE_ERRORS = ["no orchestrators available", "mediamtx ingest disconnected", "whip disconnected", "missing video", "ice connection state failed", "user disconnected"]
RUNNING_STATES = ["ONLINE", "DEGRADED_INPUT", "DEGRADED_INFERENCE"]


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def none_if_blank(c: Column) -> Column:
    return F.when(~blank(c), F.trim(c))


def session_key(org: Column, stream: Column, request: Column) -> Column:
    """org|stream|request with placeholders for one blank part; empty if both are blank."""
    part = lambda c, name: F.coalesce(none_if_blank(c), F.lit(name))
    return F.when(blank(stream) & blank(request), "").otherwise(F.concat_ws("|", org, part(stream, "_missing_stream"), part(request, "_missing_request")))


def hash_id(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def identity(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def is_address(c: Column) -> Column:
    return identity(c).rlike("^0x[0-9a-f]{40}$")


def candidate_identity(address: Column, url: Column) -> Column:
    """The address, else the URL."""
    return F.when(is_address(address), identity(address)).otherwise(identity(url))


def ratio(part: Column, whole: Column) -> Column:
    """Null, not 0, where the whole is 0."""
    return F.try_divide(part.cast("double"), F.nullif(whole, F.lit(0)).cast("double"))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def contains_any(c: Column, fragments: list[str] = EXCUSABLE_ERRORS) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return reduce(lambda a, b: a | b, (low.contains(f) for f in fragments))


def running(state: Column) -> Column:
    return F.upper(F.coalesce(state, F.lit(""))).isin(RUNNING_STATES)


def startup_outcome(requested: Column, playable: Column) -> Column:
    return F.when(requested == 0, "unknown").when(playable == 1, "success").otherwise("failed")


def startup_excusal(outcome: Column, no_provider: Column, errors: Column, excusable: Column) -> Column:
    return F.when(outcome != "failed", "").when(no_provider, "no_orch").when((errors > 0) & (errors == excusable), "excusable_error").otherwise("")


def selection_outcome(attributed: Column, no_provider: Column) -> Column:
    return F.when(attributed, "selected").when(no_provider, "no_orch").otherwise("unknown")


def normal_pipeline(c: Column) -> Column:
    return F.when(identity(c).isin(PIPELINES), identity(c)).otherwise("")


def normal_hints(pipeline: Column, model: Column) -> tuple[Column, Column]:
    """(pipeline, model): aliases of models count as models wherever they stand; a diffusion model implies live video."""
    aliases = F.create_map(*(F.lit(x) for kv in MODEL_ALIASES.items() for x in kv))
    own = F.coalesce(none_if_blank(model), F.lit(""))
    from_pipeline = F.coalesce(F.element_at(aliases, identity(pipeline)), F.lit(""))
    low = F.lower(own)
    named = F.when(low.isin([k for k in MODEL_ALIASES if k == MODEL_ALIASES[k]]), low).otherwise(own)
    m = F.when(own == "", from_pipeline).otherwise(named)
    p = F.when(normal_pipeline(pipeline) != "", normal_pipeline(pipeline)).when(F.lower(m).startswith("streamdiffusion"), "live-video-to-video").otherwise("")
    return F.when((p != "") & (p == F.lower(m)), "").otherwise(p), m


def attribution_status(resolved: Column, ambiguous: Column, stale: Column, hardware_less: Column) -> Column:
    """The first flag that is set, in the order resolved, ambiguous, hardware_less, stale."""
    return F.when(resolved, "resolved").when(ambiguous, "ambiguous").when(hardware_less, "hardware_less").when(stale, "stale").otherwise("unresolved")


def position_score(value: Column, good: Column, bad: Column, rows: Column, *, rising: bool, least_rows: int = 48) -> Column:
    """1 at ``good`` or better, 0 at ``bad`` or worse, in between in proportion; 0.5 without a value or with too few rows."""
    v, g, b = (value, good, bad) if rising else (-value, -good, -bad)
    inside = F.try_divide(v - b, g - b)
    return F.when(value.isNull() | rows.isNull() | (rows < least_rows), 0.5).when(g <= b, F.when(v >= g, 1.0).otherwise(0.0)).otherwise(clamp(inside))


def dampened(raw: Column, samples: Column, full: float) -> Column:
    """Pulled to 0.5 while there are fewer than ``full`` samples."""
    return clamp(0.5 + F.least(samples / full, F.lit(1.0)) * (raw - 0.5))


def sla_score(requested: Column, coverage: Column, startup: Column, no_swap: Column, viable: Column, ptff: Column, e2e: Column, fps: Column) -> Column:
    reliability = clamp(0.4 * startup + 0.2 * no_swap + 0.4 * viable)
    quality = clamp(0.6 * (0.6 * ptff + 0.4 * e2e) + 0.4 * fps)
    return F.when(requested > 0, clamp(100.0 * coverage * (0.7 * reliability + 0.3 * quality), 0.0, 100.0))
