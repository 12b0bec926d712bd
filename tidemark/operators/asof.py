"""As-of matches without range joins: both sides in windows by key and stretch of time, with what earlier and later stretches carry over."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import expr

#: Seconds of a stretch of time. A key's rows of one stretch meet in one task, never all rows of a key.
STRETCH_S = 3_600


def _keyed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all there: null keys match nothing."""
    return rows.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))


def _stretch(ts: str, stretch_s: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(stretch_s * 1_000_000)).cast("long")


def neighbours(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, *, stretch_s: int = STRETCH_S) -> DataFrame:
    """Each left row with the right times before (prev_ts), equal (same_ts) and after (next_ts) it; null keys and times have none.

    Rows meet by key and stretch of time. A row for each key and stretch holds its first and last right time; a window
    over these few rows carries the last of earlier stretches and the first of later ones, which join back by key and
    stretch. So the largest task grows with a stretch's rows and with the number of stretches, not with a key's rows.
    """
    stamps = _keyed(right, keys).select(*keys, F.col(right_ts).alias("_t")).distinct().withColumn("_r", F.lit(True))
    both = left.withColumns({"_t": F.col(left_ts), "_r": F.lit(False)}).unionByName(stamps, allowMissingColumns=True).withColumn("_b", _stretch("_t", stretch_s))
    w = Window.partitionBy(*keys, "_b").orderBy(F.unix_micros("_t"))
    # What follows is what comes before in falling order: frames that only grow cost one pass.
    falling = Window.partitionBy(*keys, "_b").orderBy(F.unix_micros("_t").desc())
    own = F.when(F.col("_r"), F.col("_t"))
    placed = both.withColumns({
        "prev_ts": F.last(own, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, -1)),
        "same_ts": F.max(own).over(w.rangeBetween(0, 0)),
        "next_ts": F.last(own, ignorenulls=True).over(falling.rangeBetween(Window.unboundedPreceding, -1)),
    })
    ends = both.groupBy(*keys, "_b").agg(F.min(own).alias("_min"), F.max(own).alias("_max"))
    up, down = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("_b"), F.desc("_b")))
    carried = ends.select(*keys, "_b", F.last("_max", ignorenulls=True).over(up).alias("_before"), F.last("_min", ignorenulls=True).over(down).alias("_after"))
    out = placed.where(~F.col("_r")).join(carried, [*keys, "_b"], "left")
    filled = {"prev_ts": F.coalesce("prev_ts", "_before"), "next_ts": F.coalesce("next_ts", "_after")}
    return out.withColumns(filled).select(*left.columns, "prev_ts", "same_ts", "next_ts")


def interval_class(df: DataFrame, ts: str, prev_end: str, *, fresh_s: int = 600, skew_s: int = 30) -> DataFrame:
    """match_class of rows of ``neighbours``: exact at an equal time; of the one before exact or stale if it still holds, else prior or stale, by its age; future within the skew."""
    age = F.unix_micros(ts) - F.unix_micros("prev_ts")
    ahead = F.unix_micros("next_ts") - F.unix_micros(ts)
    holds = F.col(prev_end).isNull() | (F.col(prev_end) > F.col(ts))
    fresh = age <= fresh_s * 1_000_000
    kind = F.when(F.col("same_ts").isNotNull(), "exact").when(F.col("prev_ts").isNotNull() & fresh, F.when(holds, "exact").otherwise("prior"))
    return df.withColumn("match_class", kind.when(ahead <= skew_s * 1_000_000, "future").when(F.col("prev_ts").isNotNull(), "stale").otherwise("none"))


def latest_before(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, value: str, *, stretch_s: int = STRETCH_S) -> DataFrame:
    """Each left row with the right ``value`` of the latest time at or before it (of several, the largest value); null keys have none. Rows meet as in ``neighbours``."""
    name = f"asof_{value}"
    r = _keyed(right, keys).where(F.col(right_ts).isNotNull()).groupBy(*keys, F.col(right_ts).alias("_t")).agg(F.max(value).alias("_v")).where("_v is not null")
    both = left.withColumns({"_t": F.col(left_ts), "_l": F.lit(1)}).unionByName(r.withColumn("_l", F.lit(0)), allowMissingColumns=True).withColumn("_b", _stretch("_t", stretch_s))
    w = Window.partitionBy(*keys, "_b").orderBy("_t", "_l").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn(name, F.last("_v", ignorenulls=True).over(w)).where("_l = 1")
    ends = both.groupBy(*keys, "_b").agg(F.max(F.when(F.col("_l") == 0, F.struct("_t", "_v")))["_v"].alias("_last"))
    up = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_b", F.last("_last", ignorenulls=True).over(up).alias("_before"))
    out = placed.join(carried, [*keys, "_b"], "left")
    return out.withColumn(name, F.when(F.col("_t").isNotNull(), F.coalesce(name, "_before"))).select(*left.columns, name)


def attribute(selections: DataFrame, history: DataFrame, *, fresh_s: int = 600, skew_s: int = 30) -> DataFrame:
    """Selections (selection_id, org, ident, ts, pipeline, model) attributed to intervals of history (org, ident, ident_type, valid_from, valid_to, address, uri, pipeline, model, gpu_id, interval_hash).

    Bucket starts around each selection are found for the identity types it may have (an address may be an alias, a URL is
    only a URL), classified, and joined to the interval rows; the best tier is kept, then compatible pipelines and models
    (all if none is), then the preferred identity type. More than one distinct provider, pipeline and model is ambiguous;
    a provider without hardware is hardware_less, whatever its tier.
    """
    types = F.when(expr.is_address(F.col("ident")), F.array(F.lit("address"), F.lit("alias"))).otherwise(F.array(F.lit("uri")))
    kinds = selections.withColumn("ident_type", F.explode(types))
    near = neighbours(kinds, history, ["org", "ident", "ident_type"], "ts", "valid_from")
    starts = history.groupBy("org", "ident", "ident_type", F.col("valid_from").alias("prev_ts")).agg(F.min_by("valid_to", "interval_hash").alias("_end"))
    near = near.join(starts, ["org", "ident", "ident_type", "prev_ts"], "left")
    at = interval_class(near, "ts", "_end", fresh_s=fresh_s, skew_s=skew_s).where("match_class <> 'none'")
    tier = F.when(F.col("match_class") == "exact", 1).when(F.col("match_class") == "prior", 2).when(F.col("match_class") == "future", 3).otherwise(4)
    pref = F.when(F.col("ident_type") == "uri", 1).when(F.col("ident_type") == "address", 2).otherwise(3)
    start = F.when(F.col("same_ts").isNotNull(), F.col("same_ts")).when(F.col("match_class") == "future", F.col("next_ts")).otherwise(F.col("prev_ts"))
    at = at.withColumns({"_tier": tier, "_pref": pref, "valid_from": start}).select("selection_id", "org", "ident", "ident_type", "ts", "match_class", "_tier", "_pref", "valid_from", F.col("pipeline").alias("_p"), F.col("model").alias("_m"))
    rows = at.join(history, ["org", "ident", "ident_type", "valid_from"])
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    fits = ((low("_p") == "") | (low("_p") == low("pipeline"))) & ((low("_m") == "") | (low("_m") == low("model")))
    w = Window.partitionBy("selection_id")
    best = rows.withColumn("_best", F.min("_tier").over(w)).where("_tier = _best").withColumn("_fits", fits).withColumn("_any", F.max("_fits").over(w)).where("_fits or not _any")
    best = best.withColumn("_bp", F.min("_pref").over(w)).where("_pref = _bp")
    distinct = F.size(F.collect_set(F.struct("address", "uri", low("pipeline").alias("p"), low("model").alias("m"))))
    pick = F.min(F.struct((-F.unix_micros("valid_from")).alias("o"), "interval_hash", "address", "uri", "pipeline", "model", "gpu_id", "match_class")).alias("_r")
    out = best.groupBy("selection_id").agg(distinct.alias("_n"), F.count_distinct("gpu_id").alias("_gpus"), pick)
    one = F.col("_n") == 1
    take = lambda c: F.when(one, F.col(f"_r.{c}")).alias(c)
    kind, bare = F.col("_r.match_class"), F.col("_r.gpu_id").isNull()
    status = F.when(~one, "ambiguous").when(bare, "hardware_less").when(kind == "stale", "stale").otherwise("resolved")
    reason = F.when(~one, "ambiguous_candidates").when(bare, "matched_without_hardware").when(kind == "exact", "matched").when(kind == "prior", "matched_prior").when(kind == "future", "future_skew").otherwise("stale_candidate")
    sure = F.when(~one, "low").when(kind == "stale", "medium").otherwise("high")
    found = out.select("selection_id", status.alias("status"), reason.alias("reason"), sure.alias("confidence"), take("address"), take("uri"), take("pipeline"), take("model"), F.when(one & (F.col("_gpus") == 1), F.col("_r.gpu_id")).alias("gpu_id"))
    return selections.select("selection_id").join(found, "selection_id", "left").fillna({"status": "unresolved", "reason": "missing_candidate", "confidence": "low"})
