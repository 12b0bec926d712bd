"""Change boundaries, versions, intervals and segments of ordered histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Seconds of a stretch of time. A key's rows of one stretch meet in one task, never all rows of a key.
STRETCH_S = 3_600


def _numbered(df: DataFrame, keys: list[str], order: list[str], value: str, own: Column, *, swap: Column | None = None, stamp: str | None = None, stretch_s: int = STRETCH_S) -> DataFrame:
    """Rows with ``_before`` (the last ``own`` before the row in its key), ``_starts`` (own is the first, differs from it or is swapped in), ``_number`` (starts up to the row) and, for a stamp, ``_next`` (that of the next start).

    ``own`` is a struct, or null where a row is passed over. The order begins with a time; rows of one place in it go by
    their value. Rows meet by key and stretch of time. A row for each stretch says what it begins and ends with and how
    often it changes inside; a window over these few rows adds up the changes of earlier stretches and hands over the
    value before and the next start. Null keys are a key.
    """
    stretch = F.floor(F.unix_micros(order[0]) / F.lit(stretch_s * 1_000_000)).cast("long")
    rows = df.withColumns({"_k": F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))), "_b": stretch, "_v": own, "_swap": F.coalesce(F.lit(False) if swap is None else swap, F.lit(False))})
    # One struct names key and stretch: it is never null, so that rows stay where they are for aggregate and join.
    rows = rows.withColumn("_at", F.struct("_k", "_b"))
    place = [*order, value]
    w = Window.partitionBy("_at").orderBy(*place)
    earlier, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    there = F.col("_v").isNotNull()
    placed = rows.withColumn("_lag", F.last("_v", ignorenulls=True).over(earlier))
    placed = placed.withColumn("_inside", there & F.col("_lag").isNotNull() & (F.col("_swap") | ~F.col("_v").eqNullSafe(F.col("_lag"))))
    placed = placed.withColumns({"_opens": there & F.col("_lag").isNull(), "_inner": F.sum(F.col("_inside").cast("long")).over(upto), "_seen": F.max(there).over(upto)})
    at = F.struct(F.col(stamp)) if stamp else F.lit(None).cast("struct<s:timestamp>")
    if stamp:
        # What follows is what comes before in falling order: frames that only grow cost one pass.
        falling = Window.partitionBy("_at").orderBy(*(F.desc(c) for c in place)).rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("_after", F.last(F.when(F.col("_inside"), at), ignorenulls=True).over(falling))
    where = F.struct(*place)
    ends = placed.groupBy("_at").agg(
        F.max_by("_v", F.when(there, where)).alias("_last"),
        F.first(F.when(F.col("_opens"), F.struct(F.col("_v").alias("v"), F.col("_swap").alias("swap"), at.alias("at"))), ignorenulls=True).alias("_open"),
        F.min_by(at, F.when(F.col("_inside"), where)).alias("_change"),
        F.sum(F.col("_inside").cast("long")).alias("_changes"),
    )
    up = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("_k").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("*", "_at.*").withColumn("_carried", F.last("_last", ignorenulls=True).over(up))
    enters = F.col("_open").isNotNull() & (F.col("_carried").isNull() | F.col("_open.swap") | ~F.col("_open.v").eqNullSafe(F.col("_carried")))
    ends = ends.withColumn("_enters", enters).withColumn("_base", F.coalesce(F.sum(F.col("_changes") + F.col("_enters").cast("long")).over(up), F.lit(0)))
    if stamp:
        ends = ends.withColumn("_later", F.last(F.when(F.col("_enters"), F.col("_open.at")).otherwise(F.col("_change")), ignorenulls=True).over(down))
    carried = ["_carried", "_enters", "_base", *(["_later"] if stamp else [])]
    out = placed.join(ends.select("_at", *carried), "_at")
    out = out.withColumns({
        "_before": F.coalesce("_lag", "_carried"),
        "_starts": F.col("_inside") | (F.col("_opens") & F.col("_enters")),
        "_number": F.col("_base") + F.col("_inner") + (F.col("_seen") & F.col("_enters")).cast("long"),
    })
    if stamp:
        out = out.withColumn("_next", F.coalesce("_after", "_later")[stamp])
    return out.select(*df.columns, "_before", "_starts", "_number", "_swap", *(["_next"] if stamp else []))


def selections(df: DataFrame, keys: list[str], order: list[str], ident: str, swap: Column | None = None, *, stretch_s: int = STRETCH_S) -> DataFrame:
    """Rows where the identity is the first, explicitly swapped, or another than before, numbered from 1; blank identities are passed over."""
    rows = df.where(F.coalesce(F.col(ident), F.lit("")) != "")
    kept = _numbered(rows, keys, order, ident, F.struct(ident), swap=swap, stretch_s=stretch_s).where("_starts")
    trigger = F.when(F.col("_before").isNull(), "initial").when(F.col("_swap"), "explicit_swap").otherwise("observed_change")
    return kept.select(*df.columns, trigger.alias("trigger"), F.col("_number").alias("seq"))


def versions(df: DataFrame, keys: list[str], order: list[str], value: str, *, stretch_s: int = STRETCH_S) -> DataFrame:
    """Rows whose value differs from the row before, numbered; null is a value."""
    return _numbered(df, keys, order, value, F.struct(value), stretch_s=stretch_s).where("_starts").select(*df.columns, F.col("_number").alias("version"))


def intervals(df: DataFrame, keys: list[str], stamp: str, order: list[str], value: str, *, stretch_s: int = STRETCH_S) -> DataFrame:
    """Versions with valid_from and valid_to (null for the last)."""
    kept = _numbered(df, keys, order, value, F.struct(value), stamp=stamp, stretch_s=stretch_s).where("_starts")
    return kept.select(*df.columns, F.col("_number").alias("version"), F.col(stamp).alias("valid_from"), F.col("_next").alias("valid_to"))


def segments(df: DataFrame, keys: list[str], order: list[str], value: str, *, stretch_s: int = STRETCH_S) -> DataFrame:
    """Segment number: rises where the value changes between two that aren't blank."""
    own = F.when(F.coalesce(F.col(value), F.lit("")) != "", F.struct(value))
    return _numbered(df, keys, order, value, own, stretch_s=stretch_s).select(*df.columns, F.greatest("_number", F.lit(1)).alias("segment"))


def tail_artifacts(df: DataFrame, keys: list[str], hour: str, few: int = 3) -> DataFrame:
    """Flags last hours without output whose hour before had none either. Needs started_at, last_seen and the three counters."""
    w = Window.partitionBy(*keys).orderBy(hour)
    idle = lambda f, r, n: (F.coalesce(f, F.lit(0)) == 0) & (F.coalesce(r, F.lit(0)) == 0) & (F.coalesce(n, F.lit(0)) < few)
    own = idle(F.col("fps_positive_samples"), F.col("running_samples"), F.col("status_samples"))
    prev = idle(*(F.lag(c).over(w) for c in ("fps_positive_samples", "running_samples", "status_samples")))
    end = F.col(hour) + F.expr("INTERVAL 1 HOUR")
    here = (F.col("started_at") < F.col(hour)) & (F.col("last_seen") >= F.col(hour)) & (F.col("last_seen") < end)
    return df.withColumn("is_tail_artifact", F.coalesce(own & prev & here, F.lit(False)).cast("int"))


def run_starts(df: DataFrame, keys: list[str], stamp: str, ident: str, values: list[str], *, stretch_s: int = 3_600) -> DataFrame:
    """Rows with ``<value>_starts``: whether the value isn't blank and differs from the last one before it in the row's key, in the order of stamp and ident.

    Rows of a key meet a stretch of time at a time, and each stretch hands its last values to the next ones: as in as-of
    matches, no task holds all rows of a key. Null keys are a key.
    """
    own = lambda v: F.nullif(F.col(v), F.lit(""))
    rows = df.withColumn("_b", F.floor(F.unix_micros(stamp) / F.lit(stretch_s * 1_000_000)).cast("long"))
    before = Window.partitionBy(*keys, "_b").orderBy(stamp, ident).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumns({f"_lag_{v}": F.last(own(v), ignorenulls=True).over(before) for v in values})
    ends = rows.groupBy(*keys, "_b").agg(*(F.max(F.when(own(v).isNotNull(), F.struct(stamp, ident, v)))[v].alias(f"_end_{v}") for v in values))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_b", *(F.last(f"_end_{v}", ignorenulls=True).over(earlier).alias(f"_carried_{v}") for v in values))
    on = reduce(lambda a, b: a & b, (F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_b"]))
    out = placed.alias("o").join(carried.alias("c"), on, "left").select("o.*", *(f"c._carried_{v}" for v in values))
    starts = {f"{v}_starts": own(v).isNotNull() & ~F.coalesce(F.coalesce(f"_lag_{v}", f"_carried_{v}") == F.col(v), F.lit(False)) for v in values}
    return out.withColumns(starts).select(*df.columns, *starts)


def runs_in_order(df: DataFrame, keys: list[str], stamp: str, ident: str, value: str, *, stretch_s: int = 3_600) -> DataFrame:
    """The first row of each run of a value in its key; blank values are passed over."""
    return run_starts(df, keys, stamp, ident, [value], stretch_s=stretch_s).where(f"{value}_starts").drop(f"{value}_starts")


def touched_by_snapshots(decisions: DataFrame, snapshots: DataFrame, keys: list[str], skew_s: int = 30) -> DataFrame:
    """Decisions that snapshots which came late may change: of the same identity, at the earliest such snapshot or later (or within the skew before it)."""
    first = snapshots.groupBy(*keys).agg(F.min("event_ts").alias("_first"))
    return decisions.join(first, keys).where(F.col("selection_ts") >= F.col("_first") - F.make_interval(secs=F.lit(skew_s))).drop("_first")


def owned_hours(hours: DataFrame, facts: DataFrame, keys: list[str], hour: str) -> DataFrame:
    """Hours of a session from the one of its start (if known) to the one of its end (if it ended); others don't belong to it."""
    own = hours.join(facts.select(*keys, F.date_trunc("hour", "started_at").alias("_from"), F.date_trunc("hour", "closed_at").alias("_to")), keys, "left")
    return own.where((F.col("_from").isNull() | (F.col(hour) >= F.col("_from"))) & (F.col("_to").isNull() | (F.col(hour) <= F.col("_to")))).drop("_from", "_to")
