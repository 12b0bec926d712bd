"""Structured Streaming forms: routing, deduplication, hourly sessions, repair of late slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import asof, changes, latest
from tidemark.sources import envelopes


def dedup(raw: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Each (org, event_id) once within the watermark."""
    return raw.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["org", "event_id"])


def dedup_into(raw: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Each (org, event_id) once in a table by day, however late it comes again: of a batch one row, and only what the table lacks.

    A batch reads the table's partitions of its own days alone. What it writes lies under its number, which it doesn't
    read: run again after a failure, it comes to the same rows and replaces them. An event keeps its time, so that it
    comes again on the same day. Rows without id or time are left out.
    """

    def write(batch: DataFrame, n: int) -> None:
        rows = batch.where("org is not null and coalesce(trim(event_id), '') <> '' and event_ts is not null").withColumn("day", F.to_date("event_ts"))
        rows = rows.dropDuplicates(["org", "event_id"])
        days = [r.day for r in rows.select("day").distinct().collect()]  # a row for each day of the batch
        if (known := stored_days(batch.sparkSession, table, days, n)) is not None:
            rows = rows.join(known, ["day", "org", "event_id"], "left_anti")
        rows.write.mode("overwrite").partitionBy("day").parquet(f"{table}/batch={n}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_days(spark: SparkSession, table: str, days: list, before: int) -> DataFrame | None:
    """(day, org, event_id) that batches other than ``before`` have stored for these days; None if there is no table yet."""
    files = spark._jvm.org.apache.hadoop.fs
    top = files.Path(f"{table}/batch=*/day=*")
    if not top.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(top):
        return None
    kept = spark.read.option("basePath", table).parquet(table)
    return kept.where((F.col("batch") != before) & F.col("day").isin(days)).select("day", "org", "event_id")


def read_bounded(records: DataFrame, dead: str, checkpoint: str, table: str, most: int = 100) -> StreamingQuery:
    """Kafka records (key, value, topic, partition, offset) as envelopes in ``table``; broken ones go to ``dead`` with their place.

    A batch with more than ``most`` broken records of one topic fails before anything of it is written, and is read again
    when the stream starts anew. Each batch has a folder of its own in both places.
    """

    def write(batch: DataFrame, n: int) -> None:
        rows = envelopes.parsed_records(batch).persist()
        try:
            worst = rows.where("is_broken").groupBy("source_topic").count().orderBy(F.desc("count")).first()
            if worst and worst["count"] > most:
                raise ValueError(f"{worst['count']} broken records of {worst.source_topic} in batch {n}, {most} are allowed")
            rows.where("is_broken").select("source_topic", "source_partition", "source_offset", "value").write.mode("overwrite").parquet(f"{dead}/batch={n}")
            rows.where("not is_broken").drop("is_broken", "value").write.mode("overwrite").parquet(f"{table}/batch={n}")
        finally:
            rows.unpersist()

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def route_to(raw: DataFrame, accepted: str, ignored: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Both branches of each micro-batch; a batch that is run again overwrites its own folder, so that each row is kept once."""

    def write(batch: DataFrame, n: int) -> None:
        for rows, path in zip(envelopes.route(batch), (accepted, ignored), strict=True):
            rows.write.mode("overwrite").parquet(f"{path}/batch={n}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def session_hours(status: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    rows = status.withWatermark("event_ts", lateness)
    return rows.groupBy(F.window("event_ts", "1 hour"), "org", "session_key").agg(F.count("*").alias("status_samples"), F.sum("output_fps").alias("output_fps_sum"))


def minute_throughput(raw: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    return raw.withWatermark("event_ts", lateness).groupBy(F.window("event_ts", "1 minute"), "event_type").agg(F.count("*").alias("n_events"))


def repair_slices(stream: DataFrame, base: Callable[[list], DataFrame], build: Callable[[DataFrame], DataFrame], table: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch's (org, hour) are computed again from ``base`` and overwrite their partitions; rows may be as late as they like.

    ``base`` gets the days that the batch touches, so that a table partitioned by day is read for those alone. A slice
    of which nothing is left keeps one row with ``is_empty``; ``read_slices`` leaves it out.
    """

    def write(batch: DataFrame, n: int) -> None:
        _rebuild(batch.select("org", F.date_trunc("hour", "event_ts").alias("hour")).distinct(), base, build, table)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _rebuild(hours: DataFrame, base: Callable[[list], DataFrame], build: Callable[[DataFrame], DataFrame], table: str) -> None:
    """Compute (org, hour) again from the rows of their days, and overwrite their partitions."""
    days = [r.day for r in hours.select(F.to_date("hour").alias("day")).distinct().collect()]  # a row for each day of the batch
    if not days:
        return
    rows = base(days).withColumn("hour", F.date_trunc("hour", "event_ts")).join(hours, ["org", "hour"], "left_semi")
    built = build(rows).withColumn("is_empty", F.lit(False))
    whole = hours.join(built, ["org", "hour"], "left").fillna({"is_empty": True})
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("org", "hour").parquet(table)


def read_slices(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).where("not is_empty").drop("is_empty")


LEDGER = "org string, mode string, slice_start timestamp, late_rows long, last_ingested timestamp"


class _Ledger(StatefulProcessor):
    """A slice's late rows and when the last of them came; told once nothing more has come for a while, and then forgotten."""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.dirt = handle.getValueState("dirt", "late_rows long, last_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of Spark's interface
        n, last = self.dirt.get() if self.dirt.exists() else (0, 0)
        for f in rows:
            n, last = n + len(f), max(last, int(f["ms"].max()))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.dirt.update((n, last))
        self.handle.registerTimer(last + self.quiet_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, last = self.dirt.get()
        self.dirt.clear()
        yield pd.DataFrame({"org": [key[0]], "mode": [key[1]], "slice_start": [pd.Timestamp(key[2])], "late_rows": [n], "last_ingested": [pd.Timestamp(last, unit="ms")]})

    def close(self) -> None:
        pass


def dirty_ledger(raw: DataFrame, *, lateness: str = "10 minutes", quiet: str = "2 minutes", delay: str = "0 seconds") -> DataFrame:
    """Slices that late rows made dirty: (org, mode, slice_start, late_rows, last_ingested), each told once nothing more has come for ``quiet``.

    A row (org, event_ts, ingested_at) is late if it came more than ``lateness`` after it happened: on the day it came
    its hour is dirty, later the whole day is. The clock is the latest ``ingested_at`` of all rows, less ``delay``; state
    and timers live in the checkpoint, a slice each, so that a restart forgets nothing and tells nothing twice. Sessions
    that run this need the RocksDB state store (``with_ledger_store``).
    """
    rows = raw.where("org is not null and event_ts is not null and ingested_at is not null").withWatermark("ingested_at", delay)
    late = rows.where(F.col("ingested_at") > F.col("event_ts") + F.expr(f"INTERVAL {lateness}"))
    today = F.to_date("event_ts") == F.to_date("ingested_at")
    marked = late.select("org", F.when(today, "hour").otherwise("day").alias("mode"), F.when(today, F.date_trunc("hour", "event_ts")).otherwise(F.date_trunc("day", "event_ts")).alias("slice_start"), "ingested_at", F.unix_millis("ingested_at").alias("ms"))
    quiet_ms = int(pd.Timedelta(quiet).total_seconds() * 1000)
    return marked.groupBy("org", "mode", "slice_start").transformWithStateInPandas(_Ledger(quiet_ms), LEDGER, "append", "eventTime")


def with_ledger_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def repair_ledger(raw: DataFrame, base: Callable[[list], DataFrame], build: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, **times: str) -> StreamingQuery:
    """Rebuilds of the slices that ``dirty_ledger`` tells: each hour of them is computed again from ``base`` and overwrites its partition, as in ``repair_slices``."""

    def write(batch: DataFrame, n: int) -> None:
        # A day has twenty-four hours, of which those without rows are left out below.
        hours = F.when(F.col("mode") == "hour", F.array("slice_start")).otherwise(F.sequence("slice_start", F.col("slice_start") + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR")))
        _rebuild(batch.select("org", F.explode(hours).alias("hour")).distinct(), base, build, table)

    return dirty_ledger(raw, **times).writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


STATE = "started_ms long, last_ms long, rows long, samples long, fps_sum double, swaps long"


def session_state(rows: DataFrame, idle: str = "6 hours", lateness: str = "10 minutes") -> DataFrame:
    """The running state of each session, told anew whenever it changes, and dropped when the watermark has passed its last row by ``idle``."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        started, last, n, samples, fps, swaps = state.get if state.exists else (None, 0, 0, 0, 0.0, 0)
        for f in frames:
            stamps = f["ms"]
            first = stamps[f["event_subtype"] == "gateway_receive_stream_request"]
            if len(first):
                started = int(first.min()) if started is None else min(started, int(first.min()))
            status = f["family"] == "ai_stream_status"
            last, n, samples = max(last, int(stamps.max())), n + len(f), samples + int(status.sum())
            fps += float(f.loc[status, "output_fps"].sum())
            swaps += int((f["event_subtype"] == "orchestrator_swap").sum())
        state.update((started, last, n, samples, fps, swaps))
        state.setTimeoutTimestamp(max(last + idle_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([[*key, started, last, n, samples, fps, swaps]], columns=["org", "session_key", *(c.split()[0] for c in STATE.split(", "))])

    kept = rows.withColumn("ms", F.unix_millis("event_ts")).withWatermark("event_ts", lateness)
    kept = kept.select("org", "session_key", "event_ts", "ms", "family", "event_subtype", "output_fps")
    return kept.groupBy("org", "session_key").applyInPandasWithState(update, f"org string, session_key string, {STATE}", STATE, "update", GroupStateTimeout.EventTimeTimeout)


def repair_dimensions(snapshots: DataFrame, selections: Callable[[date], DataFrame], history: Callable[[DataFrame], DataFrame], table: str, checkpoint: str) -> StreamingQuery:
    """Snapshots (org, ident, event_ts) that come late: the selections that they touch are attributed again, each batch to a folder of its own with its number; ``read_decisions`` takes the newest of each selection.

    ``selections`` gets the first day that the batch may touch and ``history`` its identities, so that tables stored by
    day or identity are read for those alone.
    """

    def write(batch: DataFrame, n: int) -> None:
        first = batch.agg(F.min("event_ts")).first()[0]
        if first is None:
            return
        idents = batch.select("org", "ident").distinct()
        since = selections((first - timedelta(seconds=30)).date()).withColumn("selection_ts", F.col("ts"))
        touched = changes.touched_by_snapshots(since, batch, ["org", "ident"]).drop("selection_ts")
        asof.attribute(touched, history(idents)).withColumn("run", F.lit(n)).write.mode("overwrite").parquet(f"{table}/batch={n}")

    return snapshots.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_decisions(spark: SparkSession, table: str) -> DataFrame:
    rows = spark.read.parquet(table).drop("batch")
    return latest.latest_rows(rows, ["selection_id"], [F.desc("run")]).drop("run")
