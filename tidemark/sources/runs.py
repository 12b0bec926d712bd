"""Tables of runs: rows are written first, then a manifest that commits them; readers take committed runs alone.

A run owns slices (say org and hour). The newest committed run of a slice holds its rows, also if it has none there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.operators import quality


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; it goes when the application ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def _digest(columns: list[str]) -> Column:
    """Order-independent checksum of rows, in which rows that stand twice don't cancel out."""
    return F.sum(F.xxhash64(*(F.col(c).cast("string") for c in sorted(columns)), *(F.col(c).isNull() for c in sorted(columns))).cast("decimal(38,0)")).cast("string")


def write_rows(df: DataFrame, table: str, run_id: str, now: Column, slices: list[str], contract: quality.Contract | None = None) -> dict[str, int | str]:
    """The first phase: a run's rows, which no reader sees yet. Written again under its id, a run replaces what is there.

    Returns what the writing job itself counted: ``n_rows``, ``checksum`` and the violations of ``contract``.
    """
    counted, own = Observation(), sorted(c for c in df.columns)
    metrics = [F.count("*").alias("n_rows"), _digest(own).alias("checksum"), *(contract.metrics() if contract else [])]
    watched = df.observe(counted, *metrics)
    watched.withColumns({"refresh_run_id": F.lit(run_id), "refreshed_at": now}).write.mode("overwrite").partitionBy(*slices).parquet(f"{table}/rows/run=r-{run_id}")
    return counted.get


def _typed(spark: SparkSession, paths: list[str], base: str, known: DataFrame, slices: list[str]) -> DataFrame:
    """Stored rows with the slices' own types: names of folders say nothing of them, a text of digits looks like a number there."""
    reader = spark.read.option("basePath", base)
    kinds = {f.name: known.schema[f.name].dataType for f in known.schema if f.name in slices}
    return reader.schema(StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in reader.parquet(*paths).schema])).parquet(*paths)


def commit_run(spark: SparkSession, table: str, run_id: str, now: Column, slices: list[str], columns: list[str], owned: DataFrame, counted: dict[str, int | str]) -> None:
    """The second phase: the manifest, one file, with rows and checksum of each slice that the run owns.

    What lies in the folder is read back and must add up to what the writing job counted, else ``ValueError``.
    """
    if int(counted["n_rows"]):
        stored = _typed(spark, [f"{table}/rows/run=r-{run_id}"], f"{table}/rows/run=r-{run_id}", owned, slices)
        per = stored.groupBy(*slices).agg(F.count("*").alias("n_rows"), _digest(columns).alias("artifact_checksum"))
    else:
        per = owned.select(*slices).limit(0).select(*slices, F.lit(0).cast("long").alias("n_rows"), F.lit("").alias("artifact_checksum"))
    whole = owned.select(*slices).distinct().join(per, slices, "full").fillna({"n_rows": 0, "artifact_checksum": "0"})
    manifest = whole.withColumns({"run": F.lit(f"r-{run_id}"), "refresh_run_id": F.lit(run_id), "refreshed_at": now}).coalesce(1)
    total = Observation()
    path = f"{table}/pending/run=r-{run_id}"
    manifest.observe(total, F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("artifact_checksum").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum")).write.mode("overwrite").parquet(path)
    if total.get["n"] != counted["n_rows"] or total.get["sum"] != (counted["checksum"] or "0"):
        raise ValueError(f"run {run_id}: {total.get} stored, {counted} written")
    files = spark._jvm.org.apache.hadoop.fs
    source, target = files.Path(path), files.Path(f"{table}/runs/{path.rsplit('/', 1)[1]}")
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    system.delete(target, True)
    if not system.rename(source, target):  # one step: a reader sees all of the manifest or nothing
        raise OSError(f"can't commit {target}")


def write_run(df: DataFrame, table: str, run_id: str, now: Column, slices: list[str], *, owned: DataFrame | None = None, contract: quality.Contract | None = None) -> dict[str, int | str]:
    """Both phases. ``owned`` are the slices that the run stands for, those of its rows unless given; slices mustn't be null.

    Returns the metrics of the writing job. A run that is written again, after a failure in either phase or for a
    correction, replaces itself.
    """
    counted = write_rows(df, table, run_id, now, slices, contract)
    own = df if owned is None else owned
    commit_run(df.sparkSession, table, run_id, now, slices, df.columns, own, counted)
    return counted


def manifests(spark: SparkSession, table: str) -> DataFrame:
    """A row for each committed run and slice."""
    return spark.read.parquet(*_committed(spark, table))


def _committed(spark: SparkSession, table: str) -> list[str]:
    files = spark._jvm.org.apache.hadoop.fs
    found = files.Path(f"{table}/runs").getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files.Path(f"{table}/runs/run=*"))
    return [str(f.getPath()) for f in found or []]


def read_runs(spark: SparkSession, table: str, slices: list[str]) -> DataFrame:
    """The rows of the newest committed run of each slice, with ``artifact_checksum`` of the slice. Only folders of these runs are read."""
    known = manifests(spark, table)
    newest = known.groupBy(*slices).agg(F.max(F.struct("refreshed_at", "run", "artifact_checksum", "n_rows")).alias("m")).select(*slices, "m.run", "m.artifact_checksum", "m.n_rows").where("n_rows > 0").drop("n_rows")
    runs = sorted(r.run for r in newest.select("run").distinct().collect())  # a row for each run that still holds slices
    if not runs:
        raise ValueError(f"{table} has no committed rows")
    rows = _typed(spark, [f"{table}/rows/run={r}" for r in runs], f"{table}/rows", known, slices)
    return rows.join(newest, [*slices, "run"]).drop("run")


def broken_slices(spark: SparkSession, table: str, slices: list[str]) -> DataFrame:
    """Slices of committed runs whose stored rows aren't those of the manifest any more."""
    current, kept = read_runs(spark, table, slices), {"artifact_checksum", "refresh_run_id", "refreshed_at"}
    own = [c for c in current.columns if c not in kept]
    now = current.groupBy(*slices, "refresh_run_id").agg(F.first("artifact_checksum").alias("expected"), _digest(own).alias("found"))
    return now.where("expected <> found")
