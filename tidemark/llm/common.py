"""Small helpers that the operators share: reading, shared scratch tables, Arrow maps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tokenizer file name, resolved by ``public_tokenizers``; a parameter of the operators.
TOKENIZER = "byte_bpe_50k.json"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Python workers started from another folder find this package too; where it is installed, that changes nothing.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    # Whole texts travel in batches: smaller ones than Spark's default of 10,000 rows keep Python workers small.
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the operators read, so that extra columns can't clash with theirs."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


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


def labelled(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label): one row for each id of a sample of labels of known size, however often the id stands in ``docs``; of several texts the one of the smallest hash."""
    rows = docs.join(F.broadcast(sample), "doc_id")
    first = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("m"))
    return first.select("doc_id", "m.text", "m.label")


#: Spark removes the shuffle files of a query when it ends, instead of when the driver collects its garbage.
_CLEANS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends and lost executors lose nothing."""
    spark = df.sparkSession
    path, before = scratch(spark, name), spark.conf.get(_CLEANS, "false")
    spark.conf.set(_CLEANS, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANS, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables of ``settle`` of which all that was made is stored itself."""
    for df in stored:
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` of a function from one batch to at most one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI or a local path; called in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/", 1)[0] else (fs.LocalFileSystem(), uri)
