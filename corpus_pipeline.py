"""A corpus from ``documents``: five stages, each stored before the next, the last of which packs what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, neardup, packing, repeats, toxicity
from tidemark.llm.common import read, settle
from tidemark.llm.queries import held_out, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. The model is fitted on the labelled rows of the input that aren't held out.

    Each row is judged by itself: null and empty texts score as texts without any sign and stay, equal texts share their
    fate, rows of one id don't. Null ids stay. Other columns than those of documents are left out. No rows give no rows.
    """
    docs = docs.select(COLUMNS)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").where(~held_out(5, 0)))
    return toxicity.scored(docs, model, "toxic_score").where("toxic_score < 0.5").select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingles of five words, similarity 0.8 or more) the smallest id stays.

    Documents without words stay, as do null ids. Rows of one id are one node: all stay or all go.
    """
    docs = docs.select(COLUMNS)
    gone = neardup.groups(docs, k=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(settle(gone, "copies"), "doc_id", "left_anti").select(COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that a smaller id has go; characters cut in their middle go whole, and documents of which nothing is left go.

    Null and empty texts and null ids stay as they are; rows of one id don't count for each other.
    """
    kept = repeats.remove_repeats(docs.select(COLUMNS), keep=["lang", "source"])
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return kept.withColumn("_t", text).where("n_removed = 0 or length(_t) > 0").select("doc_id", F.col("_t").alias("text"), "lang", "source", F.length("_t").cast("long").alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, with all rows of their id. Null and empty texts and null ids stay."""
    docs = docs.select(COLUMNS)
    hits = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(settle(hits, "leaks"), "doc_id", "left_anti").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their places in sequences. A null or empty text is one piece of the end id; repeated rows and null ids are packed each."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", without_toxic), ("near duplicates", one_of_each_group), ("repeated passages", without_repeats), ("benchmark", without_benchmark), ("packing", packed)]
#: SQL expresses no stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored in the shared folder and read again. An empty table gives no rows."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
