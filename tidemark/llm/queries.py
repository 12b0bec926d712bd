"""The registered queries of the operators: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_model, licenses, manifest, naming, neardup, packing, quality, repeats, sketch, tokenfile, toxicity, whitening
from tidemark.llm.common import TOKENIZER, read


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(divisor: int, remainder: int):
    """Whether crc32 of the id's text leaves this remainder; null ids are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == remainder, F.lit(False))


def _scored(rows: DataFrame, divisor: int, remainder: int) -> DataFrame:
    return rows.select("doc_id", held_out(divisor, remainder).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return _scored(quality.score(docs, quality.fit(docs, labels.where(~held_out(3, 1)))), 3, 1)


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(read(spark, sf_dir, "documents"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s.exact)
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")
    starts = F.transform(base, lambda s: s.first_word)
    return licenses.scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"), "score", F.transform("spans", lambda s: F.struct(s.label.alias("label"), s.first_word.alias("first_word"), s.last_word.alias("last_word"), s.edits.alias("edits"))).alias("spans"),
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(read(spark, sf_dir, "documents"), k=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept", "class_id")


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(read(spark, sf_dir, "documents"), order=3)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return _scored(toxicity.score(docs, toxicity.fit(docs, labels.where(~held_out(5, 0)))), 5, 0)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.keep_one(read(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(read(spark, sf_dir, "documents"), F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False)))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(read(spark, sf_dir, "embeddings"))


def licenses_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op4_licenses`` that its exact phrases alone decide, for comparison with SQL."""
    return op4_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def fingerprint_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact columns of ``op2_fingerprint``, for comparison with SQL."""
    return op2_fingerprint(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


QUERIES = {f.__name__: f for f in (licenses_base, fingerprint_texts, op1_quality, op2_fingerprint, op3_pack, op4_licenses, op5_minhash, op6_lm_scores, op7_toxicity, op8_token_files, op9_decontaminate, op10_suffix_dedup, op11_block_naming, op12_manifest, op13_whitening)}
#: DuckDB SQL by query, where SQL can express it and ends on whole tables.
ORACLE_SQL: dict[str, str] = {
    "op5_minhash": r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s FROM w),
c AS (SELECT s, min(doc_id) AS class_id, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
u AS (SELECT class_id, n, unnest(s) AS x FROM c),
l AS (SELECT a.class_id AS a, b.class_id AS b FROM u a JOIN u b ON a.x = b.x AND a.class_id < b.class_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.class_id, b.class_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT class_id AS node, class_id AS root FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
m AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id, coalesce(m.component_id, s.doc_id) = s.doc_id AS kept, c.class_id FROM s LEFT JOIN c ON c.s = s.s LEFT JOIN m ON m.node = c.class_id""",
    "op11_block_naming": r"""WITH c AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM c WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r""",
    "licenses_base": r"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n, list_filter(range(0, len(w)), lambda i: w[i + 1:i + 4] = ['under', 'the', 'mit', 'license']) AS m, list_filter(range(0, len(w)), lambda i: w[i + 1:i + 4] = ['apache', 'license', 'version', '2']) AS a, list_filter(range(0, len(w)), lambda i: w[i + 1:i + 3] = ['cc', 'by', 'nc']) AS c FROM w)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(m) + len(a) + len(c) AS BIGINT) AS n_base, least(list_min(m), list_min(a), list_min(c)) AS first_word, greatest(list_max(m), list_max(a), list_max(c)) AS last_word, concat_ws(',', CASE WHEN len(a) > 0 THEN 'apache-2' END, CASE WHEN len(c) > 0 THEN 'cc-by-nc' END, CASE WHEN len(m) > 0 THEN 'mit' END) AS base_labels FROM p""",
    "fingerprint_texts": r"""WITH n AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS u FROM documents)
SELECT doc_id, length(t) AS n_chars, sha256(left(t, length(t) - length(t) // 2) || left(u, length(t) // 2)) AS edited_sha256 FROM n""",
}
