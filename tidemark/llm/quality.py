"""Quality: a generalised additive model with pairwise interactions over surface features of whole texts.

Cyclic boosted shallow trees learn a lookup table for each feature and for a few pairs; a text's score is the
sum of the entries of its bins. Nothing but the text is an input of a score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boost
from tidemark.llm.common import documents, labelled, map_batches

FEATURES = (
    "log_bytes", "log_words", "mean_word", "long_words", "short_words", "distinct_words", "top_word", "capitals", "capital_words",
    "digits", "sentence_ends", "commas", "pipes", "exclamations", "symbols", "other_bytes", "lines_per_word", "repeated_lines", "bullet_lines", "edge_symbols",
)
_ALNUM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def features(text: str | None) -> list[float]:
    """Surface features of one whole text; all 0 for null and empty ones."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, n_words = len(raw), len(words)
    letters = max(1, int(c[65:91].sum() + c[97:123].sum() + c[128:].sum()))
    sizes = np.fromiter(map(len, words), np.int64, n_words)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x]
    symbols = int(c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum())
    return [
        math.log1p(n), math.log1p(n_words), float(sizes.mean()), float((sizes > 12).mean()), float((sizes < 4).mean()), len(seen) / n_words, max(seen.values()) / n_words,
        c[65:91].sum() / letters, sum(map(bytes.isupper, words)) / n_words, c[48:58].sum() / n, (c[46] + c[63]) / n_words, c[44] / n_words, c[124] / n_words, c[33] / n_words,
        (symbols - c[46] - c[44]) / n, float(c[128:].sum()) / n, len(lines) / n_words, 1 - len(set(lines)) / len(lines),
        sum(x[:1] in b"-*#>|" for x in lines) / len(lines), float((~_ALNUM[np.fromiter((w[-1] for w in words), np.uint8, n_words)]).mean()),
    ]


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", max_rows: int = 20_000) -> boost.AdditiveModel:
    """Fit on at most ``max_rows`` labelled rows, taken in the order of a hash of their id.

    Rows with null labels or ids are no labelled rows, and of an id that stands more than once one row counts. Without
    labels of both kinds, as with an empty table on either side, scores are the smoothed base rate. Only id, text and
    label are read: other columns may have any names.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [features(t) for t in batch["text"].to_pylist()]
        return pa.record_batch([batch["doc_id"], batch["label"], pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    rows = labelled(documents(docs), sample)  # at most max_rows rows
    data = map_batches(rows, run, "doc_id long, label int, x array<double>").toPandas().sort_values(["doc_id", "label"], kind="stable")
    return boost.fit_additive(np.array(data["x"].tolist(), float).reshape(len(data), len(FEATURES)), data["label"].to_numpy(float))


def score(docs: DataFrame, model: boost.AdditiveModel) -> DataFrame:
    """(doc_id, score) of every row. Null and empty texts are scored as texts without words; equal texts get equal scores; null ids stay null."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([features(t) for t in batch["text"].to_pylist()], float)
        return pa.record_batch([batch["doc_id"], pa.array(model.score(x))], ["doc_id", "score"])

    return map_batches(documents(docs), run, "doc_id long, score double")
