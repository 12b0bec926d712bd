"""Toxicity: boosted trees over dense features of whole texts, with isotonic calibration.

Features: densities of a lexicon, nearness of second-person words to its hits, capitals, punctuation and
obfuscation rates. The lexicon is a short list of fixed words and what a bounded sample of labelled rows
adds: words and word beginnings that toxic rows hold far more often than others, counted by Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boost
from tidemark.llm.common import documents, labelled, map_batches

# Common insults, and second-person words of the languages at hand.
INSULTS = "idiot moron stupid loser trash scum pathetic worthless disgusting clown dumb fool imbecile garbage filth vermin".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre vos usted ustedes vosotros".split()
#: Characters that stand for letters in disguised words.
LEET = bytes.maketrans(b"013457@$", b"oieastas")
PREFIXES = (4, 5, 6, 7)
NEAR = 5

_SPLIT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())
_LETTER = np.array([97 <= c < 123 for c in range(256)])
_DISGUISE = np.array([chr(c) in "0123456789@$*" for c in range(256)])
_GAP = np.array([chr(c) in " .-*" for c in range(256)])


def words_of(text: str | None) -> list[str]:
    """Words in lower case (letters A-Z only): runs of ASCII letters or digits and of other characters, their UTF-8 bytes as Latin-1."""
    return [w.decode("latin-1") for w in (text or "").encode("utf-8", "replace").lower().translate(_SPLIT).split()]


def obfuscation(low: bytes) -> tuple[int, int, int]:
    """Places where disguises stand inside a word, where single letters are spaced out, and where a letter stands three times."""
    x = np.frombuffer(low, np.uint8)
    if len(x) < 8:
        return 0, 0, 0
    a, d, g = _LETTER[x], _DISGUISE[x], _GAP[x]
    mixed = np.count_nonzero(a[:-3] & d[1:-2] & (a[2:-1] | d[2:-1] & a[3:]))
    pair = a[:-1] & g[1:]
    spaced = np.count_nonzero(pair[:-5] & pair[2:-3] & pair[4:-1] & a[6:])
    same = x[1:] == x[:-1]
    return mixed, spaced, np.count_nonzero(same[1:] & same[:-1] & a[2:])


def units_of(words: set[str]) -> set[str]:
    """What the lexicon may hold of these words: words as ``w`` and beginnings as ``w~``."""
    out = set(words)
    for w in words:
        out.update(w[:k] + "~" for k in PREFIXES if len(w) >= k)
    return out


@dataclass
class Lexicon:
    """Words and beginnings (``w~``) with their weights (log odds)."""

    weights: dict[str, float]

    def __post_init__(self):
        self.words = {w.encode("latin-1"): v for w, v in self.weights.items() if not w.endswith("~")}
        self.stems = {w[:-1].encode("latin-1"): v for w, v in self.weights.items() if w.endswith("~")}
        self.gate = {w[:4] for w in [*self.words, *self.stems]}

    def hits(self, words: set[bytes]) -> dict[bytes, float]:
        """Those of the words that it holds, with the largest weight that applies."""
        gate = self.gate
        found = {w: max([self.words.get(w, 0.0), *(self.stems.get(w[:k], 0.0) for k in PREFIXES)]) for w in words if w[:4] in gate}
        return {w: v for w, v in found.items() if v > 0}


N_FEATURES = 16


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Dense features of one whole text; all 0 for null and empty ones."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return [0.0] * N_FEATURES
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, letters = len(raw), max(1, int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()))
    low = raw.lower()
    words = low.translate(_SPLIT).split()
    n_words = max(1, len(words))
    distinct = set(words)
    hits = lexicon.hits(distinct)
    mixed, spaced, stretched = obfuscation(low)
    hidden = len(lexicon.hits(set(low.translate(LEET).translate(_SPLIT).split()) - distinct)) if mixed else 0
    total = near = 0
    if hits:
        at = [i for i, w in enumerate(words) if w in hits]
        total = len(at)
        near = sum(any(x in _SECOND for x in words[max(0, i - NEAR) : i + NEAR + 1]) for i in at)
    top = sorted(hits.values(), reverse=True)[:2] + [0.0, 0.0]
    return [
        total / n_words, math.log1p(total), top[0], top[1], float(len(hits)), sum(hits.values()), near / n_words, float(near), float(hidden),
        counts[65:91].sum() / letters, (n - letters - counts[48:58].sum() - counts[9:14].sum() - counts[32]) / n, counts[33] / n,
        mixed / n_words, spaced / n_words, stretched / n_words, math.log1p(n_words),
    ]


_SECOND = {w.encode() for w in SECOND_PERSON}


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: boost.TreeEnsemble
    calibration: tuple[np.ndarray, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.margin(x), *self.calibration)


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", max_rows: int = 20_000, max_units: int = 400, min_rows: int = 8) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled rows, taken in the order of a hash of their id.

    A unit enters the lexicon if at least ``min_rows`` toxic rows of the sample hold it and its smoothed odds
    there are twenty times those in other rows; of those, the ``max_units`` of largest evidence. Four fifths of
    the sample fit the trees, the rest calibrates them. Rows with null labels are no labelled rows. Without
    labels of both kinds, scores are the smoothed base rate.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = labelled(documents(docs), sample)  # at most max_rows rows

    def units(batch: pa.RecordBatch) -> pa.RecordBatch:
        label, unit = [], []
        for text, y in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            own = units_of(set(words_of(text)))
            own.add("")
            unit.extend(own)
            label.extend([y] * len(own))
        return pa.record_batch([pa.array(unit), pa.array(label, pa.int32())], ["unit", "label"])

    seen = map_batches(rows.select("text", "label"), units, "unit string, label int")
    seen = seen.groupBy("unit").agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0"))
    total = seen.where("unit = ''").first()
    weights = {w: 3.0 for w in INSULTS} | {w + "~": 3.0 for w in INSULTS if len(w) in PREFIXES}
    if total and total.n1 and total.n0:
        odds = F.log((F.col("n1") + 0.5) / (total.n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (total.n0 + 1.0))
        found = seen.where((F.col("unit") != "") & (F.col("n1") >= min_rows)).withColumn("odds", odds).where(F.col("odds") >= math.log(20))
        for r in found.orderBy(F.desc(F.col("odds") * F.sqrt("n1")), "unit").limit(max_units).collect():
            weights[r.unit] = max(weights.get(r.unit, 0.0), float(r.odds))
    lexicon = Lexicon(weights)
    data = feature_rows(rows, lexicon, ["label"]).toPandas()  # at most max_rows rows of dense features
    data = data.sort_values(["doc_id", "label"], kind="stable")
    x = np.array(data["x"].tolist(), float).reshape(len(data), N_FEATURES)
    y = data["label"].to_numpy(float)
    fold = np.arange(len(y)) % 5 == 4
    trees = boost.fit_trees(x[~fold], y[~fold])
    return ToxicityModel(lexicon, trees, boost.fit_isotonic(trees.margin(x[fold]), y[fold]))


def feature_rows(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [features(t, lexicon) for t in batch["text"].to_pylist()]
        return pa.record_batch([batch["doc_id"], *(batch[c] for c in keep), pa.array(x, pa.list_(pa.float64()))], ["doc_id", *keep, "x"])

    kinds = dict(docs.dtypes)
    return map_batches(docs.select("doc_id", "text", *keep), run, ", ".join(["doc_id long", *(f"{c} {kinds[c]}" for c in keep), "x array<double>"]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row. Null and empty texts get the score of a text without any sign; rows with the same text get the same score; null ids stay null."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([features(t, model.lexicon) for t in batch["text"].to_pylist()], float)
        return pa.record_batch([batch["doc_id"], pa.array(np.clip(model.score(x), 0.0, 1.0))], ["doc_id", "score"])

    return map_batches(documents(docs), run, "doc_id long, score double")


def scored(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of their ``text`` in ``column``, in one pass without a join."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([features(t, model.lexicon) for t in batch["text"].to_pylist()], float)
        return pa.record_batch([*batch.columns, pa.array(np.clip(model.score(x), 0.0, 1.0))], [*batch.schema.names, column])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, run, f"{schema}, `{column}` double")
