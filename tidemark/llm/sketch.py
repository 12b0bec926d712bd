"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph is a line, long ones cut after every ``WORDS`` words; the same paragraph again counts as another
(numbered by occurrence). Its 64-bit digest goes into three cells of a sketch, one in each third: a count, an
exclusive-or of digests and one of check sums. Sketches of two versions subtract cell by cell, and peeling (cells
that hold one digest, again and again) recovers the digests in which they differ. A place in a sketch of half the
size is the place here without its highest bit, so sketches of different sizes fold to a common one.

Two versions are compared in small sketches first; where peeling gets stuck, in larger ones. A stored fingerprint is as
large as it takes to be peeled by itself (again the next size after a failure), so likenesses can be computed from
stored fingerprints alone. Work is done for a batch of documents at once.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, shuffle_partitions

#: Words of a paragraph, cells of the smallest third of a sketch, hashes.
WORDS, THIRD, HASHES = 8, 8, 3
CELLS = HASHES * THIRD
#: Cells of the sketches that are peeled together.
TOGETHER = 1 << 19
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_CHECK = np.uint64(0xD6E8FEB86659FD93)


def digests(text: str) -> np.ndarray:
    """A digest for each paragraph, all different, sorted."""
    seen: dict[str, int] = {}
    out = []
    digest = xxhash.xxh64_intdigest
    for line in text.split("\n"):
        words = line.split(" ")
        for part in [" ".join(words[i : i + WORDS]) for i in range(0, len(words), WORDS)] if len(words) > WORDS else (line,):
            if part:
                k = seen.get(part, 0)
                seen[part] = k + 1
                out.append(digest(part, k))
    return np.unique(np.array(out, np.uint64))


def _cells(d: np.ndarray, third: int) -> np.ndarray:
    """One cell in each third of the sketch for each digest."""
    return np.stack([((d * m) >> np.uint64(33)) & np.uint64(third - 1) for m in _MIX]).astype(np.int64) + third * np.arange(HASHES)[:, None]


def _check(d: np.ndarray) -> np.ndarray:
    x = (d ^ (d >> np.uint64(29))) * _CHECK
    return x >> np.uint64(32)


class Sets:
    """Digests of many documents in a row."""

    def __init__(self, each: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in each], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.values = np.concatenate([np.empty(0, np.uint64), *each])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``which``, digest) of the chosen documents."""
        n = self.sizes[which]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.starts[which], n)
        return np.repeat(np.arange(len(which)), n), self.values[at]


def build(owner: np.ndarray, d: np.ndarray, n: int, third: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, digests and check sums of the cells of n sketches, one after another."""
    size = HASHES * third
    at = (_cells(d, third) + owner * size).ravel()
    counts = np.bincount(at, minlength=n * size).astype(np.int64)
    keys, checks = np.zeros(n * size, np.uint64), np.zeros(n * size, np.uint64)
    np.bitwise_xor.at(keys, at, np.tile(d, HASHES))
    np.bitwise_xor.at(checks, at, np.tile(_check(d), HASHES))
    return counts, keys, checks


def subtract(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]


def peel(sketches: tuple, n: int, third: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From n subtracted sketches: (number of the sketch, digest, 1 or -1 for the side that has it), and which sketches got stuck."""
    counts, keys, checks = (x.copy() for x in sketches)
    size = HASHES * third
    found: list[tuple] = []
    look = np.flatnonzero(counts)
    for _ in range(size):
        pure = look[(np.abs(counts[look]) == 1) & (_check(keys[look]) == checks[look])]
        if not len(pure):
            break
        owner, d, sign = pure // size, keys[pure], counts[pure]
        order = np.lexsort((d, owner))
        owner, d, sign = owner[order], d[order], sign[order]
        first = np.r_[True, (owner[1:] != owner[:-1]) | (d[1:] != d[:-1])]
        owner, d, sign = owner[first], d[first], sign[first]
        found.append((owner, d, sign))
        at = (_cells(d, third) + owner * size).ravel()
        np.subtract.at(counts, at, np.tile(sign, HASHES))
        np.bitwise_xor.at(keys, at, np.tile(d, HASHES))
        np.bitwise_xor.at(checks, at, np.tile(_check(d), HASHES))
        look = np.unique(at)
    stuck = ((counts != 0) | (keys != 0) | (checks != 0)).reshape(n, size).any(1) if n else np.zeros(0, bool)
    owner, d, sign = (np.concatenate([np.empty(0, t), *x]) for t, x in zip((np.int64, np.uint64, np.int64), zip(*found, strict=True) if found else ((), (), ()), strict=True))
    whole = ~stuck[owner]
    return owner[whole], d[whole], sign[whole], stuck


def _together(which: np.ndarray, third: int) -> list[np.ndarray]:
    step = max(1, TOGETHER // (HASHES * third))
    return [which[i : i + step] for i in range(0, len(which), step)]


def likenesses(sets: Sets, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared paragraphs over all paragraphs of each pair of documents, by the recovered difference; 1 for two texts without any."""
    only_a, only_b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    left, third = np.arange(len(a)), THIRD
    while len(left):
        # A difference is at least as large as the sizes differ; smaller sketches can't hold it.
        fits = np.abs(sets.sizes[a[left]] - sets.sizes[b[left]]) <= HASHES * third
        again = [left[~fits]]
        for part in _together(left[fits], third):
            n = len(part)
            owner, _, sign, stuck = peel(subtract(build(*sets.take(a[part]), n, third), build(*sets.take(b[part]), n, third)), n, third)
            only_a[part] += np.bincount(owner[sign > 0], minlength=n)
            only_b[part] += np.bincount(owner[sign < 0], minlength=n)
            again.append(part[stuck])
        left, third = np.concatenate(again), third * 4
    union = sets.sizes[a] + only_b
    return np.where(union > 0, (sets.sizes[a] - only_a) / np.maximum(union, 1), 1.0)


def difference(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The digests that only a and only b has, and the cells that it took."""
    third = THIRD
    while True:
        sketches = subtract(*(build(np.zeros(len(d), np.int64), d, 1, third) for d in (a, b)))
        _, d, sign, stuck = peel(sketches, 1, third)
        if not stuck[0]:
            return d[sign > 0], d[sign < 0], HASHES * third
        third *= 4


def fingerprints_of(sets: Sets) -> list[str]:
    """Number of paragraphs, third of the sketch and its cells in base64; the size is the first from half the paragraphs on at which the sketch can be peeled by itself."""
    out: list[str] = [""] * len(sets.sizes)
    thirds = THIRD << np.ceil(np.log2(np.maximum(1, sets.sizes / (2 * THIRD)))).astype(np.int64)
    while (left := np.flatnonzero(thirds > 0)).size:
        third = int(thirds[left].min())
        for part in _together(left[thirds[left] == third], third):
            made = build(*sets.take(part), len(part), third)
            stuck = peel(made, len(part), third)[3]
            counts, keys, checks = (x.reshape(len(part), -1) for x in made)
            for k in np.flatnonzero(~stuck):
                body = struct.pack("<II", sets.sizes[part[k]], third) + counts[k].astype("<u1").tobytes() + keys[k].astype("<u8").tobytes() + checks[k].astype("<u4").tobytes()
                out[part[k]] = base64.b64encode(body).decode()
            thirds[part] = np.where(stuck, 2 * third, 0)
    return out


def _stored(fingerprint: str) -> tuple[int, int, tuple]:
    raw = base64.b64decode(fingerprint)
    n, third = struct.unpack("<II", raw[:8])
    size = HASHES * third
    at = np.cumsum([8, size, 8 * size])
    return n, third, (np.frombuffer(raw[at[0] : at[1]], "<i1").astype(np.int64), np.frombuffer(raw[at[1] : at[2]], "<u8"), np.frombuffer(raw[at[2] :], "<u4").astype(np.uint64))


def _folded(sketch: tuple, third: int, to: int) -> tuple:
    counts, keys, checks = (x.reshape(HASHES, third // to, to) for x in sketch)
    return counts.sum(1).ravel(), np.bitwise_xor.reduce(keys, 1).ravel(), np.bitwise_xor.reduce(checks, 1).ravel()


def _wrapped(sketch: tuple) -> tuple:
    """Counts are stored modulo 256."""
    return (sketch[0].astype(np.int8).astype(np.int64), *sketch[1:])


def stored_likeness(a: str, b: str) -> float:
    """The likeness of two stored fingerprints: folded, subtracted and peeled, in larger sketches after a failure; at last each is peeled by itself."""
    (n, third_a, one), (m, third_b, two) = _stored(a), _stored(b)
    to, most = THIRD, min(third_a, third_b)
    while to <= most:
        _, _, sign, stuck = peel(_wrapped(subtract(_folded(one, third_a, to), _folded(two, third_b, to))), 1, to)
        if not stuck[0]:
            only = int((sign < 0).sum())
            return 1.0 if not n + only else (n - int((sign > 0).sum())) / (n + only)
        to *= 4 if to * 4 <= most or to == most else most // to
    sets = [peel(_wrapped(x), 1, third)[1] for x, third in ((one, third_a), (two, third_b))]
    both = len(np.intersect1d(*sets))
    return both / (n + m - both)


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in blocks of ids, sorted by falling id, with the first row of what follows each block.

    Columns: doc_id, text, _block, _own (false for the row that only closes a block). Blocks are cut at quantiles
    of the ids; the number of blocks and the largest id of each go to the driver, nothing else.
    """
    spark = docs.sparkSession
    n = 4 * shuffle_partitions(spark)  # several to a task: blocks are of uneven sizes
    cuts = sorted(set(docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []))
    # A row counts the cuts below its id: among every ``step``-th first, then among those that follow. Null ids are below all.
    step = max(1, math.isqrt(len(cuts)))
    coarse, groups = cuts[::step], [[], *(cuts[i : i + step] for i in range(0, len(cuts), step))]
    below = lambda values: F.size(F.filter(values, lambda c: c < F.col("doc_id")))
    literal = lambda x: F.array(*map(F.lit, x)).cast("array<long>")
    k = F.col("_k")
    placed = docs.withColumn("_k", below(literal(coarse))).withColumn("_block", F.when(F.col("doc_id").isNull(), -1).when(k == 0, 0).otherwise((k - 1) * step + below(F.element_at(F.array(*map(literal, groups)), k + 1))))
    tops = {r["_block"]: r.top for r in placed.groupBy("_block").agg(F.max("doc_id").alias("top")).collect()}  # a row for each block
    present = sorted(tops, reverse=True)
    closes = [(b, tops[b], present[i - 1]) for i, b in enumerate(present)]  # block, its first id, the block that its first row closes
    heads = spark.createDataFrame(closes, "_block int, _top long, _closes int")
    first = F.col("doc_id").eqNullSafe(F.col("_top"))
    here = F.struct(F.col("_block").alias("b"), F.lit(True).alias("own"))
    places = F.when(first, F.array(here, F.struct(F.col("_closes").alias("b"), F.lit(False).alias("own")))).otherwise(F.array(here))
    rows = placed.join(F.broadcast(heads), "_block").withColumn("_p", F.explode(places)).select("doc_id", "text", F.col("_p.b").alias("_block"), F.col("_p.own").alias("_own"), F.xxhash64("text").alias("_tie"))
    return rows.repartitionByRange(n // 4, "_block").sortWithinPartitions(F.col("_block"), F.desc("_own"), F.desc("doc_id"), "_tie").drop("_tie")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next smaller id, after the last the first; rows of one id follow each
    other in the order of a hash of their text, null ids come last. A single document is its own next. Null
    texts are empty ones. Equal texts have equal fingerprints.
    """
    rows = with_next(documents(docs, id_col, text_col))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = closed = None  # (id, text, digests) of the row that waits for its next one; the block that is closed
        for batch in batches:
            ids, lengths, texts, follows = [], [], [], []  # of rows whose next one is here: the edited texts, and the digests of both
            for doc, text, block, own in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "_block", "_own")), strict=True):
                if block == closed:
                    continue  # a block is closed by one row only
                text = text or ""
                d = digests(text)
                if held is not None:
                    ids.append(held[0]), lengths.append(len(held[1])), texts.append(edited(held[1], text)), follows.append((held[2], d))
                held = (doc, text, d) if own else None
                closed = None if own else block
            if ids:
                n, own = len(ids), np.arange(len(ids))
                each = [x for x, _ in follows] + [digests(t) for t in texts]
                sets, prints = Sets(each + [x for _, x in follows]), fingerprints_of(Sets(each))
                sha = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts]
                columns = (ids, lengths, sha, prints[:n], prints[n:], likenesses(sets, own, own + n), likenesses(sets, own, own + 2 * n))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows.mapInArrow(run, schema)
