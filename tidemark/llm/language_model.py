"""Language-model scores: stupid backoff over counts of n-grams up to an order, left-one-out, summed by document.

A word given the ones before has the score (c(gram) - own) / c(gram without its last word), where own are the grams of
the document itself, for the longest gram that another document holds; each order less costs a factor ALPHA, and the
last resort is c(word) / N. A document follows a start word, with which grams may begin.

Documents are dealt into chunks by a hash of their ids. A chunk asks for each of its distinct grams once, with its own
count, whatever the number of its documents that hold it, and the hash of the gram names a bucket. A bucket adds up the
counts of each gram and answers every chunk, in the order asked, with what other chunks hold. So the occurrences of a
gram never meet: the most frequent one is a number for each chunk. The chunk, met with its answers, scores its documents.

The table of counts is so partitioned by hash, and chunks join it by partition; rows hold many grams, as one row for each
gram of each document would be several times the input (see the README for figures). A bucket and 48 more bits of the
hash name a gram; two grams of the same name would add up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle
from tidemark.llm.neardup import words

ALPHA = 0.4
#: Words are known by 48 bits of a hash; this one starts a document.
START = np.uint64((1 << 48) - 1)
#: Bytes of text a chunk and a bucket, and the fewest of either.
CHUNK, BUCKET, LEAST = 4 << 20, 6 << 20, 16


def _pack(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F))
    return (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


class _Hashes:
    def __init__(self):
        self.memo: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        ws, memo = words(text), self.memo
        if len(memo) > 500_000:
            memo.clear()
        hs = list(map(memo.get, ws))
        if None in hs:
            for i, h in enumerate(hs):
                if h is None:
                    hs[i] = memo[ws[i]] = xxhash.xxh3_64_intdigest(ws[i]) >> 16
        return np.array(hs, np.uint64)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.empty(0, np.int64)
    return first, np.diff(np.r_[first, len(x)])


class _Grams:
    """The words of a chunk in a row, each text after a start word, and the grams that end at each, by order."""

    def __init__(self, texts: list[str | None], order: int):
        hashes = _Hashes()
        each = [hashes(t) for t in texts]
        self.sizes = np.array([len(x) for x in each], np.int64)
        w = np.concatenate([np.r_[START, x] for x in each if len(x)] or [np.empty(0, np.uint64)])
        n = self.sizes[self.sizes > 0] + 1
        #: Place in the text; 0 is the start word.
        self.place = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
        with np.errstate(over="ignore"):
            self.by_order = [_mix(w, np.full(len(w), 1, np.uint64))]
            for m in range(2, order + 1):
                g = np.zeros(len(w), np.uint64)
                g[1:] = _mix(self.by_order[-1][:-1], w[1:]) + np.uint64(m)
                self.by_order.append(g)

    def distinct(self, m: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places with a gram of this order; the buckets, hashes and counts of distinct grams, sorted; and which one stands at each place."""
        at = np.flatnonzero(self.place >= m - 1)
        g = self.by_order[m - 1][at]
        b = (g & np.uint64(0xFFFF)) % np.uint64(buckets)
        # The bucket leads the key; 48 bits of the hash follow.
        key, which, n = np.unique((b << np.uint64(48)) | (g >> np.uint64(16)), return_inverse=True, return_counts=True)
        return at, key, which, n


def _cut(k: np.ndarray, fine: int) -> list[tuple[int, int, int]]:
    """(bucket, start, length) of the runs of sorted keys of one bucket and range of hashes."""
    bucket = k >> np.uint64(48)
    if fine > 1:
        bucket = bucket * np.uint64(fine) + (((k & np.uint64((1 << 48) - 1)) >> np.uint64(16)) * np.uint64(fine) >> np.uint64(32))
    return [(int(bucket[i]), int(i), int(size)) for i, size in zip(*_runs(bucket), strict=True)]


ASKED = "bucket int, chunk int, gram_order int, grams binary, counts binary, n_words long"
ANSWERED = "chunk int, bucket int, gram_order int, totals binary, n_words long"


def asked(docs: DataFrame, orders: int | list[int], buckets: int, fine: int = 1) -> DataFrame:
    """The distinct grams of an order, or of some, of each chunk with their counts, by bucket. Each of ``buckets`` is cut into ``fine`` ranges of hashes, which count as buckets."""
    orders = [orders] if isinstance(orders, int) else orders

    def run(key, table):
        grams, rows = _Grams(table["text"].to_pylist(), max(orders)), []
        for m in orders:
            _, k, _, n = grams.distinct(m, buckets)
            for b, i, size in _cut(k, fine):
                part = np.ascontiguousarray(np.frombuffer(_pack(k[i : i + size]), np.uint8).reshape(-1, 6).T)  # equal high bytes side by side are small when compressed
                rows.append((b, key[0].as_py(), m, part.tobytes(), n[i : i + size].astype("<u4").tobytes(), 0 if rows else int(grams.sizes.sum())))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in ASKED.split(", ")])

    return docs.groupBy("chunk").applyInArrow(run, ASKED)


def answered(asks: DataFrame) -> DataFrame:
    """For the grams of each chunk and bucket, in their order, the counts in other chunks; chunk -1 has the words of a bucket's rows."""

    def run(key, table):
        m = key[1].as_py()
        each = [_unpack(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(6, -1).T).tobytes()) for x in table["grams"].to_pylist()]
        own, which = np.unique(np.concatenate(each), return_inverse=True)
        n = np.concatenate([np.frombuffer(x, "<u4") for x in table["counts"].to_pylist()])
        totals = np.bincount(which, n, len(own)).astype("<i8")[which] - n
        cuts = np.cumsum([len(x) for x in each])[:-1]
        rows = [(-1, key[0].as_py(), m, b"", sum(table["n_words"].to_pylist()))]
        rows += [(c, key[0].as_py(), m, x.tobytes(), 0) for c, x in zip(table["chunk"].to_pylist(), np.split(totals, cuts), strict=True)]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in ANSWERED.split(", ")])

    return asks.groupBy("bucket", "gram_order").applyInArrow(run, ANSWERED)


def score(docs: DataFrame, *, order: int = 2, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score): one row for each id, natural logarithms, rounded to 6 places.

    Words are runs of other than ASCII white space, A-Z lower-cased; grams have up to ``order`` words. Rows of one id
    are one document, in which each row follows a start word; ids without words have 0 words, a sum of 0 and a null
    mean; null ids are left out. An empty table gives no rows.
    """
    docs = documents(docs, id_col, text_col).where("doc_id is not null")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A key has room for 2**16 buckets; beyond that each is cut into ranges, so that groups don't grow with the input.
    fine = -(-(n_bytes // bucket) // (1 << 16)) or 1
    buckets = max(LEAST, n_bytes // bucket // fine)
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(max(LEAST, n_bytes // chunk))).cast("int"))
    # The longest grams by themselves: the shuffle files of one part are gone before the next.
    parts = [list(range(1, order)), [order]] if order > 1 else [[1]]
    first, *rest = [settle(answered(asked(docs, part, buckets, fine)), "answers") for part in parts]
    answers = first.unionByName(*rest) if rest else first
    total = answers.where("chunk < 0 and gram_order = 1").agg(F.sum("n_words")).first()[0] or 0

    def run(key, texts, answers):
        ids, doc = np.unique(texts["doc_id"].to_numpy(), return_inverse=True)
        grams = _Grams(texts["text"].to_pylist(), order)
        n_words = np.bincount(doc, grams.sizes, len(ids)).astype(np.int64)
        d = np.repeat(doc[grams.sizes > 0], grams.sizes[grams.sizes > 0] + 1)
        known: dict[int, list[tuple[int, bytes]]] = {}
        for b, m, x in zip(*(answers[c].to_pylist() for c in ("bucket", "gram_order", "totals")), strict=True):
            known.setdefault(m, []).append((b, x))
        counts, own = [], []
        for m in range(1, order + 1):
            at, _, which, here = grams.distinct(m, buckets)
            totals = here + np.frombuffer(b"".join(x for _, x in sorted(known.get(m, []))), "<i8")
            c, mine = np.zeros(len(d), np.int64), np.zeros(len(d), np.int64)
            c[at] = totals[which]
            if m > 1:
                _, same, n = np.unique(which * len(ids) + d[at], return_inverse=True, return_counts=True)
                mine[at] = n[same]
            counts.append(c), own.append(mine)
        longest = np.minimum(order, grams.place + 1)
        value = np.log(np.maximum(counts[0], 1) / max(1, total)) + (longest - 1) * np.log(ALPHA)
        for m in range(2, order + 1):
            seen = np.flatnonzero(counts[m - 1] > own[m - 1])
            value[seen] = np.log(counts[m - 1][seen] - own[m - 1][seen]) - np.log(counts[m - 2][seen - 1]) + (longest[seen] - m) * np.log(ALPHA)
        sums = np.bincount(d, np.where(grams.place > 0, value, 0.0), len(ids)).astype(np.float64)  # of nothing, numpy counts
        return pa.table([pa.array(ids), pa.array(n_words), pa.array(sums)], ["doc_id", "n", "s"])

    out = docs.groupBy("chunk").cogroup(answers.where("chunk >= 0").groupBy("chunk")).applyInArrow(run, "doc_id long, n long, s double")
    return out.select("doc_id", F.col("n").alias("n_words"), F.round("s", 6).alias("log_score"), F.round(F.when(F.col("n") > 0, F.col("s") / F.col("n")), 6).alias("mean_log_score"))
