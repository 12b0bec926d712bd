"""Removal of repeated passages: strings of ``LENGTH`` bytes that also start in a document of a smaller id.

Rows of one text with a larger id go whole; what follows works on one row of each text.

1. Every window of LENGTH bytes has an anchor, the smallest hash of its substrings of Q bytes; equal windows have
   equal anchors. Documents are dealt into chunks. A chunk asks for each of its distinct anchors once, with the number of
   its documents that have it, in buckets of hashes, and is told which of them stand in another document.
2. Around these anchors, slices of text (the windows of one anchor in a row) are dealt by anchor. Slices of an anchor that
   stands in more than ``HOT`` documents are cut into single windows, dealt by a hash of the window.
3. In each group the distinct slices form a collection whose Burrows-Wheeler transform and common prefixes are
   built column by column: each round inserts the next symbol (from the right) of every slice, merging the new
   suffixes into the arrays of the round before, which lie in two alternating sets of external files (in the task's own
   temporary folder; they don't outlive it). Neighbours with a common prefix of LENGTH bytes are the same window; the
   smallest document of each is known then. A slice that has no half window in common with another one of its anchor
   needs no transform.
4. The windows of smaller documents go back to where slices stood, and the covered bytes are cut out.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, documents, settle

LENGTH, Q = 50, 20
#: Bytes of text a chunk and a bucket of hashes, the fewest of either, and distinct slices of a group.
CHUNK, BUCKET, LEAST, SLICES = 4 << 20, 12 << 20, 16, 20_000
#: Documents whose slices of one anchor may meet in one group.
HOT = 50_000
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Bytes of a hash that travel in the first step: collisions only let a few more anchors pass.
_WIDTH = 6


def substring_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """A hash of each substring of q bytes, by joining hashes of halves."""
    h, size, power = x.astype(np.uint64) + np.uint64(1), 1, _BASE
    out, done, bits = None, 0, q
    with np.errstate(over="ignore"):
        while bits:
            if bits & 1:
                if out is None:
                    out, done = h, size
                else:
                    n = len(x) - done - size + 1
                    out, done = out[:n] * power + h[done : done + n], done + size
            bits >>= 1
            if bits:
                n = len(x) - 2 * size + 1
                h, power, size = h[:n] * power + h[size : size + n], power * power, 2 * size
        out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h, size = np.minimum(h[:-size], h[size:]), 2 * size
    rest = width - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def window_anchors(raw: bytes, length: int, q: int) -> np.ndarray:
    """The anchor of the window that starts at each byte; none if the text is shorter than a window."""
    if len(raw) < length:
        return np.empty(0, np.uint64)
    return sliding_min(substring_hashes(np.frombuffer(raw, np.uint8), q), length - q + 1)


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _short(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 8 * _WIDTH)).astype("<u8")


def _packed(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_WIDTH]).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _WIDTH, 8), np.uint8)
    out[:, :_WIDTH] = np.frombuffer(raw, np.uint8).reshape(-1, _WIDTH)
    return out.view("<u8").ravel()


ASKED = "bucket int, chunk int, hashes binary, documents binary"
ANSWERED = "chunk int, bucket int, states binary"
#: States of an anchor: in one document only, in several, in more than ``HOT``.
ALONE, SEVERAL, MANY = 0, 1, 2


def _by_bucket(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of sorted hashes by bucket, and where the next bucket begins in it."""
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _runs(texts: list[str | None], length: int, q: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text, the runs of windows of one anchor: first windows, ends (not included) and anchors."""
    out = []
    for t in texts:
        a = window_anchors(_raw(t), length, q)
        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, np.int64)
        out.append((start, np.r_[start[1:], len(a)][: len(start)], a[start]))
    return out


def _distinct(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors of a chunk, shortened, and the number of texts that have each."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *(np.unique(_short(a)) for _, _, a in runs)]), return_counts=True)


def asked_anchors(docs: DataFrame, length: int, q: int, buckets: int) -> DataFrame:
    """The distinct anchors of each chunk, by bucket."""

    def run(key, table):
        h, n = _distinct(_runs(table["text"].to_pylist(), length, q))
        order, cuts = _by_bucket(h, buckets)
        rows = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = order[cuts[b] : cuts[b + 1]]
            planes = np.ascontiguousarray(np.frombuffer(_packed(h[part]), np.uint8).reshape(-1, _WIDTH).T)  # equal high bytes side by side are small when compressed
            rows.append((b, key[0].as_py(), planes.tobytes(), n[part].astype("<u4").tobytes()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "chunk", "hashes", "documents"])

    return docs.groupBy("chunk").applyInArrow(run, ASKED)


def answered_anchors(asks: DataFrame, hot: int) -> DataFrame:
    """The states of the anchors of each chunk and bucket, in their order."""

    def run(key, table):
        each = [_unpacked(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(_WIDTH, -1).T).tobytes()) for x in table["hashes"].to_pylist()]
        h, which = np.unique(np.concatenate(each), return_inverse=True)
        n = np.bincount(which, np.concatenate([np.frombuffer(x, "<u4") for x in table["documents"].to_pylist()]), len(h))
        state = np.where(n > hot, MANY, np.where(n > 1, SEVERAL, ALONE)).astype(np.uint8)[which]
        parts = np.split(state, np.cumsum([len(x) for x in each])[:-1])
        return pa.table([table["chunk"], table["bucket"], pa.array([x.tobytes() for x in parts], pa.binary())], ["chunk", "bucket", "states"])

    return asks.groupBy("bucket").applyInArrow(run, ANSWERED)


def slices(docs: DataFrame, answers: DataFrame, length: int, q: int, buckets: int) -> DataFrame:
    """Distinct slices of each chunk with the smallest and largest document, and where slices stand.

    Rows of the first kind have h, slice, doc_id (smallest), last; those of the second key and more (96 bits that name
    the slice, so that two of some 10**12 slices hardly share a name), doc_id, _t, at.
    """

    def run(key, table, answers):
        texts = table["text"].to_pylist()
        each = _runs(texts, length, q)
        h, _ = _distinct(each)
        order, cuts = _by_bucket(h, buckets)
        state = np.zeros(len(h), np.uint8)
        for b, x in zip(answers["bucket"].to_pylist(), answers["states"].to_pylist(), strict=True):
            state[order[cuts[b] : cuts[b + 1]]] = np.frombuffer(x, np.uint8)
        seen: dict[bytes, list[int]] = {}
        keys, mores, ids, ties, ats = [], [], [], [], []
        for doc, tie, text, (start, end, a) in zip(table["doc_id"].to_pylist(), table["_t"].to_pylist(), texts, each, strict=True):
            known = state[np.searchsorted(h, _short(a))] if len(a) else np.empty(0, np.uint8)
            good = known != ALONE
            if not good.any():
                continue
            raw = _raw(text)
            start, end, a, many = start[good], end[good], a[good], known[good] == MANY
            # Long runs (periodic text) are cut, those of hot anchors at each window.
            step = np.where(many, 1, length - q + 1)
            cuts = -(-(end - start) // step)
            if (cuts > 1).any():
                nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start, end, a, many, step = (np.repeat(x, cuts) for x in (start, end, a, many, step))
                start = start + nth * step
                end = np.minimum(end, start + step)
            for s, e, g, many in zip(start.tolist(), end.tolist(), a.tolist(), many.tolist(), strict=True):
                part = raw[s : e + length - 1]
                own = seen.get(part)
                if own is None:
                    long_name = xxhash.xxh3_128_intdigest(part)
                    name, more = (long_name >> 64) - (1 << 63), (long_name & 0xFFFFFFFF) - (1 << 31)
                    seen[part] = own = [name if many else g - (1 << 63), doc, doc, name, more]
                elif doc < own[1]:
                    own[1] = doc
                elif doc > own[2]:
                    own[2] = doc
                keys.append(own[3]), mores.append(own[4]), ids.append(doc), ties.append(tie), ats.append(s)
        n, m, long = len(seen), len(keys), pa.int64()
        hs, lo, hi, own, more = zip(*seen.values(), strict=True) if n else ((), (), (), (), ())
        null = lambda k, t: pa.nulls(k, t)
        names = ["h", "slice", "doc_id", "last", "key", "more", "_t", "at"]
        one = pa.table([pa.array(hs, long), pa.array(list(seen), pa.binary()), pa.array(lo, long), pa.array(hi, long), pa.array(own, long), pa.array(more, pa.int32()), null(n, long), null(n, pa.int32())], names)
        two = pa.table([null(m, long), null(m, pa.binary()), pa.array(ids, long), null(m, long), pa.array(keys, long), pa.array(mores, pa.int32()), pa.array(ties, long), pa.array(ats, pa.int32())], names)
        return pa.concat_tables([one, two])

    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, "h long, slice binary, doc_id long, last long, key long, more int, _t long, at int")


def _segment_minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(np.append(values, values[-1:]), np.stack([a, b], 1).ravel())[::2]


def range_minima(values: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 64) -> np.ndarray:
    """Least value of each range a..b (b not included, a < b); long ranges read minima of whole blocks."""
    out = np.empty(len(a), values.dtype)
    far = b - a > 4 * block
    if not far.all():
        out[~far] = _segment_minima(values, a[~far], b[~far])
    if far.any():
        x, y = a[far], b[far]
        left, right = -(-x // block), y // block
        whole = np.minimum.reduceat(values, np.arange(0, len(values), block))
        inner = _segment_minima(whole, left, right)
        out[far] = np.minimum(inner, np.minimum(_segment_minima(values, x, np.maximum(left * block, x + 1)), _segment_minima(values, np.minimum(right * block, y - 1), y)))
    return out


def collection(strings: list[bytes], folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, common prefix with the suffix before) of all suffixes of the strings in sorted order.

    The transform is built column by column. After round j it holds the suffixes of up to j symbols; symbol 0 ends a
    string, and ends sort by the number of their string. A new suffix is a symbol c before an older suffix: its place
    is the number of smaller symbols in the transform plus that of c's before, and its common prefix with the c
    before is one more than the least common prefix between the two older suffixes. Arrays of two successive rounds
    lie in files in ``folder``. Common prefixes are kept up to the largest value of their type.
    """
    m = len(strings)
    lens = np.array([len(s) for s in strings], np.int64)
    if m and lens.max() > np.iinfo(np.uint16).max:
        raise ValueError("strings of more than 65535 bytes")
    prefix = np.uint8 if not m or lens.max() <= np.iinfo(np.uint8).max else np.uint16
    most = np.iinfo(prefix).max
    base = np.cumsum(lens) - lens
    text = np.frombuffer(b"".join(strings), np.uint8)
    total = int(lens.sum()) + m
    # ``which`` is a string's number and, in the low 16 bits, the offset.
    kinds = (("bwt", np.uint8), ("lcp", prefix), ("which", np.int64))
    files = [{name: np.memmap(os.path.join(folder, f"{name}{g}"), kind, "w+", shape=(total + 1,)) for name, kind in kinds} for g in range(2)]

    def before(s: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The symbol before each suffix; 0 at a string's start."""
        return np.where(start > 0, text[base[s] + np.maximum(start, 1) - 1].astype(np.int64) + 1, 0).astype(np.uint8)

    now, s, n = files[0], np.arange(m), m
    now["bwt"][:m], now["lcp"][:m], now["which"][:m] = before(s, lens), 0, (s << 16) | lens
    at = s.copy()
    live = lens > 0
    at, s = at[live], s[live]
    j = 0
    while len(s):
        j += 1
        new = files[j % 2]
        bwt = np.asarray(now["bwt"][:n])
        order = np.argsort(bwt, kind="stable")
        # The place of each live suffix in this order; ``at`` is rising.
        mark = np.zeros(n, bool)
        mark[at] = True
        r = np.flatnonzero(mark[order])
        r = r[np.argsort(order[r])]
        ends = int(np.count_nonzero(bwt == 0))
        place = m + r - ends
        c = bwt[at]
        lcp = np.asarray(now["lcp"][: n + 1])
        left, right = order[np.maximum(r - 1, 0)], order[np.minimum(r + 1, n - 1)]
        has_left, has_right = (r > ends) & (bwt[left] == c), (r + 1 < n) & (bwt[right] == c)
        common = []
        for has, a, b in ((has_left, left, at), (has_right, at, right)):
            out = np.zeros(len(s), np.int64)
            if has.any():
                out[has] = np.minimum(range_minima(lcp, a[has] + 1, b[has] + 1).astype(np.int64) + 1, most)
            common.append(out)
        start = lens[s] - j
        size = n + len(s)
        moved = np.ones(size, np.intp)
        moved[place] = 0
        np.cumsum(moved, out=moved)
        moved -= 1  # where each old suffix was; new ones are set after
        for name, value in (("bwt", before(s, start)), ("lcp", common[0]), ("which", (s << 16) | start)):
            target = new[name][:size]
            np.take(np.asarray(now[name][:n]), moved, out=target, mode="clip")
            target[place] = value
        after = place + 1
        inside = after < size
        new["lcp"][after[inside]] = common[1][inside]
        new["lcp"][size] = 0
        live = np.flatnonzero(start > 0)
        live = live[np.argsort(place[live])]  # places in order keep the ranges of the next round apart
        at, s, now, n = place[live], s[live], new, size
    which = np.array(now["which"][:n])
    return which >> 16, which & 0xFFFF, np.array(now["lcp"][:n])


def smallest_documents(strings: list[bytes], docs: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string, the smallest document of each of its windows among all strings that hold the window."""
    with tempfile.TemporaryDirectory(prefix="columns-") as folder:
        s, off, lcp = collection(strings, folder)
    lens = np.array([len(x) for x in strings], np.int64)
    first = np.flatnonzero(lcp < length)
    least = np.minimum.reduceat(docs[s], first)
    value = np.repeat(least, np.diff(np.r_[first, len(s)]))
    windows = np.maximum(lens - length + 1, 0)
    base = np.cumsum(windows) - windows
    whole = off < windows[s]
    out = np.empty(int(windows.sum()), np.int64)
    out[base[s[whole]] + off[whole]] = value[whole]
    return np.split(out, np.cumsum(windows)[:-1])


def may_share(strings: list[bytes], anchors: np.ndarray, length: int, q: int) -> np.ndarray:
    """Whether each slice may have a window in common with another one of its anchor.

    A window holds its anchor and ``length - q`` more bytes, half of them at least on one side. So slices of a common
    window have the anchor and that half in common. A slice in which the anchor stands not just once may share any.
    """
    half = (length - q) // 2
    m = len(strings)
    if not half:
        return np.ones(m, bool)
    lens = np.array([len(x) for x in strings], np.int64)
    end = np.cumsum(lens)
    text = np.frombuffer(b"".join(strings), np.uint8)
    owner = np.repeat(np.arange(m), lens)[: len(text) - q + 1]
    at = np.flatnonzero(substring_hashes(text, q) == anchors[owner])
    at = at[at + q <= end[owner[at]]]
    own = owner[at]
    times = np.bincount(own, minlength=m)
    place = np.zeros(m, np.int64)
    place[own] = at
    sides, out = substring_hashes(text, half), times != 1
    for near, has in ((place - half, place - half >= end - lens), (place + q, place + q + half <= end)):
        chosen = np.flatnonzero(has & (times == 1))
        keys = sides[near[chosen]] ^ (anchors[chosen] * _BASE)
        _, which, n = np.unique(keys, return_inverse=True, return_counts=True)
        out[chosen[n[which] > 1]] = True
    return out


RUNS = "key long, more int, runs array<struct<a:int, b:int, doc:long>>"


_MERGED = {"doc_id": "min", "last": "max", "key": "min", "more": "min"}


def _merged(table: pa.Table) -> pa.Table:
    """One row for each slice."""
    out = table.group_by(["h", "slice"]).aggregate(list(_MERGED.items()))
    return out.select(["h", "slice", *(f"{c}_{f}" for c, f in _MERGED.items())]).rename_columns(["h", "slice", *_MERGED])


def combined(parts: DataFrame, size: int = 16 << 20) -> DataFrame:
    """Rows of slices with those of one slice merged within a task, some ``size`` bytes at a time: a line that stands in every chunk goes on once a task, not once a chunk."""
    schema = "h long, slice binary, doc_id long, last long, key long, more int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= size:
                merged = _merged(pa.Table.from_batches(held))
                yield from merged.to_batches()
                held = []
        if held:
            yield from _merged(pa.Table.from_batches(held)).to_batches()

    return parts.select("h", "slice", "doc_id", "last", "key", "more").mapInArrow(run, schema)


def smallest_by_slice(parts: DataFrame, length: int, q: int, groups: int) -> DataFrame:
    """(key, more, runs) of slices: windows a..b (b included) first stand in ``doc``. Slices whose windows stand in one document only are left out."""

    def run(key, table):
        table = _merged(table).sort_by([("h", "ascending"), ("slice", "ascending")])
        h, docs, last, keys, mores = (table[c].to_numpy() for c in ("h", "doc_id", "last", "key", "more"))
        texts = table["slice"].to_pylist()
        same = h[1:] == h[:-1]
        many = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        if len(many):
            many = many[may_share([texts[i] for i in many], h[many].view(np.uint64) ^ np.uint64(1 << 63), length, q)]
        out_keys, out_mores, out_runs = [], [], []
        alone = np.ones(len(h), bool)
        alone[many] = False
        for i in np.flatnonzero(alone & (docs < last)).tolist():
            out_keys.append(keys[i]), out_mores.append(mores[i])
            out_runs.append([{"a": 0, "b": len(texts[i]) - length, "doc": docs[i]}])
        if len(many):
            for i, least in zip(many.tolist(), smallest_documents([texts[i] for i in many], docs[many], length), strict=True):
                cut = np.flatnonzero(np.diff(least)) + 1
                spans = [{"a": a, "b": b - 1, "doc": d} for a, b, d in zip([0, *cut.tolist()], [*cut.tolist(), len(least)], least[np.r_[0, cut]].tolist(), strict=True) if d < last[i]]
                if spans:
                    out_keys.append(keys[i]), out_mores.append(mores[i])
                    out_runs.append(spans)
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("doc", pa.int64())]))
        return pa.table([pa.array(out_keys, pa.int64()), pa.array(out_mores, pa.int32()), pa.array(out_runs, kind)], ["key", "more", "runs"])

    return combined(parts).withColumn("_g", F.pmod("h", F.lit(groups))).groupBy("_g").applyInArrow(run, RUNS)


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) of every row; kept are the remaining bytes. With ``keep``, also these
    columns, the text, and kept_text, the remaining bytes as text without the parts of characters cut in their middle.

    Each byte covered by a string of ``length`` bytes that also starts in a row of a smaller id goes; strings are
    judged on the input. Null texts are empty ones. Rows of null ids neither lose bytes nor count as smaller; rows of
    one id don't count for each other. An empty table gives no rows. ``length`` is 2 to 30,000.
    """
    if not 2 <= length <= 30_000:
        raise ValueError("length must be 2 to 30,000")
    q = min(Q, max(1, length * 2 // 5))
    spark = docs.sparkSession
    extra = keep or []
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra).withColumn("_t", F.xxhash64("text"))
    known = documents(docs, id_col, text_col).where(f"doc_id is not null and octet_length(text) >= {length}").withColumn("_t", F.xxhash64("text")).withColumn("_m", F.md5("text"))
    # One row of each text goes on. Rows of one text with a larger id lose everything.
    per_text = settle(known.groupBy("_t", "_m").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count("*").alias("rows")), "texts")
    n_texts, n_bytes = per_text.agg(F.count("*"), F.sum(F.expr("bytes div rows"))).first()
    n_bytes = n_bytes or 0
    buckets, chunks = max(LEAST, n_bytes // BUCKET), max(LEAST, n_bytes // CHUNK)
    copies = known.select("doc_id", "_t", "_m").join(per_text.where("least < most").select("_t", "_m", "least"), ["_t", "_m"]).where("doc_id > least").select("doc_id", "_t").distinct()
    copies = settle(copies, "copies")
    one = known.join(per_text.select("_t", "_m", F.col("least").alias("doc_id")), ["_t", "_m", "doc_id"]).withColumn("chunk", F.pmod(F.col("_t"), F.lit(chunks)).cast("int"))
    stored = settle(one, "first-rows")
    if stored.count() > n_texts:  # a text stands more than once under one id
        stored = settle(stored.dropDuplicates(["doc_id", "_t", "_m"]), "first-rows")
    one = stored.select("doc_id", "_t", "text", "chunk")
    answers = settle(answered_anchors(asked_anchors(one, length, q, buckets), HOT), "answers")
    parts = settle(slices(one, answers, length, q, buckets), "slices")
    discard(stored, answers, per_text)
    distinct = parts.where("slice is not null")
    runs = smallest_by_slice(distinct, length, q, max(LEAST, distinct.count() // SLICES))
    spans = parts.where("slice is null").select("key", "more", "doc_id", "_t", "at").join(runs, ["key", "more"]).select("doc_id", "_t", "at", F.explode("runs").alias("r")).where("r.doc < doc_id")
    spans = spans.groupBy("doc_id", "_t").agg(F.collect_list(F.struct((F.col("at") + F.col("r.a")).alias("s"), (F.col("at") + F.col("r.b") + length).alias("e"))).alias("spans"))
    cuts = settle(spans.withColumn("copy", F.lit(False)).unionByName(copies.select("doc_id", "_t", F.array().cast("array<struct<s:int,e:int>>").alias("spans"), F.lit(True).alias("copy"))), "cuts")

    discard(parts, copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            spans = batch["spans"].combine_chunks() if isinstance(batch["spans"], pa.ChunkedArray) else batch["spans"]
            flat, ends = spans.flatten(), np.cumsum(np.nan_to_num(pc.list_value_length(spans).to_numpy(zero_copy_only=False)).astype(np.int64))
            s, e = (pc.struct_field(flat, k).to_numpy() for k in (0, 1))
            for doc, text, copy, k, b in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["copy"].to_pylist(), np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
                raw = _raw(text)
                if copy:
                    out.append((doc, b"", len(raw), len(raw), 1))
                elif k == b:
                    out.append((doc, raw, len(raw), 0, 0))
                else:
                    depth = np.bincount(s[k:b], minlength=len(raw) + 1) - np.bincount(e[k:b], minlength=len(raw) + 1)
                    gone = np.cumsum(depth)[: len(raw)] > 0
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append((doc, kept, len(raw), int(gone.sum()), int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
            if keep is not None:
                made += [pa.array([r[1].decode("utf-8", "ignore") for r in out]), batch["text"], *(batch[c] for c in extra)]
                names += ["kept_text", "text", *extra]
            yield pa.record_batch(made, names)

    schema = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"
    if keep is not None:
        schema += ", kept_text string, text string" + "".join(f", `{c}` {whole.schema[c].dataType.simpleString()}" for c in extra)
    return whole.join(cuts, ["doc_id", "_t"], "left").select("doc_id", "text", "spans", "copy", *extra).mapInArrow(run, schema)
