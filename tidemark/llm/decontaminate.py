"""Benchmark decontamination: latent semantic retrieval of passages, then common subsequences and answer checks.

Terms are the words of the benchmark items, weighted by their inverse document frequency over all documents. A
passage is a window of words. A randomised singular value decomposition of all passages' and items' TF-IDF rows,
whose product Spark sums over partitions, gives a latent space, where a window is the sum of its words' latent rows.
Windows close to an item there are candidates. Only windows are placed that can match at all: with fewer of an item's
words anywhere around them than a match must have in common, the rule itself says no.
A candidate counts if the longest common subsequence of item and passage covers enough of the item's words and,
for paraphrases, of its answer (the last quarter of its words). Items longer than the largest window are cut into
overlapping parts of that size; each part is looked for by itself, and its item counts if enough of the part's words
are there. Besides, hashes of running words find every verbatim run of an item, whatever the latent space says.
Texts are split into words once: what is counted, fitted and compared afterwards are the stored terms of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle

_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


#: Words of a cell: windows that begin in one are ruled out together.
CELL = 96
#: Factor of the hashes of runs, and the fewest words that count as a run.
_BASE, SHORTEST = np.uint64(0x9E3779B97F4A7C15), 8


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_WORDS).split()


def part_starts(n: int, size: int) -> list[int]:
    """Starts of the overlapping parts of n words; the last part ends with the words."""
    return [0] if n <= size else [*range(0, n - size, size // 2), n - size]


@dataclass
class Index:
    """Terms, weights and latent space of one block of items. Items longer than the largest window have several parts."""

    terms: dict[bytes, int]
    idf: np.ndarray
    items: list[tuple[int, list[bytes]]]
    scales: tuple[int, ...]
    run: int
    least: float = 0.6
    #: A latent row for each term, times its weight; the last row, of words that are no terms, is 0.
    rows: np.ndarray | None = None
    latent: np.ndarray | None = None

    def __post_init__(self):
        self.parts = [(i, ws[k : k + size]) for i, (_, ws) in enumerate(self.items) for size in [max(self.scales)] for k in part_starts(len(ws), size)]
        self.whole = np.array([i for i, _ in self.parts], np.int64)
        # Words of a part that must stand around a match: the rule's share of an item; of a part of a longer item half of that, as a passage may have more of its other parts.
        sizes, cut = np.array([len(w) for _, w in self.parts], np.int64), np.array([len(w) < len(self.items[i][1]) for i, w in self.parts], bool)
        self.need = np.ceil(self.least * np.where(cut, 0.5, 1.0) * sizes - 1e-9).astype(np.int64)
        self.held = np.zeros((len(self.idf), len(self.parts)), np.uint8)
        for p, (_, ws) in enumerate(self.parts):
            np.add.at(self.held[:, p], [self.terms[w] for w in ws], 1)
        # Hashes of the runs of each length, with the item and the place of each.
        self.codes = np.random.default_rng(11).integers(1, 1 << 63, len(self.idf) + 1).astype(np.uint64)
        self.tokens = [np.array([self.terms[w] for w in ws], np.int64) for _, ws in self.items]
        self.masks = [places([self.terms[w] for w in ws]) for _, ws in self.parts]
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, t in enumerate(self.tokens):
            if len(t) >= SHORTEST:
                k = min(self.run, len(t))
                found.setdefault(k, []).extend((h, i, at) for at, h in enumerate(self.run_hashes(t, k).tolist()))
        self.runs = {k: np.array(sorted(v), [("h", "<u8"), ("item", "<i8"), ("at", "<i8")]) for k, v in found.items()}
        heads = [self.head_hashes(t[at : at + SHORTEST]) for v in found.values() for _, i, at in v for t in [self.tokens[i]]]
        self.heads = np.unique(np.concatenate(heads)) if heads else np.empty(0, np.uint64)

    def head_hashes(self, t: np.ndarray) -> np.ndarray:
        """A hash of the ``SHORTEST`` terms from each place on."""
        n = len(t) - SHORTEST + 1
        if n < 1:
            return np.empty(0, np.uint64)
        codes = self.codes[t]
        out = codes[:n].copy()
        for k in range(1, SHORTEST):
            out *= _BASE
            out += codes[k : k + n]
        return out

    def run_hashes(self, t: np.ndarray, k: int) -> np.ndarray:
        """A hash of the k terms from each place on."""
        if len(t) < k:
            return np.empty(0, np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(len(t) + 1, _BASE, np.uint64))
            sums = np.r_[np.uint64(0), np.cumsum(self.codes[t] * powers[:-1])]
            return (sums[k:] - sums[:-k]) * powers[: len(t) - k + 1][::-1] * np.uint64(pow(int(_BASE), -len(t), 1 << 64))

    def verbatim_runs(self, t: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of the runs of words that stand in an item; of runs that overlap, the first."""
        h = self.head_hashes(t)
        if not len(h) or not len(self.heads):
            return []
        at = np.minimum(np.searchsorted(self.heads, h), len(self.heads) - 1)
        places = np.flatnonzero(self.heads[at] == h)
        out: list[tuple[int, int, int]] = []
        for k, known in self.runs.items() if len(places) else ():
            last: dict[int, int] = {}
            here = places[places <= len(t) - k]
            hashes = self.run_hashes(t, k)[here]
            lo, hi = np.searchsorted(known["h"], hashes), np.searchsorted(known["h"], hashes, "right")
            for p, x, y in zip(here[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for _, i, own in known[x:y].tolist():
                    if last.get(i, -1) < p and np.array_equal(t[p : p + k], self.tokens[i][own : own + k]):
                        last[i] = p + k - 1
                        out.append((i, p, p + k))
        return out

    def place(self, ws: list[bytes]) -> np.ndarray:
        """Term of each word (-1: none)."""
        return np.fromiter(map(self.terms.get, ws, [-1] * len(ws)), np.int64, len(ws))

    def open_cells(self, texts: list[np.ndarray], chunk: int = 64) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, cell, parts): stretches of ``CELL`` words and the parts of which enough words stand around the windows that begin there."""
        size, lengths = max(self.scales), np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(-(-lengths // CELL)) - -(-lengths // CELL)  # cells of all texts in a row
        t, at, doc = _terms_in_row(texts)
        # A word stands around windows that begin up to two sizes before it, and up to one after.
        low, high = first[doc] + np.maximum(at - 2 * size, 0) // CELL, first[doc] + np.minimum(at + size, lengths[doc] - 1) // CELL
        for base in range(0, int((-(-lengths // CELL)).sum()), chunk):  # a stretch at a time
            a, b = np.searchsorted(high, base), np.searchsorted(low, base + chunk)
            if a == b:
                continue
            known, which = np.unique(t[a:b], return_inverse=True)
            there = np.zeros((chunk, len(known)), np.float32)
            for k in range(int((high[a:b] - low[a:b]).max()) + 1):
                cell = low[a:b] + k
                own = (cell <= high[a:b]) & (cell >= base) & (cell < base + chunk)
                there[cell[own] - base, which[own]] = 1
            cells, parts = np.nonzero(there @ self.held[known].astype(np.float32) >= self.need)
            if len(cells):
                firsts = np.flatnonzero(np.r_[True, np.diff(cells) > 0])
                for cell, own in zip((base + cells[firsts]).tolist(), np.split(parts, firsts[1:]), strict=True):
                    k = int(np.searchsorted(first, cell, "right")) - 1
                    yield k, cell - int(first[k]), own

    def may_match(self, p: int, ws: list[int], cell: int) -> bool:
        """Whether the words around all windows that begin in a cell have enough of a part in common with it, in order: no window has more."""
        size = max(self.scales)
        return _common(self.masks[p], len(self.parts[p][1]), ws[max(0, cell * CELL - size) : (cell + 1) * CELL + 2 * size]) >= self.need[p]

    def with_runs(self, texts: list[np.ndarray]) -> list[int]:
        """Texts in which the first words of a verbatim run of an item stand in a row."""
        if not len(self.heads):
            return []
        row = np.concatenate([np.r_[t, -1] for t in texts])  # a word that is no term ends each text
        terms = np.r_[0, np.cumsum(row >= 0)]
        at = np.flatnonzero(terms[SHORTEST:] - terms[:-SHORTEST] == SHORTEST)
        codes = self.codes[row]
        h = codes[at]
        for k in range(1, SHORTEST):
            h *= _BASE
            h += codes[at + k]
        at = at[self.heads[np.minimum(np.searchsorted(self.heads, h), len(self.heads) - 1)] == h]
        return np.unique(np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), at, "right")).tolist()

    def windows(self, t: np.ndarray, cell: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(starts, ends, sums of latent rows) of the windows of each size that begin in a cell and have a term."""
        for size in self.scales:
            half = size // 2
            low = -(-cell * CELL // half)
            high = min(-(-(cell + 1) * CELL // half), max(0, -(-len(t) // half) - 2) + 1)
            if low >= high:
                continue
            own = t[low * half : (high + 1) * half]
            at = np.flatnonzero(own >= 0)
            if len(at):
                held, first = np.unique(at // half, return_index=True)
                halves = np.zeros((high - low + 1, self.rows.shape[1]), np.float32)
                halves[held] = np.add.reduceat(self.rows[own[at]], first, axis=0)
                starts = np.arange(low, high) * half
                yield starts, np.minimum(starts + size, len(t)), halves[:-1] + halves[1:]

    def close(self, sums: np.ndarray, parts: np.ndarray, cosine: float) -> Iterator[tuple[int, int, float]]:
        """(window, part, cosine) of the pairs that are close in the latent space."""
        unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        near = unit @ self.latent[parts].T
        for w, k in zip(*np.nonzero(near >= cosine), strict=True):
            yield int(w), int(parts[k]), float(near[w, k])


def _terms_in_row(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, place in its text, text) of each word that is a term."""
    row, lengths = np.concatenate([np.empty(0, np.int64), *texts]), np.array([len(t) for t in texts], np.int64)
    all_at = np.flatnonzero(row >= 0)
    doc = np.repeat(np.arange(len(texts)), lengths)[all_at]
    return row[all_at].astype(np.int64), all_at - (np.cumsum(lengths) - lengths)[doc], doc


def item_terms(items: list[tuple[int, str]]) -> dict[bytes, int]:
    return {w: k for k, w in enumerate(sorted({x for _, t in items for x in words(t)}))}


def _width(n: int) -> str:
    return "<i2" if n < 1 << 15 else "<i4"


def placed(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, terms) of every row: the term of each word of its text (-1: none), as little-endian integers."""
    width = _width(len(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch["text"].to_pylist():
                ws = words(text)
                rows.append(np.fromiter(map(terms.get, ws, [-1] * len(ws)), width, len(ws)).tobytes())
            yield pa.record_batch([batch["doc_id"], pa.array(rows, pa.binary())], ["doc_id", "terms"])

    return docs.mapInArrow(run, "doc_id long, terms binary")


def _texts(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return [np.frombuffer(x, _width(n)) for x in batch["terms"].to_pylist()]


def document_frequencies(docs: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Documents that hold each term, over all rows of ``placed``, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            t, _, doc = _terms_in_row(_texts(batch, n_terms))
            n[:-1] += np.bincount(np.unique(doc * n_terms + t) % max(1, n_terms), minlength=n_terms)[:n_terms]
            n[-1] += batch.num_rows
        yield pa.record_batch([pa.array(np.arange(len(n)), pa.int32()), pa.array(n)], ["term", "n"])

    rows = docs.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row for each term
    out = np.zeros(n_terms + 1, np.int64)
    for r in rows:
        out[r.term] = r.n
    return out[:-1], int(out[-1])


def _window_products(index: Index, texts: list[np.ndarray], g: np.ndarray, block: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, rows) of which the sum is that over the windows x (TF-IDF rows of length 1) of some texts of x' (x g), without writing the rows out; ``g`` has its rows times their weights, and the rows given lack theirs."""
    own, at, doc = _terms_in_row(texts)
    if not len(own):
        return
    lengths, n, squares, slots = np.array([len(t) for t in texts], np.int64), len(index.idf), index.idf**2, []
    for size in index.scales:
        # Windows are pairs of halves. Halves of all texts stand in a row, two of each text at least; at the last one of a text no window begins.
        held = np.maximum(-(-lengths // (size // 2)), 2)
        slots.append(((np.cumsum(held) - held)[doc] + at // (size // 2), np.cumsum(held)))
    # Words of the same halves make a piece, which is summed first; ``counts`` are the terms of a block of pieces.
    begins = np.r_[True, np.any([np.diff(s) > 0 for s, _ in slots], axis=0)]
    piece, which, blocks = np.flatnonzero(begins), np.cumsum(begins) - 1, []
    sums, both = np.zeros((len(piece), g.shape[1]), np.float32), np.zeros((len(piece), g.shape[1]), np.float32)
    for k in range(0, len(piece), block):
        a, b = piece[k], piece[k + block] if k + block < len(piece) else len(own)
        known, row = np.unique(own[a:b], return_inverse=True)
        counts = np.bincount(row * block + which[a:b] - k, minlength=len(known) * block).reshape(-1, block).astype(np.float32)[:, : len(piece) - k]
        sums[k : k + block] = counts.T @ g[known]
        blocks.append((k, known, counts))
    for slot, ends in slots:
        keys, times = np.unique(slot * n + own, return_counts=True)
        # A window's norm: squares of both halves, and twice the product of what stands in both.
        norms = np.bincount(keys // n, times**2 * squares[keys % n], ends[-1] + 1)
        norms[:-1] += norms[1:]
        after = np.minimum(np.searchsorted(keys, keys + n), len(keys) - 1)
        twice = np.flatnonzero(keys[after] == keys + n)
        norms += np.bincount(keys[twice] // n, 2 * times[twice] * times[after[twice]] * squares[keys[twice] % n], len(norms))
        norms[ends - 1] = np.inf
        h = slot[piece]
        halves, first = np.zeros((len(norms) + 1, g.shape[1]), np.float32), np.flatnonzero(np.r_[True, np.diff(h) > 0])
        held = np.diff(np.r_[first, len(h)])
        for k in range(int(held.max())):  # a half has few pieces
            halves[h[first[held > k]]] += sums[first[held > k] + k]
        y = halves[:-1]
        y += halves[1:].copy()
        y /= np.maximum(norms, 1e-18)[:, None].astype(np.float32)
        both += y[h]
        both[h > 0] += y[h[h > 0] - 1]  # of both windows that hold a half
    for k, known, counts in blocks:
        yield known, counts @ both[k : k + block]


def _groups(texts: list[np.ndarray], most: int = 8_192) -> Iterator[list[np.ndarray]]:
    """Texts in a row, of about ``most`` words together."""
    own: list[np.ndarray] = []
    for t in texts:
        if own and sum(map(len, own)) + len(t) > most:
            yield own
            own = []
        own.append(t)
    if own:
        yield own


def range_product(docs: DataFrame, index: Index, g: np.ndarray) -> np.ndarray:
    """The sum over passages x of x' (x g), by partition and then by block of terms; its size is that of g."""
    width = 256

    weighted = (index.idf[:, None] * g).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros(weighted.shape)
        for batch in batches:
            for texts in _groups(_texts(batch, len(index.idf))):
                for known, rows in _window_products(index, texts, weighted):
                    z[known] += rows
        z *= index.idf[:, None]
        if z.any():
            blocks = range(0, len(z), width)
            yield pa.record_batch([pa.array([k // width for k in blocks], pa.int32()), pa.array([z[k : k + width].tobytes() for k in blocks], pa.binary())], ["block", "z"])

    def total(key, table):
        parts = sum(np.frombuffer(x) for x in table["z"].to_pylist())
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([parts.tobytes()], pa.binary())], ["block", "z"])

    out = np.zeros(g.shape)
    for r in docs.select("terms").mapInArrow(run, "block int, z binary").groupBy("block").applyInArrow(total, "block int, z binary").collect():
        part = np.frombuffer(r.z).reshape(-1, g.shape[1])
        out[r.block * width : r.block * width + len(part)] = part
    return out


def fit(docs: DataFrame, items: list[tuple[int, str]], *, rank: int = 128, scales: tuple[int, ...] = (24, 64), run: int = 24, least: float = 0.6) -> Index:
    """The index of a block of items on documents with texts."""
    return fit_placed(placed(docs, item_terms(items)), items, rank=rank, scales=scales, run=run, least=least)


def fit_placed(docs: DataFrame, items: list[tuple[int, str]], *, rank: int = 128, scales: tuple[int, ...] = (24, 64), run: int = 24, least: float = 0.6) -> Index:
    """The index of a block of items, on rows of ``placed`` by their terms. Frequencies and the latent space come from all documents: the space is fitted on the items and on every passage, by one product of their second moments with a random matrix (Nyström's form of the decomposition)."""
    split = [(i, words(t)) for i, t in items]
    split = [(i, w) for i, w in split if w]
    terms = item_terms(items)
    df, n = document_frequencies(docs, len(terms))
    idf = np.log((n + 1) / (df + 1)) + 0.1
    index = Index(terms, idf, split, scales, run, least)
    if not split:
        return index
    own = np.zeros((len(index.parts), len(terms)), np.float32)
    for i, (_, w) in enumerate(index.parts):
        np.add.at(own[i], [terms[x] for x in w], idf[[terms[x] for x in w]])
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    g = np.linalg.qr(np.random.default_rng(7).standard_normal((len(terms), min(rank + 16, len(terms)))))[0]
    product = own.T.astype(np.float64) @ (own @ g) + range_product(docs, index, g)  # of items and passages
    core = g.T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    kept = values > 1e-6 * values[-1]  # products are summed in single precision within a text
    basis = np.linalg.svd(product @ (vectors[:, kept] / np.sqrt(values[kept])), full_matrices=False)[0][:, :rank]
    index.rows = np.vstack([idf[:, None] * basis, np.zeros((1, basis.shape[1]))]).astype(np.float32)
    latent = own @ basis
    index.latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return index


def places(a: list) -> dict:
    """The places of each word, in the bits of a number."""
    masks: dict = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def _common(masks: dict, n: int, b: list) -> int:
    full = (1 << n) - 1
    v = full
    for m in filter(None, map(masks.get, b)):
        if u := v & m:
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def common(a: list, b: list) -> int:
    """Length of the longest common subsequence of words, with the rows of the table in the bits of a number."""
    return _common(places(a), len(a), b)


#: Least cosine of a candidate in the latent space. Lower ones cost time, not results: what is close is compared word by word.
COSINE = 0.3
FOUND = "doc_id long, item_id long, cosine double, lcs double, answer double, first_word long, last_word long"


def matches(docs: DataFrame, index: Index, *, cosine: float, verbatim: float, paraphrase: float, answer: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            texts = _texts(batch, len(index.idf)) if index.latent is not None else []
            near: dict[int, list[tuple[int, np.ndarray]]] = {}
            for k, cell, parts in index.open_cells(texts) if texts else ():
                near.setdefault(k, []).append((cell, parts))
            running = set(index.with_runs(texts)) if texts else set()
            for d in sorted(near.keys() | running):
                t, ws = texts[d].astype(np.int64), texts[d].tolist()
                best: dict[int, tuple] = {}
                shares: dict[tuple[int, int, int], tuple[float, float]] = {}

                def weigh(i: int, start: int, end: int, near: float, enough: bool, ws=ws, best=best, shares=shares) -> None:
                    """Keep the passage around a window if it counts and is the best of item i so far."""
                    item, own = index.items[i][0], index.tokens[i].tolist()
                    a, b = max(0, start - len(own)), min(len(ws), end + len(own))
                    if (i, a, b) not in shares:
                        tail = own[-max(1, len(own) // 4) :]
                        shares[i, a, b] = common(own, ws[a:b]) / len(own), common(tail, ws[a:b]) / len(tail)
                    share, kept = shares[i, a, b]
                    if (enough or share >= verbatim or (share >= paraphrase and kept >= answer)) and (i not in best or best[i][1] < share):
                        best[i] = (near, share, kept, a, b - 1, item)

                for cell, some in near.get(d, ()):
                    parts = [p for p in some.tolist() if index.may_match(p, ws, cell)]
                    for s, e, sums in index.windows(t, cell) if parts else ():
                        for w, p, cos in index.close(sums, np.array(parts), cosine):
                            i, part = index.parts[p]
                            start, end = int(s[w]), int(e[w])
                            cut = len(part) < len(index.items[i][1])
                            enough = cut and _common(index.masks[p], len(part), ws[max(0, start - len(part)) : end + len(part)]) >= verbatim * len(part)
                            weigh(i, start, end, cos, enough)
                for i, start, end in index.verbatim_runs(t) if d in running else ():
                    x = index.rows[t[start:end]].sum(axis=0)
                    cos = index.latent[index.whole == i] @ (x / max(np.linalg.norm(x), 1e-9))
                    weigh(i, start, end, float(cos.max()), True)
                doc = batch["doc_id"][d].as_py()
                out += [(doc, item, c, share, kept, a, b) for c, share, kept, a, b, item in best.values()]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")])

    return docs.mapInArrow(run, FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame, *, cosine: float = COSINE, verbatim: float = 0.75, paraphrase: float = 0.6, answer: float = 0.6, run: int = 24, block: int = 2_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, first_word, last_word): the best passage of each document and item that match.

    Windows of a cosine of ``cosine`` or more to an item are compared with it. A match has at least ``verbatim`` of the
    item's words in a common subsequence, or at least ``paraphrase`` of them and ``answer`` of its answer's, or ``verbatim`` of the words of a part of a long item, or ``run`` running words of
    the item (all of it, if it has fewer, but 8 at least); lcs and answer are shares of the whole item's. Items are taken in blocks of about ``block`` parts, each against all rows; null and empty
    items match nothing, as do null and empty texts. Null ids stay null; repeated rows match each.
    """
    docs = documents(docs, id_col, text_col)
    keys = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = F.size(F.split("text", r"\W+"))
    total, out = keys.agg(F.sum(F.greatest(F.lit(1), F.ceil(size / 32) - 1))).first()[0] or 0, None
    blocks = max(1, -(-total // block))
    for k in range(blocks):
        # Items of about ``block`` parts at a time come to the driver and go to the tasks.
        items = [(r.item_id, r.text) for r in keys.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()]
        rows = settle(placed(docs, item_terms(items)), "placed-words")  # each text is split once, whatever reads it afterwards
        found = matches(rows, fit_placed(rows, items, run=run, least=min(verbatim, paraphrase)), cosine=cosine, verbatim=verbatim, paraphrase=paraphrase, answer=answer)
        out = found if out is None else out.unionByName(found)
    return out
