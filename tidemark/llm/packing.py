"""Best-fit packing of documents into sequences of a fixed length, improved by local search.

Pieces (a document, or a part of one longer than a sequence) are dealt at random into groups of bounded size.
Each group is packed best fit first, then a local search exchanges pieces one for one or two for one, or
moves them, between bins that aren't full, as long as the sum of squared fills rises; bins that empty go.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle
from tidemark.llm.tokenize import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, *, end_id: int = 2, length: int = 1024) -> DataFrame:
    """Each row's ids and ``end_id``, cut into pieces of ``length``; the first piece takes the remainder. A null text is an empty one: one piece of the end id. Repeated rows give their pieces each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.append(enc.encode(text or ""), enc.dtype.type(end_id)).astype("<u4")
                first = len(ids) % length or length
                cuts = [0, *range(first, len(ids) + 1, length)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for column, v in zip(out, (doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        column.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents(docs).mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece: in order of falling size, the fullest bin with room."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: a bin with room r stands open
    n = 0
    for i in order.tolist():
        s = int(sizes[i])
        fits = open_rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            b, room, n = n, capacity, n + 1
        bins[i] = b
        if room > s:
            by_room[room - s].append(b)
            open_rooms |= 1 << (room - s)
    return bins


class _Bins:
    """Pieces in bins, with indexes of the underfull ones.

    ``by_room`` has the bins of each room. ``by_key`` has the pieces by size and room of their bin together: the largest
    piece that could take their place. Bits of ``rooms`` and ``keys`` say which entries aren't empty.
    """

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, capacity: int):
        self.size, self.where, self.capacity = sizes.tolist(), bins.tolist(), capacity
        self.held: dict[int, list[int]] = {}
        for i, b in enumerate(self.where):
            self.held.setdefault(b, []).append(i)
        self.fill = {b: sum(self.size[i] for i in x) for b, x in self.held.items()}
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.by_key: list[set[int]] = [set() for _ in range(2 * capacity + 1)]
        self.rooms = self.keys = 0
        for b in self.held:
            self._enter(b)

    def _leave(self, b: int) -> None:
        if room := self.capacity - self.fill[b]:
            self.by_room[room].discard(b)
            if not self.by_room[room]:
                self.rooms &= ~(1 << room)
            for k in {self.size[i] + room: 0 for i in self.held[b]}:
                self.by_key[k].difference_update(self.held[b])
                if not self.by_key[k]:
                    self.keys &= ~(1 << k)

    def _enter(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if room and self.held[b]:
            self.by_room[room].add(b)
            self.rooms |= 1 << room
            for i in self.held[b]:
                self.by_key[self.size[i] + room].add(i)
                self.keys |= 1 << (self.size[i] + room)

    def exchange(self, a: int, b: int, give: list[int], take: list[int]) -> None:
        self._leave(a), self._leave(b)
        for src, dst, moved in ((a, b, give), (b, a, take)):
            for i in moved:
                self.held[src].remove(i)
                self.held[dst].append(i)
                self.where[i] = dst
                self.fill[src] -= self.size[i]
                self.fill[dst] += self.size[i]
        self._enter(a), self._enter(b)

    def underfull(self) -> list[int]:
        """Emptiest first."""
        return [b for room in range(self.capacity, 0, -1) for b in sorted(self.by_room[room])]

    def kinds(self, b: int) -> list[int]:
        """A piece of each size, largest first."""
        return sorted({self.size[i]: i for i in self.held[b]}.values(), key=lambda i: -self.size[i])

    def place(self, a: int, s: int) -> int | None:
        """The bin of the least room for ``s`` that gets fuller than ``a`` is now."""
        for room in _bits(self.rooms, s, self.capacity + 1):
            for b in self.by_room[room]:
                if b != a and self.fill[b] + s > self.fill[a]:
                    return b
        return None

    def partner(self, a: int, s: int) -> int | None:
        """A piece smaller than ``s`` whose bin, with ``s`` in its place, gets as full as possible and fuller than ``a`` is now."""
        for k in _bits(self.keys, s, s + self.rooms.bit_length()):
            # The fill of a bin after the exchange is the same for all pieces of a key, and falls with it.
            if self.capacity + s - k <= self.fill[a]:
                return None
            for i in self.by_key[k]:
                if self.where[i] != a and self.size[i] < s:
                    return i
        return None


def _bits(mask: int, start: int, stop: int):
    """The set bits from start up to stop (not included), rising."""
    left = (mask & ((1 << max(start, stop)) - 1)) >> start
    while left:
        step = (left & -left).bit_length()
        left >>= step
        start += step
        yield start - 1


def _improve(bins: _Bins, a: int) -> bool:
    """One move, one-for-one or two-for-one exchange by which ``a`` gives tokens to a fuller bin."""
    own = bins.kinds(a)
    for i in own:
        if (b := bins.place(a, bins.size[i])) is not None:
            bins.exchange(a, b, [i], [])
            return True
        if (j := bins.partner(a, bins.size[i])) is not None:
            bins.exchange(a, bins.where[j], [i], [j])
            return True
    for x, i in enumerate(own):
        for i2 in own[x + 1 :]:
            if (j := bins.partner(a, bins.size[i] + bins.size[i2])) is not None:
                bins.exchange(a, bins.where[j], [i, i2], [j])
                return True
    return False


def _one_for_two(bins: _Bins, order: list[int]) -> bool:
    """A sweep of exchanges of one piece for two smaller ones of a fuller bin, each bin once."""
    pairs = []
    for b in order:
        own = bins.kinds(b)
        pairs += [(bins.size[i] + bins.size[j] + bins.capacity - bins.fill[b], bins.size[i] + bins.size[j], i, j) for x, i in enumerate(own) for j in own[x + 1 :]]
    if not pairs:
        return False
    key, both, first, second = np.array(sorted(pairs)).T
    bin_of = np.array([bins.where[i] for i in first.tolist()])
    fills, widest = np.array([bins.fill[b] for b in bin_of.tolist()]), bins.rooms.bit_length()
    used: set[int] = set()
    for a in order:
        for i in bins.kinds(a) if a not in used else ():
            s = bins.size[i]
            lo, hi = np.searchsorted(key, [s, s + widest])
            fit = lo + np.flatnonzero((both[lo:hi] < s) & (fills[lo:hi] + s - both[lo:hi] > bins.fill[a]) & (bin_of[lo:hi] != a))
            if (p := next((p for p in fit.tolist() if bin_of[p] not in used), None)) is not None:
                bins.exchange(a, int(bin_of[p]), [i], [int(first[p]), int(second[p])])
                used |= {a, int(bin_of[p])}
                break
    return bool(used)


def local_search(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Bins after moves and exchanges between underfull bins, until none is left that raises the sum of squared fills.

    The emptiest bin gives first: a piece moves to a fuller bin, one or two pieces go for a smaller one, or one goes
    for two. All underfull bins and their pieces are tried; bins that empty go, and numbers are dense again.
    """
    state, changed = _Bins(sizes, bins, capacity), True
    while changed:
        changed, order = False, state.underfull()
        for a in order:
            while state.held[a] and state.fill[a] < capacity and _improve(state, a):
                changed = True
        changed = changed or _one_for_two(state, order)
    return np.unique(state.where, return_inverse=True)[1] if len(sizes) else bins


def pack(pieces: DataFrame, *, length: int = 1024, group: int = 20_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces.

    About ``group`` pieces share a group, whatever their document; a group leaves a bin or two not full. Numbers
    of sequences are unique, not dense. An empty table gives no rows.
    """
    n_groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_groups)))

    def run(key, table):
        g = key[0].as_py()
        # The order of arrival differs between attempts; this one doesn't.
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        sizes = table["length"].to_numpy().astype(np.int64)
        bins = local_search(sizes, best_fit(sizes, length), length)
        order = np.lexsort((np.arange(len(bins)), bins))
        ends = np.cumsum(sizes[order])
        starts = ends - sizes[order]
        firsts = np.flatnonzero(np.r_[True, np.diff(bins[order]) != 0])
        offset = np.empty(len(bins), np.int64)
        offset[order] = starts - np.repeat(starts[firsts], np.diff(np.r_[firsts, len(bins)]))
        out = table.drop_columns(["_group"])
        return out.append_column("sequence_id", pa.array((g << 32) + bins)).append_column("offset", pa.array(offset))

    return dealt.groupBy("_group").applyInArrow(run, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, *, end_id: int = 2, length: int = 1024, group: int = 20_000) -> DataFrame:
    """Pieces of all rows with their places; see ``token_pieces`` and ``pack``."""
    return pack(settle(token_pieces(docs, tokenizer, end_id=end_id, length=length), "pieces"), length=length, group=group)
