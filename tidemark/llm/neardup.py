"""Near-duplicate groups: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

A document's set is its distinct shingles of k words. Documents of equal sets form a class, and one of each class
goes on. Hashes of the set fall into ``BINS`` bins, whose smallest ones make the signature; an empty bin takes the
value of a bin chosen by hashing (bin, attempt). Bands of a signature name buckets; in a bucket every member is a
candidate of the smallest one only, so candidates stay in proportion to members. Candidates are confirmed on whole
sets. Documents of one bucket all stand in the star of its smallest one. Where the members of a star then belong to
different components, they are compared with each other too, in blocks of bounded size inside tasks, which send on
only the links that join components: no pairs are made, and no link between different components is lost. Of a star
that fills more than ``WIDE`` blocks, members meet only if one of their rarest shingles also stands in a member of another
component: sets of the wanted similarity share one of these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, documents, map_batches, settle

BINS, ROWS = 128, 4
#: Members of one centre that a group of the verifying join may hold.
FAN = 512
#: Shingles in a block of members that are compared with those of another block.
BLOCK = 200_000
#: Blocks of a star from which on its members are filtered by their rarest shingles: those are about as long as so many copies of a text.
WIDE = 8
#: Cells in which shingles are counted to tell rare ones from frequent ones; a power of 2.
CELLS = 1 << 18


def words(text: str | None) -> list[bytes]:
    """Runs of other than ASCII white space, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(ws: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    """Distinct shingles of k words; fewer words are one shingle, no words none."""
    if len(ws) < k:
        return {tuple(ws)} if ws else set()
    return set(zip(*(ws[i:] for i in range(k)), strict=False))


class Hasher:
    """64-bit hashes of shingles, with a bounded memory of words."""

    def __init__(self, k: int):
        self.k, self.memo = k, {}

    def __call__(self, text: str | None) -> np.ndarray:
        ws = words(text)
        if not ws:
            return np.empty(0, np.uint64)
        if len(self.memo) > 200_000:
            self.memo.clear()
        memo = self.memo
        hs = list(map(memo.get, ws))
        if None in hs:
            for i, h in enumerate(hs):
                if h is None:
                    hs[i] = memo[ws[i]] = xxhash.xxh3_64_intdigest(ws[i])
        h = np.array(hs, np.uint64)
        n = max(1, len(h) - self.k + 1)
        out = np.full(n, min(len(h), self.k), np.uint64)
        for i in range(min(self.k, len(h))):
            out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return np.unique(out)


@cache
def _donors(bins: int, attempts: int = 4096) -> np.ndarray:
    """The bin that each bin asks in each attempt."""
    x = np.arange(attempts, dtype=np.uint64)[:, None] * np.uint64(bins) + np.arange(bins, dtype=np.uint64)
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(m)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(bins)).astype(np.int64)


def signature(h: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Smallest hash of each bin of sorted distinct hashes (not empty), empty bins filled by their donors."""
    shift = np.uint64(64 - (bins - 1).bit_length())
    where = (h >> shift).astype(np.int64)
    first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
    out, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    out[where[first]], full[where[first]] = h[first], True
    empty, source = np.flatnonzero(~full), np.arange(bins)
    for row in _donors(bins):
        if not len(empty):
            break
        ask = row[empty]
        ok = full[ask]
        source[empty[ok]] = ask[ok]
        empty = empty[~ok]
    source[empty] = where[first[0]]
    return out[source]


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One bucket name for each ``rows`` bins."""
    x = sig.reshape(-1, rows)
    out = np.arange(1, len(x) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        out = (out ^ x[:, i]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, t, n, digest, bands) of every row with its text's hash ``t``; digest and bands are null for empty sets."""

    def run(batches):
        hasher = Hasher(k)
        for batch in batches:
            n, digest, band = [], [], []
            for text in batch["text"].to_pylist():
                h = hasher(text)
                n.append(len(h))
                digest.append(_digest(h))
                band.append(bands(signature(h)) if len(h) else None)
            yield pa.record_batch([batch["doc_id"], batch["t"], pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(band, pa.list_(pa.int64()))], ["doc_id", "t", "n", "digest", "bands"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, "doc_id long, t long, n long, digest binary, bands array<long>")


def _digest(h: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The (a, b) whose sets have 100 * intersection >= percent * union. ``a`` may stand in many pairs: its text is dealt to groups of about ``FAN`` of them."""
    fans = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).cast("int").alias("_fans"))
    left = fans.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_ta")), "a").withColumn("_fan", F.explode(F.sequence(F.lit(0), F.col("_fans") - 1))).drop("_fans")
    right = pairs.join(fans, "a").withColumn("_fan", F.pmod(F.xxhash64("b"), "_fans").cast("int")).drop("_fans").join(texts.select(F.col("node").alias("b"), F.col("text").alias("_tb")), "b")
    both = right.join(left, ["a", "_fan"]).select("a", "b", "_ta", "_tb")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        last, own, keep = None, set(), []
        for a, ta, tb in zip(batch["a"].to_pylist(), batch["_ta"].to_pylist(), batch["_tb"].to_pylist(), strict=True):
            if a != last:
                last, own = a, shingles(words(ta), k)
            other = shingles(words(tb), k)
            same = len(own & other)
            keep.append(100 * same >= percent * (len(own) + len(other) - same))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both, run, "a binary, b binary")


def joining_links(sets: list[np.ndarray], part: list, first: list[bool], whole: bool, percent: int, sure: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Links that join different parts, until none is left to join. Sets are sorted hashes; ``sure`` confirms a link on the sets themselves.

    ``first`` tells the block of each set; with ``whole`` there is one block, whose sets are all compared, otherwise
    sets of the one block are compared with those of the other.
    """
    m = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(token, kind="stable")
    holders, n = owner[order], np.bincount(token)
    start, base = np.cumsum(n) - n, np.cumsum(sizes) - sizes
    label = np.unique(np.array(part, dtype=object), return_inverse=True)[1]
    side = np.array(first, bool)
    out = []
    for i in np.flatnonzero(side if not whole else np.ones(m, bool)).tolist():
        other = label != label[i]
        other &= (np.arange(m) > i) if whole else ~side
        other &= 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
        if not other.any():
            continue
        t = token[base[i] : base[i] + sizes[i]]
        t = t[n[t] > 1]
        at = np.repeat(start[t] - (np.cumsum(n[t]) - n[t]), n[t]) + np.arange(int(n[t].sum()))
        same = np.bincount(holders[at], minlength=m)
        for j in np.flatnonzero(other & (100 * same >= percent * (sizes + sizes[i] - same))).tolist():
            if label[j] != label[i] and sure(i, j):
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int64)


def frequencies(texts: DataFrame, k: int) -> np.ndarray:
    """Shingles in each of ``CELLS`` cells, over all rows; shingles of one cell count together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n = Hasher(k), np.zeros(CELLS, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                np.add.at(n, _cells(hasher(text)), 1)
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array(at), pa.array(n[at])], ["cell", "n"])

    out = np.zeros(CELLS, np.int64)
    for r in texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most CELLS rows
        out[r.cell] = r.n
    return out


def rarest(h: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set of sorted hashes, so many that any set of the wanted similarity has one of them among its own rarest.

    Such sets have at least ``percent`` of each in common. So the common shingle that comes first by (count of its cell,
    hash), an order that all sets share, is followed by that many but one in both.
    """
    return h[np.lexsort((h, counts[_cells(h)]))][: len(h) + percent * len(h) // -100 + 1]


def linkable(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(star, node) of the members (star, node, part) that may be linked with a member of another part of their star.

    A member stays if one of its ``rarest`` shingles is one of another part's too. Shingle and star are named by one
    hash; where different ones share a name, a member more stays.
    """
    rows = members.select("star", "node", "part").join(texts, "node")
    counts = frequencies(rows, k)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hasher, keys = Hasher(k), []
        for star, text in zip(batch["star"].to_pylist(), batch["text"].to_pylist(), strict=True):
            own = rarest(hasher(text), counts, percent) ^ np.uint64(xxhash.xxh3_64_intdigest(star))
            keys.append((own * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
        return pa.record_batch([batch["star"], batch["node"], batch["part"], pa.array(keys, pa.list_(pa.int64()))], ["star", "node", "part", "keys"])

    made = settle(map_batches(rows, run, "star binary, node binary, part binary, keys array<long>"), "rarest")
    met = made.select("part", F.explode("keys").alias("key")).groupBy("key").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most")
    # A member is one number here, as it has many keys; two of the same number stay together.
    member = F.xxhash64("star", "node").alias("member")
    stay = made.select(member, F.explode("keys").alias("key")).join(met.select("key"), "key", "left_semi").select("member").distinct()
    return made.select("star", "node", member).join(stay, "member", "left_semi").select("star", "node")


def _tops(placed: DataFrame) -> DataFrame:
    """(star, top, all, members, parts): the largest part of each star, its shingles, members and parts."""
    per = placed.groupBy("star", "part").agg(F.sum("n").alias("n"), F.count("*").alias("m"))
    return per.groupBy("star").agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("all"), F.sum("m").alias("members"), F.count("*").alias("parts"))


def between(stars: DataFrame, parts: DataFrame, sizes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between members of one star that stand in different components.

    In a star, the members of the largest component needn't be compared with each other. They are dealt to blocks, the
    rest to others, and each two blocks of which one is of the rest meet in a group of their own. Stars of more than
    ``WIDE`` blocks keep only their ``linkable`` members.
    """
    centre = stars.select(F.col("a").alias("star"), F.col("b").alias("node")).union(stars.select("a", "a").distinct())
    placed = centre.join(sizes, "node").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).select("star", "node", "part", "n")
    # Two members of a star have been compared already.
    mixed = _tops(placed).where("parts > 1 and members > 2").select("star", (F.col("all") > WIDE * BLOCK).alias("wide"))
    placed = settle(placed.join(mixed, "star"), "placed")
    wide = placed.where("wide")
    if wide.limit(1).count():
        stay = settle(linkable(wide, texts, k, percent), "linkable")
        placed = placed.where("not wide").unionByName(wide.join(stay, ["star", "node"], "left_semi"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    top = _tops(placed).where("parts > 1").select("star", F.col("top.part").alias("big"), blocks(F.col("all") - F.col("top.n")).alias("rest"), blocks(F.col("top.n")).alias("bigs"))
    mixed = placed.join(top, "star").withColumn("in_big", F.col("part") == F.col("big"))
    deal = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    mixed = mixed.withColumn("own", F.when(F.col("in_big"), F.col("rest") + deal(F.col("bigs"))).otherwise(deal(F.col("rest"))))
    meets = F.when(F.col("in_big"), F.col("rest")).otherwise(F.col("rest") + F.col("bigs")) - 1
    met = mixed.withColumn("other", F.explode(F.sequence(F.lit(0), meets))).select("star", "node", "part", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))

    def run(key, table):
        hasher = Hasher(k)
        whole, nodes = key[1].as_py() == key[2].as_py(), table["node"].to_pylist()
        first = [b == key[1].as_py() for b in table["own"].to_pylist()]
        texts = table["text"].to_pylist()

        def sure(i: int, j: int) -> bool:
            a, b = shingles(words(texts[i]), k), shingles(words(texts[j]), k)
            return 100 * len(a & b) >= percent * len(a | b)

        links = joining_links([hasher(t) for t in texts], table["part"].to_pylist(), first, whole, percent, sure)
        return pa.table([pa.array([nodes[i] for i, _ in links], pa.binary()), pa.array([nodes[j] for _, j in links], pa.binary())], ["a", "b"])

    return met.join(texts, "node").groupBy("star", "x", "y").applyInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, component) by alternating large and small stars; component is the smallest node. Each round is stored in the shared folder; stars of few levels end in a few rounds."""
    both = lambda e: e.union(e.select("b", "a").toDF("a", "b"))
    edges = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while edges.limit(1).count():
        # Large star: larger neighbours of a node move to its smallest neighbour (itself included).
        near = both(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        old, edges = edges, settle(small, "edges")
        discard(old)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def groups(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) of every row.

    component_id is the smallest id reachable over links of sets with 100 * intersection >= percent * union; a row
    without words is linked with nothing. Rows of one id are one node, whatever their texts, and come out each; class_id
    is the smallest id with the row's set. Null ids are left out of links, with a null component.
    """
    docs = documents(docs, id_col, text_col)
    made = settle(sketches(docs, k), "sketches")
    nodes = made.where("digest is not null and doc_id is not null")
    # A class is named by the digest of its set; a row of the smallest id stands for it.
    classes = settle(nodes.groupBy(F.col("digest").alias("node")).agg(F.min(F.struct("doc_id", "t")).alias("own"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    banded = classes.select("node", F.explode("bands").alias("band"))
    # A star in each bucket of two or more: every member with the smallest.
    centres = settle(banded.groupBy("band").agg(F.min("node").alias("a"), F.count("*").alias("size")).where("size > 1").select("band", "a"), "centres")
    stars = settle(banded.join(centres, "band").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "stars")
    # The texts of members of stars move once.
    wanted = classes.join(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node")
    texts = docs.withColumn("t", F.xxhash64("text")).join(wanted.select("node", "own.doc_id", "own.t"), ["doc_id", "t"])
    texts = settle(texts.select("node", "text").dropDuplicates(["node"]), "texts")
    # Rows of one id: the other classes of an id are linked with its smallest.
    per_id = nodes.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least <> most")
    same_id = nodes.join(per_id, "doc_id").select(F.col("digest").alias("a"), F.col("least").alias("b")).distinct()
    sizes = classes.select("node", "n")
    links = confirm(stars, texts, k, percent)
    parts = components(links.union(same_id))
    more = settle(between(stars, parts, sizes, texts, k, percent), "between")
    parts = components(parts.toDF("a", "b").union(more)) if more.limit(1).count() else parts
    discard(centres, stars, texts, more)
    named = classes.select("node", F.col("own.doc_id").alias("class_id")).join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "component").select(F.col("node").alias("digest"), "class_id", "component_id")
    component = F.coalesce("component_id", "doc_id")
    own = F.when(F.col("doc_id").isNotNull(), F.struct("class_id", "component_id"))
    out = made.select("doc_id", "n", "digest").join(named, "digest", "left").withColumn("own", own).select("doc_id", "n", "own.*")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("doc_id")).alias("kept"), "class_id")
