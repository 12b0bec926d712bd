"""A manifest of a table as a Merkle tree whose nodes carry the interval of leaf ranks they cover.

Rows of a part (a language) are ranked by id; eight consecutive nodes make a node of the level above. A node's label is
its interval [lo, hi) of leaf ranks. Ancestors are found by containment: a node's interval lies in its parent's, and
both stand in one bucket of the parent's level. What is left of the parent's interval without the node's are its
siblings. From the root down each node takes over its ancestors' siblings, so that a leaf gets its whole proof in one
join, and a proof is folded in the row itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settle

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts that follow one another."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: dict[str, Column]) -> Column:
    """Digest of a row: of each field ``-`` if it is null, else its length in bytes, a colon and the value."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return digest(*(one(values[f]) for f in FIELDS))


def _ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` (with ``part``) with their rank in the part by ``by``, and ``n``, the rows of the part.

    Rows are sorted in ranges, whatever the size of a part; the rows of each part in each range are counted, and sums of
    these counts, a row for each part and range, say where a range's ranks begin.
    """
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    stored = settle(dealt.repartitionByRange("part", *by, "_tie").sortWithinPartitions("part", *by, "_tie").drop("_tie").withColumn("_at", F.monotonically_increasing_id()), name)
    stored = stored.withColumn("_range", F.shiftright("_at", 33))
    runs = stored.groupBy("part", "_range").agg(F.count("*").alias("k"), F.min("_at").alias("_first"))
    w = Window.partitionBy("part")
    starts = runs.withColumns({"n": F.sum("k").over(w), "_before": F.sum("k").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("k")}).drop("k")
    return stored.join(starts, ["part", "_range"]).withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop("_range", "_at", "_first", "_before")


@dataclass
class Tree:
    """Stored levels of the trees of all parts: (part, n, lo, hi, hash), above the leaves with ``kids``, the labels and digests of the children."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """(part, hash): the digest at the top of each part."""
        found = None
        for k, rows in enumerate(self.levels):
            own = rows.where(_width(k) == 1).select("part", "hash")
            found = own if found is None else found.unionByName(own)
        return found


def _width(level: int) -> Column:
    """Nodes of a part at a level."""
    return F.ceil(F.col("n") / F.lit(FAN**level))


def _bucket(level: int, lo: str = "lo") -> Column:
    return F.floor(F.col(lo) / F.lit(FAN**level)).cast("long")


def _grow(leaves: DataFrame, most: int, name: str) -> Tree:
    """All levels above stored leaves (part, n, lo, hi, hash)."""
    levels, k = [leaves], 0
    while most > 1:
        below = levels[-1].where(_width(k) > 1)
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "hash")))  # eight at most
        up = below.groupBy("part", "n", _bucket(k + 1).alias("_b")).agg(kids.alias("kids"))
        up = up.select("part", "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), F.sha2(F.array_join(F.transform("kids", lambda c: c.hash), ""), 256).alias("hash"), "kids")
        k, most = k + 1, -(-most // FAN)
        levels.append(settle(up, f"{name}-{k}"))
    return Tree(levels)


def _sides(x: str, kids: Column) -> Column:
    """What is left of the parent's interval without the node's, on either side: digests of the siblings."""
    text = lambda keep: F.array_join(F.transform(F.filter(kids, keep), lambda c: c.hash), "")
    return F.struct(text(lambda c: c.hi <= F.col(f"{x}.lo")).alias("left"), text(lambda c: c.lo >= F.col(f"{x}.hi")).alias("right"))


_PATH = "array<struct<left:string,right:string>>"


def _paths(tree: Tree, above: DataFrame | None) -> DataFrame:
    """The leaves with ``path``: the siblings on either side, level by level up to the top of the part, then those of ``above`` (part, path and other columns)."""
    extra = [c for c in above.columns if c not in ("part", "path")] if above is not None else []
    start = (lambda d: d.join(above, "part")) if above is not None else (lambda d: d.withColumn("path", F.array().cast(_PATH)))
    out = None
    for k in range(len(tree.levels) - 1, -1, -1):
        rows = start(tree.levels[k].where(_width(k) == 1))
        if out is not None:
            x, p = tree.levels[k].where(_width(k) > 1).withColumn("_b", _bucket(k + 1)).alias("x"), out.withColumn("_b", _bucket(k + 1)).alias("p")
            inside = (F.col("x.part") == F.col("p.part")) & (F.col("x._b") == F.col("p._b")) & (F.col("p.lo") <= F.col("x.lo")) & (F.col("x.hi") <= F.col("p.hi"))
            path = F.concat(F.array(_sides("x", F.col("p.kids"))), F.col("p.path"))
            joined = x.join(p, inside).select(*(F.col(f"x.{c}") for c in tree.levels[k].columns), path.alias("path"), *(F.col(f"p.{c}") for c in extra))
            rows = rows.select(joined.columns).unionByName(joined)
        out = rows
    return out


@dataclass
class Manifest:
    """``rows``: the leaves with doc_id, part, hash and what was kept; ``tree`` above them; ``top`` above the parts; ``root``, null for an empty table."""

    tree: Tree
    top: Tree
    root: str | None

    def proofs(self) -> DataFrame:
        """Each leaf with ``subroot``, ``root`` and ``path``, its proof: siblings on either side, level by level."""
        above = _paths(self.top, None).select(F.col("name").alias("part"), F.col("hash").alias("subroot"), "path")
        return _paths(self.tree, above).withColumn("root", F.lit(self.root)).drop("n", "lo", "hi")


def build(docs: DataFrame, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text); ``keep`` are more columns of the leaves, by name.

    A row is a leaf: rows of one id follow one another in the order of their digests, null ids come first, null languages
    are a part of their own that comes first, and null or empty texts are fields like others. Other columns than those
    five aren't read. An empty table has no leaves and the root null.
    """
    part = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # in the order of languages, null first
    rows = settle(docs.select("doc_id", part.alias("part"), leaf({f: F.col(f) for f in FIELDS}).alias("hash"), *(c.alias(n) for n, c in (keep or {}).items())), "leaf-rows")
    leaves = settle(_labelled(_ranked(rows, ["doc_id", "hash"], "leaf-order")), "leaves")
    tree = _grow(leaves, leaves.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0], "nodes")
    tops = tree.tops().select(F.lit("").alias("part"), F.col("part").alias("name"), "hash")
    above = settle(_labelled(_ranked(tops, ["name"], "part-order")), "parts")
    top = _grow(above, above.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0], "top")
    root = top.tops().first()
    return Manifest(tree, top, root.hash if root else None)


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1}).drop("rank")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s.left, s.right)), ""), 256)


def folded(hash_: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""
    return F.aggregate(path, hash_, lambda acc, s: digest(s.left, acc, s.right))


def tampered_leaf() -> Column:
    """The digest of a row whose text has its A to Z in lower case."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return leaf({f: low if f == "text" else F.col(f) for f in FIELDS})


def verified(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every row against the manifest of ``docs``, rows of ``tampered`` with their text in lower case."""
    proofs = build(docs, {"seen": F.when(tampered, tampered_leaf())}).proofs()
    out = proofs.withColumn("folded_root", folded(F.coalesce("seen", "hash"), F.col("path")))
    return out.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
