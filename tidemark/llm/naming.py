"""Exact dedup by deterministic block naming, in DataFrame functions alone.

A text without whitespace is cut into blocks of a fixed number of bytes. Distinct blocks, sorted, get integers: their
names. Then adjacent names of a document are paired, distinct pairs, sorted, get names again, and so on until each
document has one name; with the number of its blocks that is its identity. Two documents share it only if they are
equal: blocks are told apart by their bytes and pairs by their integers, never by hashes alone.

Blocks travel once, to be sorted. An occurrence of a block finds its name by the block's address, two 64-bit hashes;
that no two blocks share an address is counted on the bytes themselves, and a seed under which two do is drawn again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, settle

SPACES = " \t\n\x0b\x0c\r"
#: A key is hot with over a thousandth of all rows, so that there are fewer than a thousand of them, whatever the input.
HOT = 1_000


def without_spaces(text: Column) -> Column:
    """The text without any character of 0x20 and 0x09 to 0x0D; a null text is empty."""
    return reduce(lambda c, x: F.replace(c, F.lit(x), F.lit("")), SPACES, F.coalesce(text, F.lit("")))


def _blocks(docs: DataFrame, text: str, size: int) -> DataFrame:
    """``docs`` with ``_blocks``, the blocks of the text as bytes; an empty text is one empty block."""
    # Bytes, not characters: a slice of bytes needs no walk from the start of a very long text.
    raw = docs.withColumn("_raw", F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))
    last = F.floor((F.greatest(F.octet_length("_raw"), F.lit(1)) - 1) / size).cast("int")
    return raw.withColumn("_blocks", F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("_raw"), i * size + 1, F.lit(size))))


def _address(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + k), block) for k in (0, 1)]


def _named(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct rows of ``by`` with their number ``n`` and an integer ``name``: the place in the sorted partition that holds them."""
    return keys.groupBy(*by).agg(F.count("*").alias("n")).sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _attach(rows: DataFrame, names: DataFrame, by: list[str], total: int, values: list[str]) -> DataFrame:
    """``rows`` with the values of their key. Keys of over a thousandth of all rows, fewer than a thousand, are broadcast; the others are joined by key."""
    limit = max(total // HOT, 1)
    hot, cold = (names.where(c).select(*by, *values) for c in (F.col("n") > limit, F.col("n") <= limit))
    few = F.broadcast(hot)
    return rows.join(few, by).unionByName(rows.join(few.select(*by), by, "left_anti").join(cold, by))


def identities(docs: DataFrame, *, text: str = "text", size: int = 4096) -> tuple[DataFrame, DataFrame, int]:
    """(rows, names, number of rows): a stored table of the rows of ``docs`` with an integer ``_row``, and each row's ``_m`` and ``_name``.

    Rows have equal (_m, _name) if and only if their texts are equal. Columns of ``docs`` other than the text are kept;
    they mustn't start with an underscore. Null texts are empty; an empty table gives empty tables.
    """
    seed = 0
    while True:
        # Distinct blocks are compared by their bytes; a seed is kept if no two of them have one address.
        cut = _blocks(docs.select(text), text, size).select(F.explode("_blocks").alias("_b"))
        names = settle(_named(cut.select(*(h.alias(c) for h, c in zip(_address(F.col("_b"), seed), ("h", "g"), strict=True)), "_b"), ["h", "g", "_b"]).drop("_b"), "block-names")
        clash = names.groupBy("h", "g").agg(F.count("*").alias("k")).where("k > 1").limit(1).count()
        if not clash:
            break
        discard(names)
        seed += 1
    own = F.transform("_blocks", lambda b: F.struct(*(h.alias(c) for h, c in zip(_address(b, seed), ("h", "g"), strict=True))))
    rows = settle(_blocks(docs, text, size).select(*(c for c in docs.columns if c != text), own.alias("_a")).withColumn("_row", F.monotonically_increasing_id()), "block-rows")
    n, total, longest = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("_a")), F.lit(0)), F.coalesce(F.max(F.size("_a")), F.lit(1))).first()
    flat = rows.select("_row", F.size("_a").alias("m"), F.posexplode("_a").alias("pos", "a")).select("_row", "m", "pos", "a.h", "a.g")
    level = settle(_attach(flat, names, ["h", "g"], total, ["name"]).select("_row", "m", "pos", "name"), "names-0")
    done, k, left = [], 0, longest
    while True:
        done.append(level.where("m = 1").select("_row", F.lit(k).alias("_m"), F.col("name").alias("_name")))
        if left <= 1:
            return rows.drop("_a"), reduce(DataFrame.unionByName, done), n
        k, left = k + 1, (left + 1) // 2
        one = lambda r: F.max(F.when(F.col("pos") % 2 == r, F.col("name")))
        pairs = level.where("m > 1").groupBy("_row", F.floor(F.col("pos") / 2).cast("int").alias("p")).agg(((F.max("m") + 1) / 2).cast("int").alias("m"), one(0).alias("l"), F.coalesce(one(1), F.lit(-1)).alias("r"))
        names = settle(_named(pairs, ["l", "r"]), f"pair-names-{k}")
        total = names.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        level = settle(_attach(pairs, names, ["l", "r"], total, ["name"]).select("_row", "m", F.col("p").alias("pos"), "name"), f"names-{k}")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4096) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row: of texts that are equal without whitespace one row stays.

    That is the row with the most code points, then of the smallest id (null ids last), then the first read. Rows of one
    id are rows of their own, of which one at most stays; null texts are empty and equal to all texts of whitespace alone.
    ``text_sha256`` is of the text without whitespace. Other columns don't matter; an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = own.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"), without_spaces(F.col("text")).alias("clean"))
    rows, names, total = identities(own.withColumn("sha", F.unhex(F.sha2("clean", 256))), text="clean", size=size)
    named = settle(rows.join(names, "_row"), "named")
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("doc_id").isNull().alias("e"), "doc_id", "_row"))
    groups = settle(named.groupBy("_m", "_name").agg(F.count("*").alias("n"), best.alias("b")).select("_m", "_name", "n", F.col("b.doc_id").alias("keep_id"), F.col("b._row").alias("_keep")), "groups")
    out = _attach(named, groups, ["_m", "_name"], total, ["n", "keep_id", "_keep"])
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("_row") == F.col("_keep")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
