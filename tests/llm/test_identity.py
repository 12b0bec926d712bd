"""Block naming, the manifest and whitening against brute force, on the given tables and on odd rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bidiagonal, licenses, manifest, naming, queries, whitening

SF = "/root/testdata/sf0.001"


def identities(rows):
    """Brute force of ``keep_one``: (doc_id, text) rows to sorted results."""
    clean = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(clean(t), []).append((-len(t or ""), d is None, d or 0, i))
    best = {c: min(g) for c, g in groups.items()}
    out = []
    for d, t in rows:
        _, none, keep, _ = best[clean(t)]
        out.append((d, None if none else keep, len(groups[clean(t)]), hashlib.sha256(clean(t).encode("utf-8", "surrogatepass")).hexdigest()))
    return sorted(map(str, out)), {c: g for c, g in groups.items()}


@pytest.mark.parametrize("size", [3, 64, 4096])
def test_block_naming(spark, size):
    """Blocks of a few bytes make many levels, whose odd ends and repeated pairs must not be mistaken."""
    r = random.Random(size)
    rows = [(None, "a b"), (7, None), (8, ""), (9, " \x0b\x0c\r\n"), (10, "ab"), (11, "a b"), (12, "é" * 1000), (13, " é" * 1000), (14, "é"), (3, "ab "), (3, "ab "), (2**40, "ab ")]
    rows += [(100 + i, "ab" * r.randint(1, 40)) for i in range(120)] + [(300 + i, "".join(r.choice("ab ") for _ in range(r.randint(0, 9)))) for i in range(80)]
    long = "".join(r.choice("abcde ") for _ in range(min(30_000, 100 * size)))
    rows += [(500, long), (501, long.replace(" ", "\t")), (502, long + "a"), (503, "a" + long[1:]), (504, long)]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, _row string, n int, name int").repartition(5)
    got = naming.keep_one(df, size=size).collect()
    want, groups = identities(rows)
    assert sorted(str((x.doc_id, x.keep_id, x.group_size, x.text_sha256)) for x in got) == want
    assert sum(x.kept for x in got) == len(groups) and all(x.doc_id == x.keep_id for x in got if x.kept)
    assert naming.keep_one(df.limit(0), size=size).count() == 0


def test_block_naming_draws_again(spark, monkeypatch):
    """Addresses that two blocks share are noticed, and another seed is taken."""
    real, seeds = naming._address, []

    def weak(block, seed):
        seeds.append(seed)
        return [F.length(block).cast("long"), F.lit(0).cast("long")] if seed == 0 else real(block, seed)

    monkeypatch.setattr(naming, "_address", weak)
    got = naming.keep_one(spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "a b")], "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.keep_id) for x in got) == [(1, 3), (2, 2), (3, 3)] and set(seeds) == {0, 1}


def H(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text) rows."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode('utf-8', 'surrogatepass'))}:{v}"

    def leaf(x, low):
        d, s, g, n, t = x
        if low and t is not None:
            t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        return H(*map(field, (d, s, g, n, t)))

    def tree(nodes):
        """Root, and each leaf's siblings on either side, level by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, a in enumerate(at):
                own = nodes[a // 8 * 8 : a // 8 * 8 + 8]
                paths[i].append(("".join(own[: a % 8]), "".join(own[a % 8 + 1 :])))
                at[i] = a // 8
            nodes = [H(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        return nodes[0], paths

    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    parts = {}
    for x in rows:
        parts.setdefault(x[2], []).append(x)
    langs, tops, found = sorted(parts, key=order), [], []
    for g in langs:
        own = sorted(parts[g], key=lambda x: (order(x[0]), leaf(x, False)))
        top, paths = tree([leaf(x, False) for x in own])
        tops.append(top)
        found.append((own, paths))
    root, above = tree(tops)
    out = []
    for (own, paths), top, up in zip(found, tops, above, strict=True):
        for x, path in zip(own, paths, strict=True):
            low = x[0] is not None and zlib.crc32(str(x[0]).encode()) % 3 == 0
            at = leaf(x, low)
            for left, right in path + up:
                at = H(left, at, right)
            out.append((x[0], leaf(x, False), top, root, H(*(a + b for a, b in path + up)), at, at == root))
    return sorted(map(str, out))


def manifest_rows(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert manifest_rows(queries.op12_manifest(spark, SF)) == brute_manifest([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, "de": 9}, {None: 65, "": 64, "Z": 1, "a": 513, "é": 7, "中": 2}, {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_manifest_of_odd_rows(spark, sizes):
    """Null and empty fields, repeated and null ids, last runs of one node, parts of one leaf, more parts than eight."""
    r, rows = random.Random(5), []
    for g, n in sizes.items():
        for i in range(n):
            d = r.choice([None, i, i, i, 3, 2**40 + i])
            rows.append((d, r.choice([None, "", "web"]), g, r.choice([None, 0, i]), r.choice([None, "", "Mixed CASE é", "lower"]) if i % 4 else "A" * 5_000))
    rows += rows[:3] if len(sizes) > 2 else []
    df = spark.createDataFrame([(*x, "c", "c", 1, "c") for x in rows], "doc_id long, source string, lang string, n_chars long, text string, part string, hash string, n int, path string").repartition(5)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    assert manifest_rows(manifest.verified(df, tampered)) == brute_manifest(rows)
    assert manifest.verified(df.limit(0), tampered).count() == 0


def matrix(kind, n=24):
    rng = np.random.default_rng(2)
    if kind == "clustered":  # close values, and some that are equal
        q, p = (np.linalg.qr(rng.standard_normal((n, n)))[0] for _ in range(2))
        return q @ np.diag([5, 5 - 1e-9, 5 - 2e-9, 4, 4, 4, *np.linspace(1, 2, n - 6)]) @ p
    a = rng.standard_normal((n, n))
    if kind == "graded":
        return a * 10.0 ** -np.arange(n)
    if kind == "low rank":
        return a[:, :5] @ rng.standard_normal((5, n))
    if kind == "equal columns":
        a[:, 7] = a[:, 3]
    if kind == "diagonal":
        return np.diag([3.0, 3.0, 0.0, 1.0, 2.0, *[0.5] * (n - 5)])
    return np.zeros((n, n)) if kind == "zero" else a


@pytest.mark.parametrize("kind", ["random", "clustered", "graded", "low rank", "equal columns", "diagonal", "zero"])
def test_qd(kind):
    a = matrix(kind)
    d, u, p = bidiagonal.bidiagonal(a)
    want = np.linalg.svd(a, compute_uv=False)
    got = np.sqrt(bidiagonal.squared_singular_values(d, u))
    assert np.allclose(got, want, rtol=1e-12, atol=1e-13 * max(1.0, want[0])) and np.allclose(p.T @ p, np.eye(len(p)), atol=1e-13)
    v = p @ bidiagonal.right_vectors(d, u, got[:8][got[:8] > 1e-10] ** 2)
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-9)
    assert np.allclose(np.linalg.norm(a @ v, axis=0), got[: v.shape[1]], rtol=1e-9)
    assert np.allclose(a.T @ (a @ v), v * got[: v.shape[1]] ** 2, atol=1e-11 * max(1.0, want[0]) ** 2)


def check_whitening(vectors, got, most=8):
    """vectors: {vec_id: list} of those that stay."""
    x = {i: [math.floor(1024 * float(c)) + 100_000 for c in v] for i, v in vectors.items()}
    n, d = len(x), len(next(iter(x.values())))
    s = [sum(v[k] for v in x.values()) for k in range(d)]
    centred = {i: np.array([(v[k] * n - s[k]) / n for k in range(d)]) for i, v in x.items()}
    cov = sum(np.outer(c, c) for c in centred.values()) / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    rank = min(most, int((values > 1e-9 * values[0]).sum())) if values[0] > 0 else 0
    assert len(got) == n * rank
    sign = {}
    for r in sorted(got, key=lambda r: (r.component, r.vec_id)):
        k = r.component - 1
        assert r.n == n and r.deviation == sum((n * a - b) ** 2 for a, b in zip(x[r.vec_id], s, strict=True))
        assert abs(r.explained / (values[k] / np.trace(cov)) - 1) < 1e-9 and r.identity_error < 1e-8
        want = centred[r.vec_id] @ vecs[:, k] / math.sqrt(values[k])
        if abs(want) > 1e-3:
            sign.setdefault(k, np.sign(want * r.whitened))
        assert abs(r.whitened - sign.get(k, 1) * want) < 1e-6 or abs(want) <= 1e-3 and abs(abs(r.whitened) - abs(want)) < 1e-6


def test_whitening(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_whitening({r.vec_id: r.embedding for r in rows}, queries.op13_whitening(spark, SF).collect())


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    kind = "vec_id long, embedding array<float>, component int, v string, n string"
    good = {i: [float(np.float32(c)) for c in rng.normal(size=5) * [4, 2, 1, 0.5, 0]] for i in range(40)}
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [1.0, float("inf"), 0.0, 0.0, 0.0]), (104, [1.0, 2.0]), (105, [])]
    make = lambda rows: spark.createDataFrame([(i, v, 1, "c", "c") for i, v in rows], kind).repartition(3)
    check_whitening(good, whitening.components(make([*good.items(), *bad])).collect())
    assert whitening.components(make([(1, [1.0, 2.0]), (None, [1.0, 2.0])])).count() == 0
    assert whitening.components(make([(1, [1.0, 2.0]), (2, [1.0, 2.5])]).limit(0)).count() == 0
    three = whitening.components(make([(None, [1.0, 2.0]), (2, [1.0, 2.5]), (2, [1.0, 2.5])])).collect()
    assert sorted(str(r.vec_id) for r in three) == ["2", "2", "None"] and {r.component for r in three} == {1}


def test_deviations_beyond_a_long():
    x = np.array([[3_000_000, 0], [1, 2]], np.int64)
    assert whitening.deviations(x, 10**6, np.array([0, 0])).to_pylist() == [None, 10**12 + 4 * 10**12]


def test_notices_with_edits():
    """Notices with as many edits as they may have are found, at the words where they stand; exact phrases are told from brute force."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    found = tried = 0
    for notice, (label, k) in licenses.NOTICES.items():
        for _ in range(25):
            edits, text = r.randint(0, k), list(notice)
            for _ in range(edits):
                at = r.randrange(1, len(text) - 1)
                kind = r.choice("sid")
                text[at : at + (kind != "i")] = [] if kind == "d" else [r.choice("abcxyz")]
            before = [word() for _ in range(r.randint(0, 30))]
            n, spans = licenses.scan_text(" ".join([*before, "".join(text), *(word() for _ in range(r.randint(0, 30)))]))
            tried += 1
            found += any(s["label"] == label and abs(s["first_word"] - len(before)) <= 1 and s["edits"] <= k for s in spans)
    assert tried >= 100 and found >= 0.98 * tried
    for _ in range(300):
        own = [r.choice([*"abc", "under", "the", "mit", "license", "apache", "version", "2", "cc", "by", "nc"]) for _ in range(r.randint(0, 60))] + r.choice([[], "under the mit license".split(), "apache license version 2".split(), "cc by nc".split()])
        want = sorted((label, i) for phrase, label in licenses.PHRASES.items() for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split())
        n, spans = licenses.scan_text(r.choice([" ", ".\n"]).join(own).upper())
        assert n == len(own) and sorted((s["label"], s["first_word"]) for s in spans if s["exact"]) == want


def test_words_and_marks_are_known_apart():
    """A known word before a known mark or line end takes no place in memory, and ids are the library's when memory runs over."""
    from tokenizers import Tokenizer

    from tidemark.llm.queries import tokenizer_path
    from tidemark.llm.tokenize import Encoder

    own, library = Encoder(tokenizer_path(), memo=40), Tokenizer.from_file(tokenizer_path())
    texts = ["word, other. new\nword", "word. other, new\nother", " word", "it's 'it' don't!! é, ué.\nÉ", "a  b \n c\t\x1cd 12-3 x,1", "", "日本, ab日本 ab, (ab) a_b", "word,\r\nnew word"]
    texts += [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}," for k in range(90)), "word, other."]
    seen = []
    for text in texts:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
        seen.append(len(own.memo))
    assert seen[1] == seen[0] + 1 and max(seen) <= 40  # " other" after a line end is the one new piece
