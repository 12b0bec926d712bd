"""Operators against brute force, round trips and held-out accuracy, with nulls, empty texts, repeats and clashing columns."""

import hashlib
import io
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import boost, decontaminate, language_model, licenses, neardup, packing, quality, repeats, sketch, tokenfile, toxicity
from tidemark.llm.queries import QUERIES, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _t string, h int"


def corpus(n=60, seed=3):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(120)]
    line = " ".join(r.choice(vocab) for _ in range(18))
    out = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.randint(5, 90))]
        if i % 7 == 3 and out:
            words = out[-1].split()
            words[r.randrange(len(words))] = "changed"
        if i % 5 == 0:
            words[2:2] = line.split()
        out.append(" ".join(words))
    out += [out[4], out[4], "", None, "x", "ab " * 300, "é" * 70 + line, "\n" + line + "\nöß " + line]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "clash", 7) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_repeats(rows, docs, empty):
    first, want = {}, {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first.setdefault(b[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[i] = (kept, len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])))
    got = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(docs).collect()}
    assert got == want
    assert repeats.remove_repeats(empty).count() == 0


def test_collection_order(tmp_path):
    strings = [b"banana", b"ananas", b"banana", b"b"]
    s, off, lcp = repeats.collection(strings, str(tmp_path))
    tails = [strings[i][o:] for i, o in zip(s, off)]
    assert tails == sorted(tails)
    for a, b, n in zip(tails, tails[1:], lcp[1:]):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        assert n == k


@pytest.mark.parametrize("k", [2, 5])
def test_neardup(rows, docs, empty, k):
    sets = {i: neardup.shingles(neardup.words(t), k) for i, t in rows}
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= 80 * len(sets[a] | sets[b]):
                part[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs, k=k).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in sets}
    assert neardup.groups(empty).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """Rows of one id are one node whatever their texts, so a link of either reaches the other."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (5, b), (8, b + " more"), (9, a + " more"), (11, "alone here"), (5, b), (None, b), (12, None), (13, " \n")]
    got = neardup.groups(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None) == [(5, 5, True)] * 3 + [(8, 5, False), (9, 5, False), (11, 11, True), (12, 12, True), (13, 13, True)]
    assert [(r.component_id, r.class_id) for r in got if r.doc_id is None] == [(None, None)]


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A family whose members often lie just under the similarity of one another: no link is lost, in one block or in many."""
    r = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for p in r.sample(range(60), r.choice((2, 2, 2, 3))):
            w[p] = f"x{i}-{p}"
        rows.append((i, " ".join(w)))
    sets = {i: neardup.shingles(neardup.words(t), 2) for i, t in rows}
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                part[max(find(a), find(b))] = min(find(a), find(b))
    want = {i: find(i) for i in sets}
    assert 1 < len(set(want.values())) < 150
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for block, wide in ((neardup.BLOCK, neardup.WIDE), (1500, neardup.WIDE), (1500, 1)):
        monkeypatch.setattr(neardup, "BLOCK", block)
        monkeypatch.setattr(neardup, "WIDE", wide)
        assert {r.doc_id: r.component_id for r in neardup.groups(table, k=2).collect()} == want


def test_rarest_shingles_keep_all_links(spark):
    """Members of one star: all that are linked with another part stay, with any counts; those far from all others go."""
    r = random.Random(11)
    base, texts = [f"w{i}" for i in range(80)], {}
    for i in range(120):
        w = list(base)
        for p in r.sample(range(80), r.choice((1, 2, 7, 20)) if i % 2 else 40):
            w[p] = f"x{r.randint(0, 3)}-{p}" if i % 3 == 0 else f"x{i}-{p}"
        texts[i] = " ".join(w)
    name = {i: bytes([i]) for i in texts}
    sets = {i: neardup.shingles(neardup.words(t), 2) for i, t in texts.items()}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    must = {a for a in texts for b in texts if a % 7 != b % 7 and linked(a, b)}
    members = spark.createDataFrame([(b"star", bytearray(name[i]), bytearray([i % 7])) for i in texts], "star binary, node binary, part binary")
    table = spark.createDataFrame([(bytearray(name[i]), t) for i, t in texts.items()], "node binary, text string")
    stay = {bytes(x.node)[0] for x in neardup.linkable(members, table, 2, 80).collect()}
    assert must and must <= stay and len(stay) < 0.7 * len(texts), (len(must), len(stay))
    hasher, counts = neardup.Hasher(2), np.array([r.randint(0, 9) for _ in range(neardup.CELLS)])
    front = {i: set(neardup.rarest(hasher(t), counts, 80).tolist()) for i, t in texts.items()}
    assert all(front[a] & front[b] for a in texts for b in texts if linked(a, b))
    assert len(neardup.rarest(np.array([5], np.uint64), counts, 80)) == 1


def test_language_model(rows, docs, empty):
    words = {i: neardup.words(t) for i, t in rows}
    pairs, single = Counter(), Counter()
    for w in words.values():
        single.update(w)
        pairs.update(zip([None, *w], w))
    n, single[None] = sum(single.values()), sum(map(bool, words.values()))
    got = {r.doc_id: (r.n_words, r.log_score) for r in language_model.score(docs).collect()}
    for i, w in words.items():
        own = Counter(zip([None, *w], w))
        want = sum(math.log((pairs[p] - own[p]) / single[p[0]]) if pairs[p] > own[p] else math.log(0.4 * single[p[1]] / n) for p in zip([None, *w], w))
        assert got[i][0] == len(w) and abs(got[i][1] - want) < 1e-4
    assert language_model.score(empty).count() == 0


@pytest.mark.parametrize("order", [1, 3, 4])
def test_language_model_orders(rows, docs, spark, order):
    phrase = " ".join(rows[1][1].split()[:9])
    rows = [*rows, *((1000 + i, f"{phrase} {phrase} tail{i}") for i in range(40)), (2000, "\n "), (5, phrase)]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows[-42:], "doc_id long, text string")).union(spark.createDataFrame([(None, "not counted")], "doc_id long, text string"))
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append([None, *neardup.words(t)] if neardup.words(t) else [])
    grams = lambda w, k: [tuple(w[max(0, k - m + 1) : k + 1]) for m in range(1, min(order, k + 1) + 1)]
    own = {i: Counter(g for w in ws for k in range(len(w)) for g in grams(w, k)) for i, ws in texts.items()}
    total = sum(own.values(), Counter())
    n = sum(c for g, c in total.items() if len(g) == 1 and g != (None,))
    got = {r.doc_id: r for r in language_model.score(more, order=order, chunk=700, bucket=900).collect()}
    assert set(got) == set(texts)
    for i, ws in texts.items():
        want, size = 0.0, 0
        for w in ws:
            for k in range(1, len(w)):
                gs, size = grams(w, k), size + 1
                g = next((g for g in gs[:0:-1] if total[g] > own[i][g]), gs[0])
                part = (total[g] - own[i][g]) / total[g[:-1]] if len(g) > 1 else total[g] / n
                want += math.log(part * 0.4 ** (len(gs) - len(g)))
        assert got[i].n_words == size and abs(got[i].log_score - want) < 1e-4


def test_language_model_hot_pairs_meet_once_a_chunk(spark):
    table = spark.createDataFrame([(i, "same pair " * 50, i % 4) for i in range(200)], "doc_id long, text string, chunk int")
    for order in (1, 2, 3):
        asks = language_model.asked(table, order, 1).collect()
        assert len(asks) == 4 and all(len(r.grams) == 6 * 3 for r in asks)


def test_fingerprints(rows, docs, empty):
    got = {r.doc_id: r for r in sketch.fingerprints(docs).collect()}
    order = sorted(rows, reverse=True)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        new = sketch.edited(t or "", nxt or "")
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert got[i].n_chars == len(t or "")
        a, b = set(sketch.digests(t or "").tolist()), set(sketch.digests(new).tolist())
        assert got[i].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert sketch.fingerprints(empty).count() == 0


@pytest.mark.parametrize("least, most, n", [(300, 400, 3000), (190, 500, 2000), (1, 3, 40)])
def test_search_beats_best_fit(least, most, n):
    """Sizes of which few fit a bin: exchanges empty bins that best fit leaves, every piece stays, no bin overflows."""
    sizes = np.random.default_rng(0).integers(least, most + 1, n)
    first = packing.best_fit(sizes, 1024)
    bins = packing.local_search(sizes, first.copy(), 1024)
    fill = np.bincount(bins, sizes)
    assert len(bins) == n and fill.max() <= 1024 and fill.min() > 0 and (fill**2).sum() >= (np.bincount(first, sizes) ** 2).sum()
    assert -(-sizes.sum() // 1024) <= bins.max() + 1 <= first.max() + 1
    if most > 3:
        assert bins.max() + 1 < 0.99 * (first.max() + 1)


def removed(texts, length):
    """Brute force: the bytes that stay of each text."""
    first, out = {}, []
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first.setdefault(b[p : p + length], i) < i:
                gone[p : p + length] = b"\1" * length
        out.append(bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("length, hot", [(50, 3), (300, 50_000)])
def test_repeats_of_hot_anchors_and_long_strings(spark, monkeypatch, length, hot):
    """A line in many different surroundings, texts of any length, repeated rows and ids, and strings of over 255 bytes."""
    r = random.Random(2)
    noise = lambda n: "".join(r.choice("abcdef ") for _ in range(n))
    line, page = noise(70), noise(900)
    texts = [noise(40) + line + noise(60) for _ in range(30)] + [page, page[:400] + noise(50), noise(9) + page[300:] + line, "ab" * 400, page, "x" + "ab" * 300, noise(200_000) + page[100:500]]
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SLICES", 40)
    rows = [*enumerate(texts), (3, texts[3]), (None, page), (30, page)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), length=length).collect()
    want = removed(texts, length)
    assert sorted((r.doc_id, bytes(r.kept)) for r in got if r.doc_id is not None) == sorted([*enumerate(want), (3, want[3]), (30, want[30])])
    assert [(bytes(r.kept), r.n_removed) for r in got if r.doc_id is None] == [(page.encode(), 0)]


def test_stored_fingerprints(docs):
    """The likeness of a row and its next one comes out of the two stored fingerprints alone; equal texts have equal ones."""
    got = sorted(sketch.fingerprints(docs).collect(), key=lambda r: -r.doc_id)
    for r, after in zip(got, got[1:] + got[:1]):
        assert sketch.stored_likeness(r.fingerprint, r.edited_fingerprint) == pytest.approx(r.near_edited)
        assert sketch.stored_likeness(r.fingerprint, after.fingerprint) == pytest.approx(r.near_next)
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    b = np.unique(np.r_[a[:3900], rng.integers(0, 1 << 63, 700).astype(np.uint64)])
    x, y = sketch.fingerprints_of(sketch.Sets([a, b]))
    assert sketch.stored_likeness(x, y) == pytest.approx(3900 / len(np.union1d(a, b))) and sketch.stored_likeness(x, x) == 1


def test_peeling_retries():
    r = np.random.default_rng(1)
    a, b = np.unique(r.integers(0, 2**63, 500).astype(np.uint64)), np.unique(r.integers(0, 2**63, 400).astype(np.uint64))
    x, y, cells = sketch.difference(np.unique(np.r_[a, b[:100]]), b)
    assert set(x.tolist()) == set(a.tolist()) and set(y.tolist()) == set(b[100:].tolist()) and cells > sketch.CELLS


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got = packing.pack_documents(docs, tokenizer_path(), length=64).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d in docs.collect():
        ids = [*t.encode(d.text or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) == len(ids)
        assert all(r.length == 64 for r in own[1:]) and all(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in own)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_seq) <= math.ceil(sum(r.length for r in got) / 64) + 2
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_local_search_improves():
    sizes = np.array([60, 50, 45, 40, 30, 30, 25, 20])
    bins = packing.local_search(sizes, np.arange(8), 100)
    fill = np.bincount(bins, sizes)
    assert fill.max() <= 100 and np.count_nonzero(fill) == 3


def test_token_files(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got, start = {r.doc_id: r for r in tokenfile.round_trip(docs, tokenizer_path()).collect()}, 0
    for d in sorted(docs.collect()):
        ids = np.array([*t.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[d.doc_id].start, got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokenfile.round_trip(empty, tokenizer_path()).count() == 0


def test_token_file_damage():
    out = io.BytesIO()
    w = tokenfile.Writer(out, 2)
    w.add(5, np.arange(500))
    w.add(9, np.arange(3))
    w.close()
    raw = bytearray(out.getvalue())
    r = tokenfile.Reader(io.BytesIO(bytes(raw)), len(raw))
    assert r.find(9)[0].tolist() == [0, 1, 2] and r.find(6) == []
    raw[30] ^= 255
    with pytest.raises(Exception):
        tokenfile.Reader(io.BytesIO(bytes(raw)), len(raw)).ids(0)


@pytest.mark.parametrize("text", ["a  b", " x", "x ", " \n y", "it's 's don't", "日本 語", "ab日", "1,234 x²", "<|endoftext|> a", "\x1c a", "a\tb c", "  ", "\n\n a", "x'll 'll y", "ǆabc ßx", "a \nb", "é́ x", " a b"])
def test_encoder(text):
    from tidemark.llm.tokenize import encoder

    e = encoder(tokenizer_path())
    assert e.encode(text).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_licenses(spark, empty):
    rows = [(1, "Released Under the MIT   License.\nmore", *[None] * 5), (2, "licensed under the apche licence version 2 0", *[None] * 5), (3, None, *[None] * 5), (4, "CC-BY-NC cc by nc", *[None] * 5), (5, "under the mit licensed", *[None] * 5)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    exact = lambda i: [(s.label, s.first_word) for s in got[i].spans if s.exact]
    assert exact(1) == [("mit", 1)] and got[1].n_words == 6 and exact(2) == [] and [s.label for s in got[2].spans] == ["apache-2"] and 0 < got[2].score < 1
    assert got[3].n_words == 0 and got[3].spans == [] and exact(4) == [("cc-by-nc", 0), ("cc-by-nc", 3)] and exact(5) == []
    assert licenses.scan(empty).count() == 0


def test_additive_model_learns_pairs():
    r = np.random.default_rng(5)
    x = r.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = boost.fit_additive(x[:2000], y[:2000])
    assert ((m.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    assert boost.fit_additive(np.zeros((0, 4)), np.zeros(0)).score(x[:3]).tolist() == [0.5] * 3


@pytest.mark.parametrize("name,label,low", [("op1_quality", "quality", 0.95), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, low):
    folder = "/root/testdata/sf0.1"
    got = QUERIES[name](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    hit, n = got.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()
    assert n > 500 and hit > low


def test_classifiers_without_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for m in (quality, toxicity):
        got = m.score(docs, m.fit(docs, none))
        assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
        assert m.score(empty, m.fit(empty, none)).count() == 0


def test_decontamination(spark, rows, docs, empty):
    item = rows[1][1]
    words = item.split()
    words[3:5] = ["quite", "other"]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900, "before this " + item + " after"), (901, "so " + " ".join(words) + " on")], "doc_id long, text string"))
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "nothing like any of these at all")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(more, bench).collect()}
    assert {(1, 7), (900, 7), (901, 7)} <= got and all(i == 7 for _, i in got)
    assert decontaminate.contaminated(empty, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_of_long_items(spark):
    r = random.Random(8)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    long, middle, short = text(400), text(100), text(12)
    edited = [w if k % 6 else "other" for k, w in enumerate(long)]
    docs = {1: text(700) + long + text(300), 2: text(90) + middle[25:75] + text(90), 3: text(50) + edited, 4: text(2000), 5: text(77) + short + text(40), 6: text(33) + long[170:234] + text(9), 7: long[:15] + text(100)}
    bench = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(middle)), (3, " ".join(short))], "item_id long, text string")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {(x.doc_id, x.item_id): x for x in decontaminate.contaminated(table, bench).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 1), (5, 3), (6, 1)}
    assert got[1, 1].lcs == 1 and got[3, 1].lcs > 0.8 and got[2, 2].first_word <= 90 and got[2, 2].last_word >= 139


def test_decontamination_recall(spark):
    """Every document and item of a whole table with a common subsequence in a stretch of twice the item's length."""
    folder = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    items = [(x.item_id, decontaminate.words(x.text)) for x in bench.collect()]
    got, want = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs, bench).collect()}, set()
    for d in docs.collect():
        ws = decontaminate.words(d.text)
        for i, own in items:
            n, held = len(own), Counter(own)
            for k in range(0, max(1, len(ws) - n), n):
                part = ws[k : k + 2 * n]
                if (held & Counter(part)).total() >= 0.75 * n and decontaminate.common(own, part) >= 0.75 * n:
                    want.add((d.doc_id, i))
    assert want and want <= got


def test_latent_space_of_all_passages(spark):
    """The space is that of a dense decomposition over the passages of every document."""
    r = random.Random(12)
    vocab = [f"w{k}" for k in range(20)]
    texts = [" ".join(r.choices(vocab, [1 + (k + i) % 7 for k in range(20)], k=r.randint(3, 90))) for i in range(2_600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    index = decontaminate.fit(docs, [(1, " ".join(vocab[:12])), (2, " ".join(vocab[8:]))], rank=5)
    rows = [index.place(w) for _, w in index.parts]
    for text in texts:
        t = index.place(decontaminate.words(text))
        rows += [t[k * size // 2 : k * size // 2 + size] for size in index.scales for k in range(max(1, -(-len(t) // (size // 2)) - 1))]
    x = np.array([np.bincount(t, minlength=20) for t in rows]) * index.idf
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.linalg.eigh(x.T @ x)[1][:, -5:]
    basis = index.rows[:-1] / index.idf[:, None]
    assert np.abs(basis @ basis.T - want @ want.T).max() < 1e-3


def test_common_subsequence():
    r = random.Random(2)
    for _ in range(50):
        a, b = ([r.choice([b"x", b"y", b"z"]) for _ in range(r.randint(1, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.common(a, b) == t[-1][-1]


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        assert stage(spark, docs.limit(0), folder).count() == 0
        docs = out
    packed = corpus_pipeline.run(spark, folder)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_search_is_fast_for_pieces_over_half_a_sequence():
    """No two of them share a bin, so that nothing can move; that must be seen at once."""
    import time

    rng = np.random.default_rng(1)
    sizes = rng.integers(600, 700, 20_000)
    began = time.process_time()
    bins = packing.local_search(sizes, packing.best_fit(sizes, 1024), 1024)
    assert time.process_time() - began < 2 and len(set(bins.tolist())) == len(sizes)


@pytest.mark.parametrize(("changed", "rarest"), [(0.2, True), (0.3, True), (0.36, True), (0.25, False)])
def test_paraphrases_of_rare_words(spark, changed, rarest):
    """Words of Zipf's law; of each item the rarest words are changed, or any. Nine tenths of what the rule itself counts is found, and other texts aren't."""
    rng = np.random.default_rng(6)
    vocab = [f"w{i:05d}" for i in range(20_000)]
    p = 1 / np.arange(1, len(vocab) + 1)
    draw = lambda n: [vocab[i] for i in rng.choice(len(vocab), n, p=p / p.sum())]
    items, docs, want = {i: draw(40) for i in range(50)}, {}, set()
    raw = lambda ws: [w.encode() for w in ws]
    for i, own in items.items():
        order = sorted(range(40), key=lambda k: own[k], reverse=True) if rarest else rng.permutation(40).tolist()
        new = list(own)
        for k in order[: round(40 * changed)]:
            new[k] = draw(1)[0]
        docs[i] = draw(int(rng.integers(60, 200))) + new + draw(int(rng.integers(60, 200)))
        share, kept = decontaminate.common(raw(own), raw(docs[i])) / 40, decontaminate.common(raw(own[-10:]), raw(docs[i])) / 10
        if share >= 0.75 or (share >= 0.6 and kept >= 0.6):
            want.add((i, i))
        docs[1_000 + i] = draw(400)
        docs[2_000 + i] = draw(60) + [own[k] for k in rng.permutation(40)] + draw(60)
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(table, bench).collect()}
    assert len(want) >= 30 and len(got & want) >= 0.9 * len(want) and not [d for d, _ in got if d >= 1_000]


def test_a_line_of_every_document(spark):
    """One line in all documents: rows of its slices are merged in the tasks that read them, and the result is right."""
    r = random.Random(8)
    line = "the same boilerplate line stands in every one of these documents, whatever else they say."
    texts = {i: "".join(r.choice("abcdefghij ") for _ in range(r.randint(60, 200))) + line + "".join(r.choice("klmnop ") for _ in range(80)) for i in range(400)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    got = {x.doc_id: x for x in repeats.remove_repeats(docs).collect()}
    for i, t in texts.items():
        gone = bytearray(len(t))
        if i:
            at = t.index(line)
            gone[at : at + len(line)] = b"\1" * len(line)
        assert got[i].n_removed == sum(gone) or i and got[i].n_removed >= len(line)  # a byte beside the line may agree by chance
    parts = spark.createDataFrame([(1, b"s" * 60, i, i + 1, 5, 6) for i in range(500)] + [(2, b"t" * 60, 7, 7, 8, 9)], "h long, slice binary, doc_id long, last long, key long, more int").coalesce(2)
    assert sorted(tuple(x) for x in repeats.combined(parts).groupBy("h").agg(F.min("doc_id"), F.max("last"), F.count("*")).collect())[0][:3] == (1, 0, 500)
    assert repeats.combined(parts).count() <= 4


@pytest.mark.parametrize("fine", [1, 3, 50])
def test_ranges_of_buckets(fine):
    """Buckets cut into ranges of hashes hold the same keys in the same order, each range once."""
    rng = np.random.default_rng(4)
    k = np.unique((rng.integers(0, 9, 5_000).astype(np.uint64) << np.uint64(48)) | rng.integers(0, 1 << 48, 5_000).astype(np.uint64))
    cuts = language_model._cut(k, fine)
    assert [i for _, i, _ in cuts] == np.cumsum([0, *(n for _, _, n in cuts)])[:-1].tolist() and sum(n for _, _, n in cuts) == len(k)
    assert [b for b, _, _ in cuts] == sorted({b for b, _, _ in cuts}) and max(b for b, _, _ in cuts) < 9 * fine
    assert all(set((k[i : i + n] >> np.uint64(48)).tolist()) == {b // fine} for b, i, n in cuts)


def test_texts_are_split_once_for_a_benchmark(spark):
    """What is compared with the items are stored terms, so that no text is read and split again; empty and null texts stay rows."""
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30))), (2, ""), (3, None), (4, "x " * 50 + " ".join(f"w{i}" for i in range(3, 30)))], "doc_id long, text string")
    found = decontaminate.contaminated(docs, bench)
    assert sorted(r.doc_id for r in found.collect()) == [1, 4]
    assert "text" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("block", [2, 64])
def test_products_of_texts_in_a_row(block):
    """Windows, runs and cells of many texts together are those of each text: no window crosses from one into the next."""
    rng = np.random.default_rng(3)
    terms = {f"w{i}".encode(): i for i in range(40)}
    items = [(i, [f"w{k}".encode() for k in rng.integers(0, 40, 30)]) for i in range(3)]
    index = decontaminate.Index(terms, rng.random(40) + 0.5, items, (24, 64), 24)
    texts = [np.where(rng.random(n) < 0.6, rng.integers(0, 40, n), -1).astype("<i2") for n in (0, 1, 11, 12, 13, 25, 31, 32, 33, 64, 65, 97, 400, 0)]
    texts += [np.full(50, -1, "<i2"), np.concatenate([texts[9][:5], index.tokens[1][3:20], [-1]]).astype("<i2")]
    g = rng.standard_normal((40, 6)).astype(np.float32)
    got, want = np.zeros((40, 6)), np.zeros((40, 6))
    for known, rows in decontaminate._window_products(index, texts, g, block):
        got[known] += rows
    for t in texts:
        for half in (12, 32):
            for k in range(max(1, -(-len(t) // half) - 1)):
                own = t[k * half : (k + 2) * half]
                x = np.bincount(own[own >= 0], minlength=40)
                if x.any():
                    want += np.outer(x, x @ g) / np.sum((x * index.idf) ** 2)
    assert np.allclose(got, want, rtol=1e-4, atol=1e-5)
    alone = [(k, c, p.tolist()) for k, t in enumerate(texts) for _, c, p in index.open_cells([t])]
    assert [(k, c, p.tolist()) for k, c, p in index.open_cells(texts, 4)] == alone and alone
    heads = [k for k, t in enumerate(texts) if len(t) and np.isin(index.head_hashes(t.astype(np.int64)), index.heads).any()]
    assert index.with_runs(texts) == heads and len(texts) - 1 in heads
