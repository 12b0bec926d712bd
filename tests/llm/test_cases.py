"""Odd rows for every operator, SQL of the queries that have it, recall of benchmark passages, and each stage of the pipeline against brute force."""

import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_model, licenses, neardup, packing, quality, queries, repeats, sketch, tokenfile, toxicity
from tidemark.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, _t string, _m string, chunk string, h int, _score double, digest string, node string, band long, key string, label string, part int, score double, start long, toxic_score string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, rows and ids that repeat, ties, and columns named as those that operators use."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    vocab = [word() for _ in range(400)]
    long = " ".join(r.choice(vocab) for _ in range(60_000))
    same = " ".join(r.choice(vocab) for _ in range(40))
    texts = [None, "", " \n\t ", "x", same, same, same + " more", long, long[: len(long) // 2] + " tail", "you idiot " * 30, "é\u0301\U0001f600 ß" * 40, "cc by nc " * 5_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, same), (4, "another text of this id"), (None, same), (None, None), (2**62, same)]
    fill = (None, None, None, "c", "c", "c", 1, 0.5, "c", "c", 1, "c", "c", 1, 0.5, 2, "c")
    return spark.createDataFrame([(*x, *fill) for x in rows], CLASHING).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i % 12, i % 2, i % 3 == 0 and 1 or 0) for i in range(40)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "quality": lambda d, y: quality.score(d, quality.fit(d, y)),
    "sketch": lambda d, y: sketch.fingerprints(d),
    "licenses": lambda d, y: licenses.scan(d),
    "neardup": lambda d, y: neardup.groups(d, k=2),
    "toxicity": lambda d, y: toxicity.score(d, toxicity.fit(d, y)),
    "tokenfile": lambda d, y: tokenfile.round_trip(d, tokenizer_path()),
    "repeats": lambda d, y: repeats.remove_repeats(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_come_out_once_each(odd, labels, name):
    out = OPERATORS[name](odd, labels)
    want = sorted(str(r.doc_id) for r in odd.select("doc_id").collect())
    assert sorted(str(r.doc_id) for r in out.select("doc_id").collect()) == want
    assert OPERATORS[name](odd.limit(0), labels).count() == 0


def test_odd_rows_of_other_operators(odd, spark):
    ids = {r.doc_id for r in odd.select("doc_id").collect()}
    pieces = packing.pack_documents(odd, tokenizer_path()).collect()
    assert {p.doc_id for p in pieces} == ids and all(0 < p.length <= 1024 for p in pieces)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in by.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 1024
    scores = language_model.score(odd, order=3).collect()
    assert sorted(r.doc_id for r in scores) == sorted(ids - {None})
    bench = spark.createDataFrame([(1, "x"), (2, None), (3, "")], "item_id long, text string")
    assert {r.item_id for r in decontaminate.contaminated(odd, bench).collect()} <= {1}


def test_equal_texts_fare_alike(odd, labels):
    """Ties: rows of one text get one score and one fingerprint, whatever their ids."""
    texts = {(r.doc_id, i): r.text for i, r in enumerate(odd.select("doc_id", "text").collect())}
    same = [k[0] for k, t in texts.items() if t and list(texts.values()).count(t) > 2]
    for name, column in (("quality", "score"), ("toxicity", "score"), ("licenses", "n_words")):
        got = {r.doc_id: r[column] for r in OPERATORS[name](odd, labels).collect() if r.doc_id in (5, 2**62)}
        assert len(same) > 2 and got[5] == got[2**62]


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_sql(spark, name, scale):
    folder = f"/root/testdata/{scale}"
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    want = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(names).collect()))) == sorted(map(str, want.fetchall()))


def test_paraphrases_and_negatives(spark):
    """Paraphrases that change every fifth word, rare ones too, are found; texts of the same vocabulary in another order aren't."""
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdefghijklm") for _ in range(6)) for _ in range(900)]
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    items = {i: text(r.randint(20, 60)) for i in range(25)}
    docs, want = {}, set()
    for i, own in items.items():
        changed = [r.choice(vocab) if k % 5 == i % 5 else w for k, w in enumerate(own)]
        docs[i] = text(r.randint(40, 150)) + changed + text(r.randint(40, 150))
        want.add((i, i))
        mixed = list(own)
        r.shuffle(mixed)
        docs[100 + i] = text(60) + mixed + text(60)
        docs[200 + i] = text(200)
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(table, bench).collect()}
    assert len(got & want) >= 0.9 * len(want) and not {d for d, _ in got} & set(range(100, 300))


def near(texts, k):
    """Brute force: the smallest id of each row's component."""
    sets = {i: neardup.shingles(neardup.words(t), k) for i, t in texts.items()}
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 80 * len(sets[a] | sets[b]):
                part[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in sets}


def test_stages_against_brute_force(spark):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    of = lambda df: {r.doc_id: r.text for r in df.collect()}
    # Documents scored 0.5 or more go: nearly all labelled toxic ones, and nearly no others. It takes labels to learn from.
    large = "/root/testdata/sf0.01"
    left = of(stages["toxicity"](spark, spark.read.parquet(f"{large}/documents.parquet"), large))
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{large}/labels.parquet").collect() if r.toxic is not None}
    assert sum((i in left) == (not y) for i, y in toxic.items()) >= 0.95 * len(toxic)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")
    kept = of(docs)
    # One of each group stays.
    first = near(kept, 5)
    alone = of(stages["near duplicates"](spark, docs, SF))
    assert alone == {i: t for i, t in kept.items() if first[i] == i}
    # Repeated strings of 50 bytes go.
    seen, want = {}, {}
    for i in sorted(alone):
        raw = (alone[i] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if seen.setdefault(raw[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        left = bytes(x for x, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        if left or not any(gone):
            want[i] = left if any(gone) else alone[i]
    cut = stages["repeated passages"](spark, docs.where(F.col("doc_id").isin(list(alone))), SF)
    assert of(cut) == want
    # Documents with a benchmark passage go, no others.
    items = [decontaminate.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = lambda ws, own: any(decontaminate.common(own, ws[k : k + 2 * len(own)]) >= 0.75 * len(own) for k in range(0, max(1, len(ws) - len(own)), len(own)))
    leaks = {i for i, t in want.items() if any(own and holds(decontaminate.words(t), own) for own in items)}
    clean = of(stages["benchmark"](spark, cut, SF))
    assert leaks <= set(want) - set(clean) and len(set(want) - set(clean) - leaks) <= 2
    # All that is left is packed.
    packed = stages["packing"](spark, docs.where(F.col("doc_id").isin(list(clean))), SF)
    assert {r.doc_id for r in packed.collect()} == set(clean)


@pytest.mark.parametrize("name", ["toxicity", "near duplicates", "repeated passages", "benchmark", "packing"])
def test_stages_of_odd_rows(spark, odd, name):
    """Columns that clash with those of a stage change nothing; null ids and texts stay, and an empty table gives no rows."""
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)[name]
    plain = odd.select(corpus_pipeline.COLUMNS)
    rows = lambda d: sorted(str(tuple(r)) for r in d.select(sorted(d.columns)).collect())
    got = stage(spark, odd, SF)
    if name != "packing":
        assert got.columns == corpus_pipeline.COLUMNS and rows(got) == rows(stage(spark, plain, SF))
        assert None in {r.doc_id for r in got.collect()} and None in {r.text for r in got.collect()}
    else:
        assert {r.doc_id for r in got.collect()} == {r.doc_id for r in odd.select("doc_id").collect()}
    assert stage(spark, odd.limit(0), SF).count() == 0
