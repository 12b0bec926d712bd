"""Sketches merged from months against exact quantiles of all rows; links, changes and runs on rows with nulls and ties."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import changes, offers, supply
from tidemark.plans import serving
from tidemark.sources import envelopes

SF = "/root/testdata/sf0.001"


def test_merged_sketches(spark):
    got = {r.pipeline: r for r in serving.a15_gpu_metrics_reaggregate(spark, SF).collect()}
    rows = {}
    for r in serving.offers(spark, SF).select("pipeline", "price", "capacity").collect():
        rows.setdefault(r.pipeline, []).append((r.price, r.capacity))
    assert got.keys() == rows.keys()
    for k, own in rows.items():
        prices = sorted(p for p, _ in own)
        assert got[k].n == len(own)
        assert abs(got[k].average - sum(p * c for p, c in own) / sum(c for _, c in own)) < 1e-6 * got[k].average
        for q, value in ((0.5, got[k].p50), (0.95, got[k].p95)):
            assert abs(sum(p <= value for p in prices) / len(prices) - q) < 0.03


def test_payment_links(spark):
    paid = spark.createDataFrame([(1, "a"), (2, ""), (3, "b"), (4, "a"), (5, None)], "event_id int, request string")
    s = spark.createDataFrame([("a", 7), ("", 8)], "request string, session_id int")
    got = {r.event_id: (r.session_id, r.link_status) for r in supply.payment_links(paid, s, "request").collect()}
    assert got == {1: (7, "linked"), 2: (None, "no_request"), 3: (None, "unlinked"), 4: (7, "linked"), 5: (None, "unlinked")}


def test_changed_rows(spark):
    kind = "k int, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "", 3)], kind)
    new = spark.createDataFrame([(1, "x", 1), (2, "", 2), (3, "", 4), (4, "x", 1)], kind)
    assert sorted(r.k for r in supply.changed_rows(new, old, ["k"], ["a", "b"]).collect()) == [2, 3, 4]
    assert supply.changed_rows(new.limit(0), old, ["k"], ["a"]).count() == 0


def test_runs_in_order(spark):
    """Runs go on from one stretch of time to the next; blanks are passed over, ties are ordered by id."""
    r = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = [(r.choice(["a", "b", None]), start + timedelta(minutes=r.randint(0, 900)), i, r.choice(["x", "x", "y", "", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int, v string")
    want, last = [], {}
    for k, t, i, v in sorted(rows, key=lambda x: (x[1], x[2])):
        if v and last.get(k) != v:
            last[k] = v
            want.append(i)
    for stretch in (60, 3_600, 10**6):
        assert sorted(x.i for x in changes.runs_in_order(df, ["k"], "t", "i", "v", stretch_s=stretch).collect()) == sorted(want)
    assert changes.runs_in_order(df.limit(0), ["k"], "t", "i", "v").count() == 0


def test_a_payment_of_two_sessions_stays_one_row(spark):
    paid = spark.createDataFrame([(1, "a")], "event_id int, request string")
    s = spark.createDataFrame([("a", 7), ("a", 6)], "request string, session_id int")
    assert [(r.event_id, r.session_id) for r in supply.payment_links(paid, s, "request").collect()] == [(1, 6)]


CAPABILITY = "{{\"address\":\"0xA\",\"orch_uri\":\"https://A\",\"hardware\":{hw},\"capabilities\":{caps}}}"


@pytest.mark.parametrize(
    ("hw", "caps", "want"),
    [
        ('[{"pipeline":" p ","model_id":"m","gpu_info":[{"id":"g1","name":"n","memory_total":5},{"id":"","name":"x"}]},{"pipeline":"q","model_id":"k","gpu_info":{"0":{"id":"g2"}}},{"pipeline":"r","model_id":"l"}]', "null", [("p", "m", "g1", 1), ("q", "k", "g2", 1), ("r", "l", None, 0)]),
        ("[]", '{"constraints":{"PerCapability":{"36":{"models":{"b":{"capacity":1},"a":{"warm":true}}},"35":{"models":{"z":{"capacity":1},"y":{"capacity":9},"w":{"warm":true,"capacity":0},"x":{"capacity":9}," ":{}}},"37":{"models":{"no":{}}},"41":{"models":{"no":{}}}}}}', [("live", "w", None, 0), ("live", "x", None, 0), ("live", "y", None, 0), ("live", "z", None, 0), ("live", "a", None, 0), ("live", "b", None, 0)]),
        ("[]", '{"constraints":{"PerCapability":{"36":{"models":{"b":{}}},"35":{"models":{"b":{}}}}}}', [("live", "b", None, 0)]),
        ("null", "null", [("", "", None, 0)]), ("[]", '{"constraints":{"PerCapability":{"37":{"models":{"no":{}}}}}}', [("", "", None, 0)]),
        ('"broken"', '{"constraints":{"PerCapability":{"35":{"models":{"z":{}}}}}}', [("", "", None, 0)]),
    ],
)
def test_templates(spark, hw, caps, want):
    """GPUs in arrays and keyed objects, order by warmth, capacity and name, pairs once, and placeholders."""
    seed = spark.createDataFrame([(35, "v", "builtin", "live", "model", True, False), (36, "w", "builtin", "live", "model", True, False), (37, "o", "byoc", None, None, False, True)], offers.CATALOG)
    payload = "[" + CAPABILITY.format(hw=hw, caps=caps) + "]"
    rows = spark.createDataFrame([("e", "network_capabilities", datetime(2024, 1, 1), "north", payload, "h")], "event_id string, event_type string, event_ts timestamp, org string, data string, payload_hash string")
    got = offers.templates(envelopes.capabilities(rows), seed).orderBy("seq").collect()
    assert [(r.pipeline, r.model, r.gpu_id, r.hardware_present) for r in got] == want and [r.seq for r in got] == list(range(1, len(want) + 1))


def test_payloads_sent_twice_are_parsed_once(spark):
    payload = "[" + CAPABILITY.format(hw="[]", caps="null") + "]"
    rows = spark.createDataFrame([(f"e{i}", "network_capabilities", datetime(2024, 1, 1), "north", p, h) for i, (p, h) in enumerate([(payload, "h1"), (payload, "h1"), ("{broken", "h2"), ("[]", "h3")])], "event_id string, event_type string, event_ts timestamp, org string, data string, payload_hash string")
    assert envelopes.provider_payloads(rows).count() == 1
    assert sorted(r.row_id for r in envelopes.capabilities(rows).collect()) == ["e0#0xa", "e1#0xa"]
