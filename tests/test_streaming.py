"""Streaming forms over files with availableNow: routing, deduplication, hours, state, late rows and late snapshots."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import latest
from tidemark.sources import envelopes
from tidemark.streaming import flows

T0 = datetime(2024, 1, 1, 10)
ORGS = {"network_events": "north"}


def envelope(i, kind, minutes, stream="s1", **data):
    at = (T0 + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return {"id": i, "type": kind, "timestamp": at, "gateway": "gw", "data": json.dumps({"stream_id": stream, "request_id": "r", **data}), "source_topic": "network_events", "source_partition": 0, "source_offset": 1}


FIRST = [
    envelope("a", "stream_trace", 0, type="gateway_receive_stream_request"), envelope("b", "ai_stream_status", 1, inference_status={"fps": 20.0}, state="ONLINE"), envelope("b", "ai_stream_status", 1, inference_status={"fps": 20.0}, state="ONLINE"),
    envelope("c", "stream_trace", 2, type="app_open"), envelope("", "stream_trace", 2, type="orchestrator_swap"), envelope("d", "ai_stream_status", 70, stream="s2", inference_status={"fps": 5.5}, state="OFFLINE"),
]
SECOND = [envelope("e", "ai_stream_status", 2, inference_status={"fps": 30.0}, state="ONLINE"), envelope("f", "stream_trace", 90, type="orchestrator_swap")]


@pytest.fixture
def put(tmp_path):
    (tmp_path / "in").mkdir()

    def write(name, rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n{broken\n")

    write("1.json", FIRST)
    return write


@pytest.fixture
def at(put, tmp_path):
    return lambda name: str(tmp_path / name)


def raw(spark, path, stream=True):
    return envelopes.with_raw_columns(envelopes.read_envelopes(spark, path, stream=stream), ORGS)


def done(query):
    query.awaitTermination(120)
    assert query.exception() is None


def collected(spark, df, at, name, mode="append"):
    done(df.writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{at(name)}/batch={n}")).outputMode(mode).option("checkpointLocation", at(name + "-c")).trigger(availableNow=True).start())
    return spark.read.parquet(at(name))


def test_route(spark, put, at):
    for name, rows in (("1.json", FIRST), ("2.json", SECOND)):
        put(name, rows)
        done(flows.route_to(raw(spark, at("in")), at("good"), at("bad"), at("route-c")))
    assert sorted(r.event_id for r in spark.read.parquet(at("good")).collect()) == ["a", "b", "b", "d", "e", "f"]
    assert sorted((r.event_id, r.ignore_reason) for r in spark.read.parquet(at("bad")).collect()) == [("", "blank_event_id"), ("c", "ignored_stream_trace_non_core_app")]


def test_dedup_and_hours(spark, at):
    once = flows.dedup(envelopes.route(raw(spark, at("in")))[0])
    assert sorted(r.event_id for r in collected(spark, once, at, "once").collect()) == ["a", "b", "d"]
    hours = flows.session_hours(envelopes.stream_status(raw(spark, at("in"))))
    got = collected(spark, hours, at, "hours", "update").collect()
    assert sorted((r.session_key, r.window.start, r.status_samples, r.output_fps_sum) for r in got) == [("north|s1|r", T0, 2, 40.0), ("north|s2|r", T0 + timedelta(hours=1), 1, 5.5)]
    minutes = collected(spark, flows.minute_throughput(raw(spark, at("in"))), at, "minutes", "update").collect()
    assert sum(r.n_events for r in minutes) == 6


def test_session_state(spark, put, at):
    """A second run goes on from the state of the first."""
    for name, rows in (("1.json", FIRST), ("2.json", SECOND)):
        put(name, rows)
        got = collected(spark, flows.session_state(envelopes.session_rows(envelopes.route(raw(spark, at("in")))[0]), lateness="2 hours"), at, "state", "update")
    newest = latest.latest_rows(got, ["session_key"], [F.desc("batch")]).collect()
    ms = lambda m: int((T0 + timedelta(minutes=m) - datetime(1970, 1, 1)).total_seconds() * 1000)
    assert sorted((r.session_key, r.started_ms, r.last_ms, r.samples, r.fps_sum, r.swaps) for r in newest) == [("north|s1|r", ms(0), ms(90), 3, 70.0, 1), ("north|s2|r", None, ms(70), 1, 5.5, 0)]


def test_late_rows_repair_their_slices(spark, put, at):
    """A late row changes its hour alone, and an hour of which nothing is left goes."""
    asked = []
    keep = {"ids": ["a", "b", "d", "e", "f"]}

    def base(days):
        asked.append(sorted(map(str, days)))
        return envelopes.route(raw(spark, at("in"), stream=False))[0].where(F.col("event_id").isin(keep["ids"]))

    build = lambda rows: rows.groupBy("org", "hour").agg(F.count("*").alias("n"))
    run = lambda: done(flows.repair_slices(raw(spark, at("in")).where("event_ts is not null"), base, build, at("slices"), at("repair-c")))
    read = lambda: {r.hour: r.n for r in flows.read_slices(spark, at("slices")).collect()}
    run()
    assert read() == {T0: 3, T0 + timedelta(hours=1): 1} and asked == [["2024-01-01"]]
    put("2.json", SECOND[:1])
    run()
    assert read() == {T0: 4, T0 + timedelta(hours=1): 1}
    keep["ids"] = ["a"]
    put("3.json", SECOND[1:])
    run()
    assert read() == {T0: 4}


def test_late_snapshots_repair_decisions(spark, at, tmp_path):
    kind = "org string, ident string, event_ts timestamp"
    sel = spark.createDataFrame([("x", "north", "https://u1", T0, "", ""), ("y", "north", "https://u2", T0, "", ""), ("z", "north", "https://u1", T0 - timedelta(hours=1), "", "")], "selection_id string, org string, ident string, ts timestamp, pipeline string, model string")
    hist = lambda: spark.createDataFrame([("north", "https://u1", "uri", T0 - timedelta(minutes=5), None, "0xa", "https://u1", "live", "m", "g1", "h")], "org string, ident string, ident_type string, valid_from timestamp, valid_to timestamp, address string, uri string, pipeline string, model string, gpu_id string, interval_hash string")
    spark.createDataFrame([("north", "https://u1", T0 - timedelta(minutes=5))], kind).write.parquet(at("snaps"))
    stream = spark.readStream.schema(kind).parquet(at("snaps"))
    asked = []
    chosen = lambda day: asked.append(day) or sel
    of = lambda idents: asked.append([tuple(r) for r in idents.collect()]) or hist().join(idents, ["org", "ident"], "left_semi")
    done(flows.repair_dimensions(stream, chosen, of, at("decisions"), at("dim-c")))
    assert asked == [T0.date(), [("north", "https://u1")]]
    got = flows.read_decisions(spark, at("decisions")).collect()
    assert [(r.selection_id, r.status, r.reason, r.address) for r in got] == [("x", "resolved", "matched", "0xa")]


def test_archive_check(spark, put, at):
    assert envelopes.check_archive(spark, at("in"), rows=7) == 1 == envelopes.check_archive(spark, at("in"), rows=8, off=0.2)
    with pytest.raises(ValueError):
        envelopes.check_archive(spark, at("in"), rows=6)
    with pytest.raises(ValueError):
        envelopes.check_archive(spark, at("in"), broken=0)


def test_ledger_rebuilds_a_slice_once_a_burst(spark, at, tmp_path):
    """Late rows in several batches make one rebuild, two quiet minutes after the last of them; after a restart another burst makes another one."""
    kind = "org string, event_id string, event_ts timestamp, ingested_at timestamp"
    built = []

    def base(days):
        return spark.read.schema(kind).parquet(at("rows"))

    def build(rows):
        built.append(sorted((r.org, r.hour.isoformat()) for r in rows.select("org", "hour").distinct().collect()))
        return rows.groupBy("org", "hour").agg(F.count("*").alias("n"))

    def feed(*rows):
        """(minutes of the event, minutes of its arrival), a batch."""
        stamp = lambda m: T0 + timedelta(minutes=m)
        spark.createDataFrame([("north", f"e{a}-{b}", stamp(a), stamp(b)) for a, b in rows], kind).coalesce(1).write.mode("append").parquet(at("rows"))
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(at("rows"))
        done(flows.repair_ledger(stream, base, build, at("slices"), at("ledger-c")))

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    flows.with_ledger_store(spark)
    try:
        feed((0, 1), (2, 3), (5, 100))  # one late row of the hour of T0, just now
        assert built == []
        feed((6, 101))  # the burst goes on, a minute later
        feed((7, 101.5))
        assert built == []
        feed((200, 201))  # a row that isn't late, when all has been quiet
        assert built == [[("north", T0.isoformat())]]
        assert {r.hour: r.n for r in flows.read_slices(spark, at("slices")).collect()} == {T0: 5}
        feed((8, 300))
        feed((301, 302), (303, 304))
        assert built[1:] == [[("north", T0.isoformat())]]
        assert {r.hour: r.n for r in flows.read_slices(spark, at("slices")).collect()} == {T0: 6}
        feed((0, 2 * 1440), (-30, 2 * 1440))  # two days late: whole days, in one rebuild
        feed((2 * 1440 + 60, 2 * 1440 + 61))
        assert len(built) == 3 and {h for _, h in built[2]} >= {T0.isoformat(), (T0 - timedelta(hours=1)).isoformat()}
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_duplicates_a_week_late_are_dropped(spark, at):
    """The table itself is asked, for the days of the batch alone; a batch that is run again keeps its rows."""
    kind = "org string, event_id string, event_ts timestamp, n int"
    day = lambda d: T0 + timedelta(days=d)

    def feed(*rows):
        spark.createDataFrame([("north", i, day(d), n) for i, d, n in rows], kind).coalesce(1).write.mode("append").parquet(at("rows"))
        done(flows.dedup_into(spark.readStream.schema(kind).parquet(at("rows")), at("once"), at("once-c")))
        return sorted((r.event_id, r.n) for r in spark.read.parquet(at("once")).collect())

    assert feed(("a", 0, 1), ("b", 1, 1), ("b", 1, 1), (" ", 1, 1)) == [("a", 1), ("b", 1)]
    assert feed(("c", 7, 2), ("a", 0, 2), ("d", 0, 2)) == [("a", 1), ("b", 1), ("c", 2), ("d", 2)]
    plan = flows.stored_days(spark, at("once"), [day(0).date()], 9)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert flows.stored_days(spark, at("once"), [day(0).date()], 9).inputFiles()
    assert {r.event_id for r in flows.stored_days(spark, at("once"), [day(0).date()], 1).collect()} == {"a"}


def test_broken_records_are_bounded(spark, at):
    """A hundred broken records of a topic pass and are kept; with one more the batch fails before it writes anything."""
    kind = "key binary, value binary, topic string, partition int, offset long"
    good = json.dumps(envelope("a", "stream_trace", 0)).encode()
    bad = [b"{broken", b"[]", b'{"id": "x"}', b"", None]

    def feed(n, name):
        rows = [(None, bad[i % 5], "t1", 0, i) for i in range(n)] + [(None, good, "t1", 0, 1000), (None, good, "t2", 0, 1), (None, b"{", "t2", 1, 2)]
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(at(f"rec-{name}"))
        q = flows.read_bounded(spark.readStream.schema(kind).parquet(at(f"rec-{name}")), at(f"dead-{name}"), at(f"c-{name}"), at(f"good-{name}"))
        q.awaitTermination(120)

    feed(100, "pass")
    assert spark.read.parquet(at("good-pass")).count() == 2
    dead = spark.read.parquet(at("dead-pass")).collect()
    assert len(dead) == 101 and {r.value for r in dead if r.source_topic == "t2"} == {"{"}
    with pytest.raises(Exception, match="101 broken records of t1"):
        feed(101, "fail")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(at("good-fail")).count()


def test_families_normalize_as_streams(spark, put, at):
    """Every typed family of a stream gives the rows that it gives of the same files at rest."""
    many = [envelope(f"x{i}", kind, i, type=sub, pipeline="p", model_id="m", capability="c", success=True, manifestID="35_m", faceValue="7 WEI") for i, (kind, sub) in enumerate([("stream_trace", "orchestrator_swap"), ("ai_stream_status", ""), ("ai_stream_events", "error"), ("create_new_payment", ""), ("ai_batch_request", "ai_batch_request_completed"), ("ai_llm_request", "llm_request_completed"), ("job_gateway", "job_gateway_completed"), ("job_auth", "job_auth"), ("worker_lifecycle", "worker_registered"), ("job_payment", "payment_created"), ("stream_ingest_metrics", "")])]
    snapshot = envelope("cap", "network_capabilities", 1) | {"data": '[{"address":"0xA","orch_uri":"https://a","hardware":[{"pipeline":"p","model_id":"m","gpu_info":[{"id":"g"}]}]}]'}
    found = envelope("dis", "discovery_results", 1) | {"data": '[{"address":"0xA","url":"https://a","latency_ms":3}]'}
    put("2.json", [*many, snapshot, found])
    families = [envelopes.stream_trace, envelopes.stream_status, envelopes.stream_events, envelopes.payments, envelopes.ai_batch, envelopes.llm_requests, envelopes.byoc_jobs, envelopes.byoc_auth, envelopes.workers, envelopes.byoc_payments, envelopes.ingest_metrics, envelopes.capabilities, envelopes.discovery, lambda r: envelopes.gpus(envelopes.capabilities(r))]
    for k, family in enumerate(families):
        rest = family(envelopes.route(raw(spark, at("in"), stream=False))[0])
        want = sorted(str(r) for r in rest.select(sorted(rest.columns)).collect())
        moved = collected(spark, family(envelopes.route(raw(spark, at("in")))[0]), at, f"family{k}").drop("batch")
        assert want and sorted(str(r) for r in moved.select(sorted(rest.columns)).collect()) == want
