"""What plans must look like: payloads are parsed once, and filters don't write the parse out again."""

import pytest

from tidemark.plans import catalog, live, network, requests, serving

SF = "/root/testdata/sf0.001"
assert live and network and requests and serving


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["d3_session_facts", "a10_demand_hourly", "a8_session_evidence", "a11_sla_input_hourly", "a16_demand_reaggregate", "d5_demand_input", "q13_sla_page"])
def test_session_payloads_are_parsed_once(spark, name):
    plan = optimized(catalog.QUERIES[name](spark, SF))
    assert (plan.count("parseJson("), plan.count("json_tuple("), plan.count("StructsToJsonEvaluator(")) == (1, 1, 1)


@pytest.mark.parametrize("name", ["j5_hardware_inventory", "g10_templates", "i4_provider_profile", "g3_gpus", "g4_offers_of_capabilities", "g6_prices", "g7_global_price"])
def test_capability_payloads_are_parsed_once(spark, name):
    plan = optimized(catalog.QUERIES[name](spark, SF))
    assert plan.count("from_json(StructField(address,StringType,true), StructField(local") + plan.count("inline(from_json(") == 1


@pytest.mark.parametrize("name", ["j5_hardware_inventory", "q30_gpu_by_type", "d15_offer_classification", "g1_capabilities", "g10_templates"])
def test_snapshots_are_derived_once(spark, name):
    """Payloads are parsed where they stand: no second derivation to find equal ones, and no join back."""
    plan = optimized(catalog.QUERIES[name](spark, SF))
    assert len([x for x in plan.splitlines() if "Relation [l_orderkey" in x]) == 1


@pytest.mark.parametrize("name", ["d15_offer_classification", "g1_capabilities", "q12_streaming_orchestrators"])
def test_lines_of_snapshots_are_dealt_once(spark, name):
    """Both groupings that write a snapshot find its rows where one shuffle by supplier and month has put them."""
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(s#" in x or "Exchange hashpartitioning(l_suppkey#" in x]) == 1


def test_jobs_are_derived_once(spark):
    """Sessions and AI jobs come from one scan of ``events`` each, decisions from two; ``orders`` are scanned for each use of capability jobs and workers, but not twice for a job's first and last event."""
    plan = optimized(catalog.QUERIES["u1_union_all_jobs"](spark, SF)).splitlines()
    count = lambda key: len([x for x in plan if f"Relation [{key}" in x])
    assert (count("event_id"), count("o_orderkey")) == (4, 7)


@pytest.mark.parametrize(("name", "parts"), [("g1_capabilities", []), ("g3_gpus", ["hardware"]), ("q12_streaming_orchestrators", ["hardware"]), ("q11_streaming_models", ["hardware"]), ("q31_latest_pricing", ["capabilities_prices"]), ("q25_discover", ["price_info"]), ("g4_offers_of_capabilities", ["hardware", "capabilities"])])
def test_only_parts_read_are_parsed(spark, name, parts):
    plan = optimized(catalog.QUERIES[name](spark, SF))
    parsed = plan[plan.index("inline(from_json(") :].split("), data#")[0]
    assert [p for p in ("hardware", "capabilities", "capabilities_prices", "price_info") if f"StructField({p}," in parsed] == parts


@pytest.mark.parametrize("name", ["g1_capabilities", "g3_gpus", "q12_streaming_orchestrators", "q31_latest_pricing", "q25_discover"])
def test_snapshots_are_met_once_and_lines_have_no_names(spark, name):
    """A snapshot's lines meet in one list of one grouping; names of snapshots aren't written for each line to filter it."""
    plan = optimized(catalog.QUERIES[name](spark, SF))
    own = plan[: plan.index("RepartitionByExpression")].splitlines()
    assert len([x for x in own if "collect_list(" in x and "Aggregate" in x]) == 1 and "collect_set(_h" not in plan
    assert not [x for x in plan.splitlines() if "Filter" in x and "l_suppkey" in x and "date_format" in x]


def test_builds_are_derived_once(spark):
    """Each of the four tables of both builds comes from one scan; marking the first layer that differs derives none of them again."""
    assert len([x for x in optimized(catalog.QUERIES["c16_layer_diff"](spark, SF)).splitlines() if "Relation [event_id" in x]) == 4
