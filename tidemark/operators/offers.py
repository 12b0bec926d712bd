"""Providers' capabilities: the catalog, identities, inventories, offers and templates of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import latest
from tidemark.sources import envelopes

CATALOG = "capability_id int, capability_name string, capability_family string, canonical_pipeline string, constraint_kind string, supports_stream boolean, supports_request boolean"
#: Capability of hardware whose pipeline the catalog doesn't know.
OTHER_ID, OTHER_FAMILY = 37, "byoc"


def capability_catalog(spark: SparkSession, rows: list[tuple] | str) -> DataFrame:
    """The seed catalog, from rows or a CSV path: texts trimmed, blank ones null, ids of 0 or less left out."""
    raw = spark.read.csv(rows, header=True, schema=CATALOG) if isinstance(rows, str) else spark.createDataFrame(rows, CATALOG)
    texts = {c: expr.none_if_blank(F.col(c)) for c, t in raw.dtypes if t == "string"}
    return raw.withColumns(texts).where("capability_id > 0")


def latest_metadata(snapshots: DataFrame, key: str, values: list[str], stamp: str) -> DataFrame:
    """The newest values of each key out of appended snapshots."""
    return latest.latest_values(snapshots, [key], values, [stamp])


def snapshot_latest(snapshots: DataFrame) -> DataFrame:
    """Latest non-blank attributes of each provider endpoint."""
    last = lambda c: F.max(F.when(F.col(c) != "", F.struct("event_ts", "row_id", c)))[c].alias(c)
    return snapshots.where("orch_uri <> ''").groupBy("org", "orch_uri").agg(last("orch_address"), last("alias"), last("version"), F.max("event_ts").alias("last_seen"))


def identity_candidates(snapshots: DataFrame) -> DataFrame:
    """Up to three identities of each snapshot: its address, its endpoint, and its alias where that is another address."""
    own, alias = F.col("orch_address"), F.col("alias")
    kind = lambda name, value, ok: F.when(ok, F.struct(F.lit(name).alias("ident_type"), value.alias("ident")))
    every = F.array(kind("address", own, own != ""), kind("uri", expr.identity(F.col("orch_uri")), F.col("orch_uri") != ""), kind("alias", alias, expr.is_address(alias) & (alias != own)))
    return snapshots.withColumn("c", F.explode(F.array_compact(every))).select("row_id", "event_ts", "org", "c.ident_type", "c.ident")


def hardware_inventory(snapshots: DataFrame, catalog: DataFrame) -> DataFrame:
    """The newest row of each provider's GPU with the provider's newest endpoint and the capability of the GPU's pipeline.

    One pass over the snapshots: GPUs and endpoints are aggregated by provider and GPU, and a window over a provider's
    GPUs, a row each, finds its endpoint.
    """
    flat = envelopes.gpu_list()
    # A GPU that one snapshot names more than once counts with its first pipeline and model.
    by_id = F.array_sort(F.transform(flat, lambda g: F.struct(g.gpu_id.alias("gpu_id"), g.pipeline.alias("pipeline"), g.model_id.alias("model_id"), g.gpu_name.alias("gpu_name"), g.gpu_memory.alias("gpu_memory"))))
    rows = snapshots.select("org", "orch_address", "event_ts", "row_id", "orch_uri", by_id.alias("_g"))
    first = F.filter("_g", lambda g, i: (i == 0) | (F.get("_g", i - 1)["gpu_id"] != g.gpu_id))
    rows = rows.select("org", "orch_address", "event_ts", "row_id", "orch_uri", F.explode_outer(first).alias("g"))
    uri = F.max(F.when(F.col("orch_uri") != "", F.struct("event_ts", "row_id", "orch_uri")))
    each = rows.groupBy("org", "orch_address", F.col("g.gpu_id").alias("gpu_id")).agg(F.max(F.struct("event_ts", "row_id", "g")).alias("_n"), uri.alias("_u"))
    own = Window.partitionBy("org", "orch_address")
    now = each.withColumn("orch_uri", F.max("_u").over(own)["orch_uri"]).where("gpu_id is not null")
    now = now.select("org", "orch_address", "gpu_id", "_n.event_ts", "_n.row_id", "_n.g.pipeline", "_n.g.model_id", "_n.g.gpu_name", "_n.g.gpu_memory", "orch_uri")
    known = catalog.select(F.lower("canonical_pipeline").alias("_p"), "capability_id", "capability_family").where("_p is not null")
    out = now.join(F.broadcast(known), F.lower("pipeline") == F.col("_p"), "left").drop("_p")  # a seed of a few rows
    return out.withColumns({"capability_id": F.coalesce("capability_id", F.lit(OTHER_ID)), "capability_family": F.coalesce("capability_family", F.lit(OTHER_FAMILY))})


def classified(offers: DataFrame, catalog: DataFrame) -> DataFrame:
    """Offers with capability name, family, pipeline and what it supports: by id, or for hardware by its pipeline."""
    named = ["capability_name", "capability_family", "canonical_pipeline", "supports_stream", "supports_request"]
    by_id = catalog.select("capability_id", *(F.col(c).alias(f"i_{c}") for c in named))
    by_name = catalog.where("canonical_pipeline is not null").select(F.lower("canonical_pipeline").alias("_p"), F.col("capability_id").alias("n_id"), *(F.col(c).alias(f"n_{c}") for c in named))
    out = offers.join(by_id, "capability_id", "left").join(by_name, (F.lower("pipeline") == F.col("_p")) & (F.col("hardware_present") == 1), "left").drop("_p")
    of = lambda c: F.coalesce(f"i_{c}", f"n_{c}")
    return out.select(
        "row_id", "org", "orch_address", "model", "hardware_present", F.coalesce("capability_id", "n_id", F.lit(OTHER_ID)).alias("capability_id"), F.coalesce(of("capability_name"), expr.none_if_blank(F.col("pipeline")), F.lit("unknown")).alias("capability_name"), F.coalesce(of("capability_family"), F.lit(OTHER_FAMILY)).alias("capability_family"),
        F.coalesce(of("canonical_pipeline"), "pipeline").alias("pipeline_id"), F.coalesce(of("supports_stream"), F.lit(False)).alias("supports_stream"), F.coalesce(of("supports_request"), F.lit(True)).alias("supports_request"),
    )


_TEMPLATE = "struct<pipeline:string,model:string,gpu_id:string,gpu_name:string,gpu_memory:bigint,hardware_present:int>"


def templates(snapshots: DataFrame, catalog: DataFrame) -> DataFrame:
    """Interval templates of each snapshot, numbered by ``seq``: (row_id, seq, pipeline, model, gpu_id, gpu_name, gpu_memory, hardware_present).

    Hardware entries give one for each GPU, or one without a GPU; without hardware, the capabilities that the catalog has
    as built in give one for each pipeline and model, in the order of capability ids, then warm models, large
    capacities and names first, each pair once. A snapshot of neither, or one that is broken, gives one placeholder.
    """
    none = F.lit(None)
    template = lambda p, m, g, name, mem, hw: F.struct(p.alias("pipeline"), m.alias("model"), g.cast("string").alias("gpu_id"), name.cast("string").alias("gpu_name"), mem.cast("bigint").alias("gpu_memory"), hw.alias("hardware_present"))
    bare = lambda p, m: template(p, m, none, none, none, F.lit(0))
    entry = lambda h: F.when(F.size(h.gpus) > 0, F.transform(h.gpus, lambda g: template(F.trim(h.pipeline), F.trim(h.model_id), F.trim(g.id), F.trim(g["name"]), g.memory_total, F.lit(1)))).otherwise(F.array(bare(F.trim(h.pipeline), F.trim(h.model_id))))
    known = catalog.where("capability_family = 'builtin'").agg(F.map_from_entries(F.collect_list(F.struct(F.col("capability_id").cast("string"), F.coalesce("canonical_pipeline", "capability_name")))).alias("_known"))
    ranked = lambda models: F.array_sort(F.filter(F.transform(F.map_entries(models), lambda m: F.struct((~F.coalesce(m.value.warm, F.lit(False))).alias("cold"), (-F.coalesce(m.value.capacity, F.lit(0))).alias("less"), F.trim(m.key).alias("name"))), lambda m: m["name"] != ""))
    able = F.array_sort(F.filter(F.transform(F.map_entries("per_capability"), lambda c: F.struct(c.key.alias("id"), F.element_at("_known", c.key).alias("p"), ranked(c.value.models).alias("models"))), lambda c: c.p.isNotNull()))
    pairs = F.array_distinct(F.flatten(F.transform(able, lambda c: F.transform(c.models, lambda m: F.struct(c.p.alias("p"), m["name"].alias("m"))))))
    rows = snapshots.crossJoin(F.broadcast(known))  # one row: the seed as a map
    own = F.when(F.coalesce("is_broken", F.lit(False)), F.array().cast(f"array<{_TEMPLATE}>")).when(F.size("hardware") > 0, F.flatten(F.transform("hardware", entry))).otherwise(F.transform(pairs, lambda x: bare(x.p, x.m)))
    rows = rows.select("row_id", own.cast(f"array<{_TEMPLATE}>").alias("_own"))
    filled = F.when(F.size("_own") > 0, F.col("_own")).otherwise(F.array(bare(F.lit(""), F.lit(""))).cast(f"array<{_TEMPLATE}>"))
    return rows.select("row_id", F.posexplode(filled).alias("seq", "t")).select("row_id", (F.col("seq") + 1).alias("seq"), "t.*")


def routed_score(stream: Column, request: Column, kind: str) -> Column:
    """The score of the kind of work asked for; the better one where none is."""
    return stream if kind == "stream" else request if kind == "request" else F.greatest(stream, request)
