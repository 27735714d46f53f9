"""Checks of the resolved graph, the enriched graph and the index, as rows with a status; metrics, queues and verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage
from ..functions.text import percent
from .graph import peel

#: Checks that stop their stage if they fail.
BLOCKING = ["graph_loaded", "empty_chunks", "graph_integrity", "review_needed_flags", "specializes_acyclic", "index_artifacts"]
HUB, LOW = 20, 0.7


def one_row(*parts: DataFrame) -> DataFrame:
    """Tables of one row each, side by side."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)


def records(row: DataFrame, stage: str, listed: list[tuple[str, Column, Column, Column]]) -> DataFrame:
    """(stage, check, blocking, count, value, status) from one row of metrics and (check, count, value, status)."""
    made = [F.struct(F.lit(c).alias("check"), F.lit(c in BLOCKING).alias("blocking"), n.cast("long").alias("count"), v.cast("double").alias("value"), s.alias("status")) for c, n, v, s in listed]
    return row.select(F.lit(stage).alias("stage"), F.explode(F.array(*made)).alias("c")).select("stage", "c.*")


def _none(count: str, otherwise: str, then: str = "pass") -> Column:
    return F.when(F.col(count) == 0, then).otherwise(otherwise)


def extraction_checks(chunks: DataFrame, edges: DataFrame, warnings: DataFrame, valid: Column) -> DataFrame:
    """Of chunks (chunk_id, n) with their nodes, edge occurrences and typing warnings: the checks that look at occurrences."""
    row = one_row(
        chunks.agg(F.count(F.lit(1)).alias("n_chunks"), F.count_if(F.col("n") == 0).alias("n_empty")), warnings.agg(F.count(F.lit(1)).alias("n_warnings")),
        edges.agg(F.count_if(F.col("type") == "ECHOES").alias("n_echoes"), percent(F.count_if((F.col("type") == "INVOLVES") & valid), F.count_if((F.col("type") == "INVOLVES") & F.col("role").isNotNull())).alias("pct_valid")),
    ).withColumn("rate", F.round(F.try_divide(F.col("n_warnings") * 100.0, F.col("n_chunks")), 2))
    nothing = F.lit(None)
    graded = lambda c, good, stop, more: F.when(F.col(c).isNull(), "skip").when((F.col(c) >= good) if more else (F.col(c) <= good), "pass").when((F.col(c) < stop) if more else (F.col(c) > stop), "fail").otherwise("warn")
    return records(row, "3", [
        ("empty_chunks", F.col("n_empty"), nothing, _none("n_empty", "fail")), ("pct_involves_valid_role", nothing, F.col("pct_valid"), graded("pct_valid", 98, 90, True)),
        ("typing_warnings_per_100_chunks", F.col("n_warnings"), F.col("rate"), graded("rate", 3, 7, False)), ("low_echoes_count", F.col("n_echoes"), nothing, F.lit("info")),
    ])


def _dangling(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row, n_dangling: ends of edges that no node has. Ends are counted before they meet the nodes."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"), F.lit(1).alias("n"), F.lit(0).alias("there"))
    both = ends.unionByName(nodes.filter("id IS NOT NULL").select("id", F.lit(0).alias("n"), F.lit(1).alias("there")))
    counts = both.groupBy("id").agg(F.sum("n").alias("n"), F.max("there").alias("there"))
    return counts.agg(F.coalesce(F.sum(F.when(F.col("there") == 0, F.col("n"))), F.lit(0)).alias("n_dangling"))


def resolved_metrics(nodes: DataFrame, edges: DataFrame, proposals: DataFrame) -> DataFrame:
    """One row of the resolved graph: nodes have n_provenances, confidence, merged_from, review_needed and validated,
    edges source, target, type and review_needed."""
    ids = nodes.groupBy("id").agg(F.min("type").alias("t"))
    ends = _dangling(nodes, edges)
    eras = stage(ids.filter("t = 'Era'").select(F.col("id").alias("target")), "eras")  # few, so that all edges of one needn't meet in a task
    era = edges.filter("type = 'DURING'").join(eras, "target", "left_semi").select(F.col("source").alias("id"), F.lit(0).alias("event"), F.lit(1).alias("era"))
    both = nodes.filter("type = 'Event' AND id IS NOT NULL").select("id", F.lit(1).alias("event"), F.lit(0).alias("era")).unionByName(era)
    events = both.groupBy("id").agg(F.max("event").alias("event"), F.max("era").alias("era")).filter("event = 1")
    return one_row(
        nodes.agg(
            F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("confidence") < LOW).alias("n_low"), F.count_if(F.col("n_provenances") >= HUB).alias("n_hubs"), F.count_if(F.contains("merged_from", F.lit(","))).alias("n_merged"),
            F.count_if("review_needed").alias("n_review_nodes"), F.count_if("validated").alias("n_validated"), F.round(F.min("confidence"), 4).alias("least"), F.round(F.max("confidence"), 4).alias("most"), F.max("n_provenances").alias("most_provenances"),
        ),
        edges.agg(F.count(F.lit(1)).alias("n_edges"), F.count_if("review_needed").alias("n_review_edges"), *[F.count_if(F.col("type") == t).alias(f"n_{t.lower()}") for t in ("CAUSED", "FOLLOWS", "ECHOES")]),
        ends, events.agg(percent(F.sum("era"), F.count(F.lit(1))).alias("pct_era")), proposals.agg(F.count(F.lit(1)).alias("n_proposals")),
    ).withColumn("ratio", F.round(F.try_divide(F.col("n_caused"), F.col("n_follows")), 6))


def resolved_checks(row: DataFrame) -> DataFrame:
    """The checks of resolved_metrics()."""
    c, nothing = F.col, F.lit(None)
    review = c("n_review_nodes") + c("n_review_edges")
    return records(row, "4", [
        ("graph_integrity", c("n_dangling"), nothing, _none("n_dangling", "fail")), ("review_needed_flags", review, nothing, F.when(review == 0, "pass").otherwise("fail")),
        ("event_era_anchoring", nothing, c("pct_era"), F.when(c("pct_era").isNull(), "skip").when(c("pct_era") >= 60, "pass").otherwise("warn")),
        ("narrative_caused_ratio", nothing, c("ratio"), F.when(c("n_follows") == 0, "skip").when(c("ratio") >= 0.6, "pass").otherwise("warn")),
        ("low_confidence_provenance", c("n_low"), nothing, _none("n_low", "warn")), ("hub_spot_check", c("n_hubs"), nothing, _none("n_hubs", "warn")), ("merged_nodes_audit", c("n_merged"), nothing, _none("n_merged", "info")),
        ("low_echoes_count", c("n_echoes"), nothing, F.lit("info")), ("enrich_proposals_pending", c("n_proposals"), nothing, F.lit("info")),
        ("human_validation_coverage", c("n_validated"), F.round(100 * c("n_validated") / c("n_nodes"), 2), F.lit("info")),
    ])


def is_enrich(origin: Column) -> Column:
    """Whether an origin is a step of the enrichment."""
    return F.coalesce(F.startswith(origin, F.lit("stage5_")) | F.startswith(origin, F.lit("stage_5")), F.lit(False))


def enriched_metrics(nodes: DataFrame, edges: DataFrame, clusters: DataFrame, actions: DataFrame) -> DataFrame:
    """One row of the enriched graph: nodes (id, is_macro, review_needed, origin, n_provenances, validated), edges (source,
    target, type, review_needed, origin), clusters (status) and actions (action) of the decisions."""
    spec = edges.filter("type = 'SPECIALIZES'")
    lonely = nodes.filter("is_macro").select("id").distinct().join(spec.select(F.col("target").alias("id")).distinct(), "id", "left_anti")
    flagged = lambda enrich: F.count_if(F.col("review_needed") & (is_enrich(F.col("origin")) == enrich))
    return one_row(
        nodes.agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if("is_macro").alias("n_macro"), flagged(True).alias("nodes_enrich"), flagged(False).alias("nodes_other"), F.count_if(F.col("n_provenances") >= HUB).alias("n_hubs"), F.count_if("validated").alias("n_validated")),
        edges.agg(F.count(F.lit(1)).alias("n_edges"), F.count_if(is_enrich(F.col("origin"))).alias("n_enrich"), F.count_if(F.col("type") == "SPECIALIZES").alias("n_specializes"), flagged(True).alias("edges_enrich"), flagged(False).alias("edges_other")),
        lonely.agg(F.count(F.lit(1)).alias("n_lonely")), _dangling(nodes, edges), peel(spec.select("source", "target").distinct()).agg(F.count(F.lit(1)).alias("n_cyclic")),
        clusters.agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("applied", "review", "conflict")]), actions.agg(F.count(F.lit(1)).alias("n_actions"), F.count_if(F.col("action") == "incompatible").alias("n_skipped")),
    )


def enrich_contribution(edges: DataFrame) -> DataFrame:
    """Edges that the enrichment added, by type."""
    return edges.filter(is_enrich(F.col("origin"))).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def enriched_checks(row: DataFrame) -> DataFrame:
    """The checks of enriched_metrics()."""
    c, nothing = F.col, F.lit(None)
    waiting, own, other = c("n_review") + c("n_conflict"), c("nodes_enrich") + c("edges_enrich"), c("nodes_other") + c("edges_other")
    return records(row, "5", [
        ("graph_integrity", c("n_dangling"), nothing, _none("n_dangling", "fail")), ("enrich_arcs_materialized", c("n_enrich"), nothing, _none("n_enrich", "info", "warn")),
        ("specializes_acyclic", c("n_cyclic"), nothing, F.when(c("n_specializes") == 0, "skip").when(c("n_cyclic") == 0, "pass").otherwise("fail")), ("macro_theme_consistency", c("n_lonely"), nothing, _none("n_lonely", "warn")),
        ("enrich_review_queue", own, nothing, F.lit("info")), ("unexpected_review_needed", other, nothing, F.when(other == 0, "pass").otherwise("warn")), ("theme_consolidation_pending", waiting, nothing, F.when(waiting > 0, "warn").otherwise("pass")),
        ("embodies_skipped", c("n_skipped"), nothing, F.when(c("n_actions") == 0, "skip").when(c("n_skipped") > 0, "info").otherwise("pass")), ("hub_spot_check", c("n_hubs"), nothing, _none("n_hubs", "warn")),
        ("human_validation_coverage", c("n_validated"), F.round(100 * c("n_validated") / c("n_nodes"), 2), F.lit("info")),
    ])


def index_metrics(vectors: DataFrame, records_: DataFrame, texts: DataFrame, nodes: DataFrame, found: DataFrame, hashes: DataFrame) -> DataFrame:
    """One row of an index: vectors, records and texts (chunk_id), nodes (id, chunk_id), chunks found by smoke questions
    (q_id, n) and hashes (name, manifest, now)."""
    held = texts.select("chunk_id", F.lit(1).alias("t")).distinct()
    both = records_.select("chunk_id", F.lit(1).alias("r")).distinct().join(held, "chunk_id", "full").join(nodes.select("chunk_id", F.lit(1).alias("n")).distinct(), "chunk_id", "full")
    covered = nodes.select("id", "chunk_id").distinct().join(records_.select("chunk_id", F.lit(1).alias("r")).distinct(), "chunk_id", "left").groupBy("id").agg(F.max("r").alias("r"))
    there = lambda *on: reduce(lambda a, b: a & b, [F.col(x).isNotNull() if yes else F.col(x).isNull() for x, yes in on])
    return one_row(
        vectors.agg(F.count(F.lit(1)).alias("n_vectors")), records_.agg(F.count(F.lit(1)).alias("n_records")), texts.agg(F.count(F.lit(1)).alias("n_texts")),
        both.agg(F.count_if(there(("t", True), ("r", False))).alias("n_missing"), F.count_if(there(("r", True), ("t", False))).alias("n_extra"), F.count_if(there(("n", True), ("r", False))).alias("n_unindexed"), F.count_if(there(("r", True), ("n", False))).alias("n_dead")),
        covered.agg(F.count(F.lit(1)).alias("n_nodes"), percent(F.count("r"), F.count(F.lit(1))).alias("pct_covered")), found.agg(F.count(F.lit(1)).alias("n_questions"), F.count_if(F.col("n") == 0).alias("n_without")),
        hashes.agg(F.count_if((F.col("name") == "chunks") & ~F.col("manifest").eqNullSafe(F.col("now"))).alias("chunks_differ"), F.count_if((F.col("name") == "graph") & ~F.col("manifest").eqNullSafe(F.col("now"))).alias("graph_differs")),
    )


def index_checks(row: DataFrame) -> DataFrame:
    """The checks of index_metrics()."""
    c, nothing = F.col, F.lit(None)
    off = c("chunks_differ") + c("n_missing") + c("n_extra")
    return records(row, "6", [
        ("index_artifacts", c("n_vectors"), nothing, F.when((c("n_vectors") > 0) & (c("n_vectors") == c("n_records")) & (c("n_records") == c("n_texts")), "pass").otherwise("fail")), ("chunks_consistency", off, nothing, F.when(off == 0, "pass").otherwise("warn")),
        ("graph_consistency", c("graph_differs"), nothing, _none("graph_differs", "warn")), ("node_coverage", c("n_unindexed"), c("pct_covered"), F.when(c("n_unindexed") > 0, "warn").when(c("pct_covered") < 95, "info").otherwise("pass")),
        ("chunk_reference", c("n_dead"), nothing, F.lit("info")), ("smoke_retrieval", c("n_without"), nothing, F.when(c("n_questions") == 0, "skip").when(c("n_without") > 0, "warn").otherwise("pass")),
    ])


def verdict(checks: DataFrame) -> DataFrame:
    """One row: fail if a blocking check fails, pass_with_warnings if any warns, else pass; and the counts by status."""
    counts = checks.agg(F.coalesce(F.bool_or(F.col("blocking") & (F.col("status") == "fail")), F.lit(False)).alias("stops"), *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("fail", "warn", "pass", "info", "skip")])
    return counts.select(F.when(F.col("stops"), "fail").when(F.col("n_warn") > 0, "pass_with_warnings").otherwise("pass").alias("verdict"), "n_fail", "n_warn", "n_pass", "n_info", "n_skip")


def review_queue(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, id, reason): flagged nodes and edges, and hubs."""
    key = F.concat_ws("|", "source", "type", "target")
    return (
        nodes.filter("review_needed").select(F.lit("node").alias("kind"), "id", F.lit("review_needed").alias("reason")).unionByName(edges.filter("review_needed").select(F.lit("edge").alias("kind"), key.alias("id"), F.lit("review_needed").alias("reason")))
        .unionByName(nodes.filter(F.col("n_provenances") >= HUB).select(F.lit("node").alias("kind"), "id", F.lit("hub").alias("reason")))
    )


def extraction_queue(clashes: DataFrame, chunks: DataFrame, events: DataFrame, dense: int = 8) -> DataFrame:
    """(priority, kind, id): ids of several types and empty chunks first, then the events (id, degree) of the highest degree."""
    return (
        clashes.select(F.lit(1).alias("priority"), F.lit("type clash").alias("kind"), "id").unionByName(chunks.filter("n = 0").select(F.lit(1).alias("priority"), F.lit("empty chunk").alias("kind"), F.col("chunk_id").alias("id")))
        .unionByName(events.orderBy(F.desc("degree"), "id").limit(dense).select(F.lit(2).alias("priority"), F.lit("dense event").alias("kind"), "id"))
    )
