"""Checks, metrics and queues of the resolved graph, the enriched graph and the index, with oracle SQL.

The tables hold no review marks and no enrichment, so rules on the resolved graph stand in for both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import stage
from ..operators import graph, health, resolve, subject, validate
from ..sources.adapter import edges, nodes, with_occurrences
from .graph_queries import _ROLE, RESOLVED, _compatible_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, function: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    QUERIES[name] = function
    if sql:
        ORACLES[name] = with_occurrences(sql)


def _flagged(s: SparkSession, d: str, once: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolved nodes and edges: nodes of several names are to be reviewed, certain ones are validated; and the names of all
    occurrences. Occurrences are made from the tables again where they are read, as written ones take more disk; edges are
    not written if they are read once."""
    n = nodes(s, d)
    known = resolve.told(n)
    found = resolve.resolved_nodes(n, known, chunks=False).withColumn("review_needed", F.col("n_names") > 1).withColumn("validated", F.col("confidence") >= 1)
    e = resolve.resolved_edges(n, edges(s, d), known, chunks=False).withColumn("review_needed", F.col("n_provenances") > 40)
    e = e.select("source", "target", "type", "review_needed")
    return stage(found, "nodes"), e if once else stage(e, "edges"), known.names


_FLAGGED = RESOLVED + """, rnd AS (SELECT *, n_names > 1 AS review_needed, confidence >= 1 AS validated FROM res), red AS (SELECT *, n_provenances > 40 AS review_needed FROM edg),
prp AS (SELECT max(new_id) FILTER (type <> 'Theme') AS source, max(new_id) FILTER (type = 'Theme') AS target FROM spl GROUP BY id HAVING count(*) FILTER (type = 'Theme') > 0 AND count(*) FILTER (type <> 'Theme') > 0)"""
_METRICS4 = _FLAGGED + """, ids AS (SELECT id, min(type) AS t FROM rnd GROUP BY id),
dan AS (SELECT count(*) AS n FROM (SELECT unnest([source, target]) AS e FROM red) WHERE e NOT IN (SELECT id FROM ids)),
era AS (SELECT DISTINCT source AS id FROM red JOIN ids ON ids.id = target AND t = 'Era' WHERE red.type = 'DURING'),
m4 AS (SELECT count(*) AS n_nodes, count(*) FILTER (confidence < 0.7::DOUBLE) AS n_low, count(*) FILTER (n_provenances >= 20) AS n_hubs, count(*) FILTER (contains(merged_from, ',')) AS n_merged,
  count(*) FILTER (review_needed) AS n_review_nodes, count(*) FILTER (validated) AS n_validated, round(min(confidence), 4) AS least, round(max(confidence), 4) AS most, max(n_provenances) AS most_provenances,
  (SELECT count(*) FROM red) AS n_edges, (SELECT count(*) FROM red WHERE review_needed) AS n_review_edges, (SELECT count(*) FROM red WHERE type = 'CAUSED') AS n_caused,
  (SELECT count(*) FROM red WHERE type = 'FOLLOWS') AS n_follows, (SELECT count(*) FROM red WHERE type = 'ECHOES') AS n_echoes, (SELECT n FROM dan) AS n_dangling,
  (SELECT round(100 * count(era.id)::DOUBLE / count(*), 2) FROM (SELECT DISTINCT id FROM rnd WHERE type = 'Event') e LEFT JOIN era USING (id)) AS pct_era, (SELECT count(*) FROM prp) AS n_proposals FROM rnd),
m4r AS (SELECT *, round(n_caused::DOUBLE / nullif(n_follows, 0), 6) AS ratio FROM m4)"""


def _rows(stage_: str, source: str, listed: list[tuple[str, str, str, str]]) -> str:
    """Check records in SQL from (check, count, value, status)."""
    return " UNION ALL ".join(f"SELECT '{stage_}' AS stage, '{c}' AS \"check\", {str(c in health.BLOCKING).lower()} AS blocking, CAST({n} AS BIGINT) AS count, CAST({v} AS DOUBLE) AS value, {s} AS status FROM {source}" for c, n, v, s in listed)


def _zero(count: str, otherwise: str, then: str = "pass") -> str:
    return f"CASE WHEN {count} = 0 THEN '{then}' ELSE '{otherwise}' END"


_CHECKS4 = _rows("4", "m4r", [
    ("graph_integrity", "n_dangling", "NULL", _zero("n_dangling", "fail")), ("review_needed_flags", "n_review_nodes + n_review_edges", "NULL", _zero("n_review_nodes + n_review_edges", "fail")),
    ("event_era_anchoring", "NULL", "pct_era", "CASE WHEN pct_era IS NULL THEN 'skip' WHEN pct_era >= 60 THEN 'pass' ELSE 'warn' END"), ("narrative_caused_ratio", "NULL", "ratio", "CASE WHEN n_follows = 0 THEN 'skip' WHEN ratio >= 0.6::DOUBLE THEN 'pass' ELSE 'warn' END"),
    ("low_confidence_provenance", "n_low", "NULL", _zero("n_low", "warn")), ("hub_spot_check", "n_hubs", "NULL", _zero("n_hubs", "warn")), ("merged_nodes_audit", "n_merged", "NULL", _zero("n_merged", "info")),
    ("low_echoes_count", "n_echoes", "NULL", "'info'"), ("enrich_proposals_pending", "n_proposals", "NULL", "'info'"), ("human_validation_coverage", "n_validated", "round(100 * n_validated::DOUBLE / n_nodes, 2)", "'info'"),
])


def _metrics4(s: SparkSession, d: str) -> DataFrame:
    n, e, names = _flagged(s, d)
    return health.resolved_metrics(n, e, resolve.proposals(names))


query("resolved_metrics", _metrics4, _METRICS4 + " SELECT * FROM m4r")
query("resolved_checks", lambda s, d: health.resolved_checks(_metrics4(s, d)), _METRICS4 + " " + _CHECKS4)
_VERDICT = """SELECT CASE WHEN coalesce(bool_or(blocking AND status = 'fail'), false) THEN 'fail' WHEN count(*) FILTER (status = 'warn') > 0 THEN 'pass_with_warnings' ELSE 'pass' END AS verdict,
  count(*) FILTER (status = 'fail') AS n_fail, count(*) FILTER (status = 'warn') AS n_warn, count(*) FILTER (status = 'pass') AS n_pass, count(*) FILTER (status = 'info') AS n_info, count(*) FILTER (status = 'skip') AS n_skip"""
query("resolved_verdict", lambda s, d: health.verdict(health.resolved_checks(_metrics4(s, d))), f"{_METRICS4}, chk AS ({_CHECKS4}) {_VERDICT} FROM chk")
query("resolved_queue", lambda s, d: health.review_queue(*_flagged(s, d, once=True)[:2]), _FLAGGED + """ SELECT 'node' AS kind, id, 'review_needed' AS reason FROM rnd WHERE review_needed
UNION ALL SELECT 'edge', concat_ws('|', source, type, target), 'review_needed' FROM red WHERE review_needed UNION ALL SELECT 'node', id, 'hub' FROM rnd WHERE n_provenances >= 20""")


def _enriched(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The resolved graph with macro themes (the first word of a theme's name), SPECIALIZES edges to them, and proposed EMBODIES edges; and the names of all occurrences."""
    n, e, names = _flagged(s, d)
    own = lambda df: df.withColumn("origin", F.lit(None).cast("string"))
    n = n.select("id", "type", F.lit(False).alias("is_macro"), "review_needed", "n_provenances", "validated")
    e = own(e.select("source", "target", "type", "review_needed"))
    first = F.split("name", " ")[0]
    told = names.filter("type = 'Theme' AND id LIKE 'th_%'").select(F.col("id").alias("source"), F.concat(F.lit("ma_"), first).alias("target")).distinct()
    macro = told.groupBy(F.col("target").alias("id")).agg(F.count(F.lit(1)).alias("n_provenances")).unionByName(s.createDataFrame([("ma_EMPTY", 0)], "id string, n_provenances long"))
    macro = macro.select("id", F.lit("Theme").alias("type"), F.lit(True).alias("is_macro"), (F.col("n_provenances") % 2 == 0).alias("review_needed"), "n_provenances", F.lit(False).alias("validated"), F.lit("stage5_3d_hierarchy").alias("origin"))
    spec = told.select("source", "target", F.lit("SPECIALIZES").alias("type"), F.lit(False).alias("review_needed"), F.lit("stage5_3d_hierarchy").alias("origin"))
    emb = resolve.proposals(names).select(F.col("source_id").alias("source"), F.col("target_id").alias("target"), F.lit("EMBODIES").alias("type"), F.lit(True).alias("review_needed"), F.lit("stage_5-1_embodies").alias("origin"))
    return own(n).unionByName(macro), e.unionByName(spec).unionByName(emb), names


_ENRICHED = _FLAGGED + """, tol AS (SELECT DISTINCT id AS source, 'ma_' || string_split(name, ' ')[1] AS target FROM node_occ WHERE type = 'Theme' AND id LIKE 'th_%'),
mac AS (SELECT target AS id, count(*) AS n FROM tol GROUP BY 1 UNION ALL SELECT 'ma_EMPTY', 0),
een AS (SELECT id, type, false AS is_macro, review_needed, n_provenances, validated, NULL AS origin FROM rnd UNION ALL SELECT id, 'Theme', true, n % 2 = 0, n, false, 'stage5_3d_hierarchy' FROM mac),
eed AS (SELECT source, target, type, review_needed, NULL AS origin FROM red UNION ALL SELECT source, target, 'SPECIALIZES', false, 'stage5_3d_hierarchy' FROM tol UNION ALL SELECT source, target, 'EMBODIES', true, 'stage_5-1_embodies' FROM prp)"""


def _metrics5(s: SparkSession, d: str) -> DataFrame:
    n, e, names = _enriched(s, d)
    clusters = resolve.merge_decisions(names).select(F.when(F.col("decision") == "auto", "applied").otherwise("review").alias("status"))
    actions = validate.embody_actions(resolve.proposals(names), n, e)
    return health.enriched_metrics(n, e, clusters, actions)


_EM = f"({_compatible_sql(chr(39) + 'EMBODIES' + chr(39), 'a.t', 'b.t')})"
_METRICS5 = _ENRICHED + f""", idn AS (SELECT id, min(type) AS t FROM een GROUP BY id), act AS (SELECT a.t IS NOT NULL AND b.t IS NOT NULL AND NOT {_EM} AS skipped FROM prp LEFT JOIN idn a ON a.id = source LEFT JOIN idn b ON b.id = target),
m5 AS (SELECT count(*) AS n_nodes, count(*) FILTER (is_macro) AS n_macro, count(*) FILTER (review_needed AND origin IS NOT NULL) AS nodes_enrich, count(*) FILTER (review_needed AND origin IS NULL) AS nodes_other,
  count(*) FILTER (n_provenances >= 20) AS n_hubs, count(*) FILTER (validated) AS n_validated, (SELECT count(*) FROM eed) AS n_edges, (SELECT count(*) FROM eed WHERE origin IS NOT NULL) AS n_enrich,
  (SELECT count(*) FROM eed WHERE type = 'SPECIALIZES') AS n_specializes, (SELECT count(*) FROM eed WHERE review_needed AND origin IS NOT NULL) AS edges_enrich, (SELECT count(*) FROM eed WHERE review_needed AND origin IS NULL) AS edges_other,
  (SELECT count(*) FROM een WHERE is_macro AND id NOT IN (SELECT target FROM eed WHERE type = 'SPECIALIZES')) AS n_lonely, (SELECT count(*) FROM (SELECT unnest([source, target]) AS x FROM eed) WHERE x NOT IN (SELECT id FROM idn)) AS n_dangling,
  (SELECT count(*) FROM eed x JOIN eed y ON y.type = 'SPECIALIZES' AND y.target = x.source JOIN eed z ON z.type = 'SPECIALIZES' AND z.source = x.target WHERE x.type = 'SPECIALIZES') AS n_cyclic,
  (SELECT count(*) FROM dec WHERE n_top = 1 AND groups = 1) AS n_applied, (SELECT count(*) FROM dec WHERE NOT (n_top = 1 AND groups = 1)) AS n_review, CAST(0 AS BIGINT) AS n_conflict,
  (SELECT count(*) FROM act) AS n_actions, (SELECT count(*) FROM act WHERE skipped) AS n_skipped FROM een)"""
_CHECKS5 = _rows("5", "m5", [
    ("graph_integrity", "n_dangling", "NULL", _zero("n_dangling", "fail")), ("enrich_arcs_materialized", "n_enrich", "NULL", _zero("n_enrich", "info", "warn")),
    ("specializes_acyclic", "n_cyclic", "NULL", "CASE WHEN n_specializes = 0 THEN 'skip' WHEN n_cyclic = 0 THEN 'pass' ELSE 'fail' END"), ("macro_theme_consistency", "n_lonely", "NULL", _zero("n_lonely", "warn")),
    ("enrich_review_queue", "nodes_enrich + edges_enrich", "NULL", "'info'"), ("unexpected_review_needed", "nodes_other + edges_other", "NULL", _zero("nodes_other + edges_other", "warn")),
    ("theme_consolidation_pending", "n_review + n_conflict", "NULL", _zero("n_review + n_conflict", "warn")), ("embodies_skipped", "n_skipped", "NULL", "CASE WHEN n_actions = 0 THEN 'skip' WHEN n_skipped > 0 THEN 'info' ELSE 'pass' END"),
    ("hub_spot_check", "n_hubs", "NULL", _zero("n_hubs", "warn")), ("human_validation_coverage", "n_validated", "round(100 * n_validated::DOUBLE / n_nodes, 2)", "'info'"),
])
query("enriched_metrics", _metrics5, _METRICS5 + " SELECT * FROM m5")
query("enriched_checks", lambda s, d: health.enriched_checks(_metrics5(s, d)), _METRICS5 + " " + _CHECKS5)
query("enriched_verdict", lambda s, d: health.verdict(health.enriched_checks(_metrics5(s, d))), f"{_METRICS5}, chk AS ({_CHECKS5}) {_VERDICT} FROM chk")
query("enriched_queue", lambda s, d: health.review_queue(*_enriched(s, d)[:2]), _ENRICHED + """ SELECT 'node' AS kind, id, 'review_needed' AS reason FROM een WHERE review_needed
UNION ALL SELECT 'edge', concat_ws('|', source, type, target), 'review_needed' FROM eed WHERE review_needed UNION ALL SELECT 'node', id, 'hub' FROM een WHERE n_provenances >= 20""")
query("enrich_contribution", lambda s, d: health.enrich_contribution(_enriched(s, d)[1]), _ENRICHED + " SELECT type, count(*) AS n FROM eed WHERE origin IS NOT NULL GROUP BY type")
query("enrich_origin", lambda s, d: _enriched(s, d)[1].groupBy("type", health.is_enrich(F.col("origin")).alias("enrich")).agg(F.count(F.lit(1)).alias("n")), _ENRICHED + " SELECT type, origin IS NOT NULL AS enrich, count(*) AS n FROM eed GROUP BY ALL")


def _index(s: SparkSession, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/embeddings.parquet")
    chunk = lambda k: F.concat(F.lit("ch_"), F.lpad((F.col("vec_id") * 3 - k).cast("string"), 12, "0")).alias("chunk_id")
    found = e.filter("vec_id < 5").select(F.col("vec_id").alias("q_id"), (F.col("vec_id") % 3).alias("n"))
    hashes = s.createDataFrame([("chunks", "a1", "a1"), ("graph", "b2", "b3")], "name string, manifest string, now string")
    return health.index_metrics(e, e.select(chunk(30)), e.filter("vec_id % 9 <> 0").select(chunk(30)), nodes(s, d), found, hashes)


_METRICS6 = """WITH idx AS (SELECT DISTINCT 'ch_' || lpad(CAST(vec_id * 3 - 30 AS VARCHAR), 12, '0') AS chunk_id FROM embeddings), txt AS (SELECT DISTINCT 'ch_' || lpad(CAST(vec_id * 3 - 30 AS VARCHAR), 12, '0') AS chunk_id FROM embeddings WHERE vec_id % 9 <> 0),
chu AS (SELECT DISTINCT chunk_id FROM node_occ),
m6 AS (SELECT (SELECT count(*) FROM embeddings) AS n_vectors, (SELECT count(*) FROM embeddings) AS n_records, (SELECT count(*) FROM embeddings WHERE vec_id % 9 <> 0) AS n_texts,
  (SELECT count(*) FROM txt WHERE chunk_id NOT IN (SELECT chunk_id FROM idx)) AS n_missing, (SELECT count(*) FROM idx WHERE chunk_id NOT IN (SELECT chunk_id FROM txt)) AS n_extra,
  (SELECT count(*) FROM chu WHERE chunk_id NOT IN (SELECT chunk_id FROM idx)) AS n_unindexed, (SELECT count(*) FROM idx WHERE chunk_id NOT IN (SELECT chunk_id FROM chu)) AS n_dead, (SELECT count(DISTINCT id) FROM node_occ) AS n_nodes,
  (SELECT round(100 * (SELECT count(DISTINCT id) FROM node_occ WHERE chunk_id IN (SELECT chunk_id FROM idx))::DOUBLE / count(DISTINCT id), 2) FROM node_occ) AS pct_covered,
  (SELECT count(*) FROM embeddings WHERE vec_id < 5) AS n_questions, (SELECT count(*) FROM embeddings WHERE vec_id < 5 AND vec_id % 3 = 0) AS n_without, CAST(0 AS BIGINT) AS chunks_differ, CAST(1 AS BIGINT) AS graph_differs)"""
_CHECKS6 = _rows("6", "m6", [
    ("index_artifacts", "n_vectors", "NULL", "CASE WHEN n_vectors > 0 AND n_vectors = n_records AND n_records = n_texts THEN 'pass' ELSE 'fail' END"), ("chunks_consistency", "chunks_differ + n_missing + n_extra", "NULL", _zero("chunks_differ + n_missing + n_extra", "warn")),
    ("graph_consistency", "graph_differs", "NULL", _zero("graph_differs", "warn")), ("node_coverage", "n_unindexed", "pct_covered", "CASE WHEN n_unindexed > 0 THEN 'warn' WHEN pct_covered < 95 THEN 'info' ELSE 'pass' END"),
    ("chunk_reference", "n_dead", "NULL", "'info'"), ("smoke_retrieval", "n_without", "NULL", "CASE WHEN n_questions = 0 THEN 'skip' WHEN n_without > 0 THEN 'warn' ELSE 'pass' END"),
])
query("index_metrics", _index, _METRICS6 + " SELECT * FROM m6")
query("index_checks", lambda s, d: health.index_checks(_index(s, d)), _METRICS6 + " " + _CHECKS6)
query("index_verdict", lambda s, d: health.verdict(health.index_checks(_index(s, d))), f"{_METRICS6}, chk AS ({_CHECKS6}) {_VERDICT} FROM chk")


def _chunk_sizes(s: SparkSession, d: str) -> DataFrame:
    """Every order is a chunk; what stands in it counts if its confidence is above 0.985, so that some chunks are empty."""
    all_ = s.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("ch_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("chunk_id"))
    counts = nodes(s, d).filter("confidence > 0.985").groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"))
    return all_.join(counts, "chunk_id", "left").select("chunk_id", F.coalesce("n", F.lit(0)).alias("n"))


_CHUNKS = "chz AS (SELECT 'ch_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS chunk_id, coalesce(n, 0) AS n FROM orders LEFT JOIN (SELECT chunk_id, count(*) AS n FROM node_occ WHERE confidence > 0.985::DOUBLE GROUP BY 1) c ON c.chunk_id = 'ch_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0'))"
_TYPED = """loc AS (SELECT chunk_id, id, arg_min(type, (pos, type)) AS t FROM node_occ GROUP BY chunk_id, id),
typ AS (SELECT e.*, a.t AS source_type, b.t AS target_type FROM edge_occ e LEFT JOIN loc a ON a.chunk_id = e.chunk_id AND a.id = e.source_id LEFT JOIN loc b ON b.chunk_id = e.chunk_id AND b.id = e.target_id)"""


def _extraction(s: SparkSession, d: str) -> DataFrame:
    e = edges(s, d).withColumn("role", F.when(F.col("pos") % 50 == 21, "nobody").otherwise(F.col("role")))
    warnings = validate.invalid_edges(nodes(s, d), edges(s, d)).filter("reason = 'incompatible types'")
    return health.extraction_checks(_chunk_sizes(s, d), e, warnings, validate.role_valid(F.col("type"), F.col("role")))


query("extraction_checks", _extraction, f"""WITH {_CHUNKS}, {_TYPED},
rol AS (SELECT type, CASE WHEN pos % 50 = 21 THEN 'nobody' ELSE role END AS role FROM edge_occ), wrn AS (SELECT count(*) AS n FROM typ WHERE source_type IS NOT NULL AND target_type IS NOT NULL AND NOT ({_compatible_sql('type', 'source_type', 'target_type')})),
m3 AS (SELECT count(*) AS n_chunks, count(*) FILTER (n = 0) AS n_empty, (SELECT n FROM wrn) AS n_warnings, (SELECT count(*) FROM rol WHERE type = 'ECHOES') AS n_echoes,
  (SELECT round(100 * (count(*) FILTER ({_ROLE}))::DOUBLE / count(*) FILTER (role IS NOT NULL), 2) FROM rol WHERE type = 'INVOLVES') AS pct_valid FROM chz), m3r AS (SELECT *, round(n_warnings * 100.0::DOUBLE / n_chunks, 2) AS rate FROM m3)
""" + _rows("3", "m3r", [
    ("empty_chunks", "n_empty", "NULL", _zero("n_empty", "fail")), ("pct_involves_valid_role", "NULL", "pct_valid", "CASE WHEN pct_valid IS NULL THEN 'skip' WHEN pct_valid >= 98 THEN 'pass' WHEN pct_valid < 90 THEN 'fail' ELSE 'warn' END"),
    ("typing_warnings_per_100_chunks", "n_warnings", "rate", "CASE WHEN rate IS NULL THEN 'skip' WHEN rate <= 3 THEN 'pass' WHEN rate > 7 THEN 'fail' ELSE 'warn' END"), ("low_echoes_count", "n_echoes", "NULL", "'info'"),
]))


def _queue3(s: SparkSession, d: str) -> DataFrame:
    n, e, names = _flagged(s, d)
    return health.extraction_queue(resolve.type_collisions(names), _chunk_sizes(s, d), graph.degrees(n, e).filter("type = 'Event'"))


query("extraction_queue", _queue3, f"""{_FLAGGED}, {_CHUNKS}, par AS (SELECT DISTINCT least(source, target) AS a, greatest(source, target) AS b FROM edg),
deg AS (SELECT id, count(*) AS d FROM (SELECT unnest([a, b]) AS id FROM par) GROUP BY id), evd AS (SELECT r.id, coalesce(d, 0) AS d FROM res r LEFT JOIN deg USING (id) WHERE type = 'Event' ORDER BY d DESC, r.id LIMIT 8)
SELECT 1 AS priority, 'type clash' AS kind, id FROM col UNION ALL SELECT 1, 'empty chunk', chunk_id FROM chz WHERE n = 0 UNION ALL SELECT 2, 'dense event', id FROM evd""")

# the subject, phases and events
_SUBJECT = "cu_1"


def _persons(s: SparkSession, d: str) -> DataFrame:
    """Person occurrences; customers of a number that 500 divides have a birth year, none is marked as the subject."""
    return nodes(s, d).withColumn("is_subject", F.lit(False)).withColumn("birth_year", F.when(F.expr("id RLIKE '^cu_[0-9]*00$'"), F.lit(1900)))


query("subject_by_hint", lambda s, d: subject.resolved_subject(_persons(s, d), _SUBJECT), f"SELECT CASE WHEN EXISTS (SELECT 1 FROM node_occ WHERE id = '{_SUBJECT}') THEN '{_SUBJECT}' ELSE (SELECT min(id) FROM node_occ WHERE type = 'Person' AND regexp_matches(id, '^cu_[0-9]*00$')) END AS subject_id, CASE WHEN EXISTS (SELECT 1 FROM node_occ WHERE id = '{_SUBJECT}') THEN 'hint_id' WHEN EXISTS (SELECT 1 FROM node_occ WHERE type = 'Person' AND regexp_matches(id, '^cu_[0-9]*00$')) THEN 'birth_year' END AS detection, CASE WHEN EXISTS (SELECT 1 FROM node_occ WHERE id = '{_SUBJECT}') THEN '' ELSE coalesce((SELECT CASE WHEN count(DISTINCT id) > 1 THEN string_agg(DISTINCT id, ',' ORDER BY id) ELSE '' END FROM node_occ WHERE type = 'Person' AND regexp_matches(id, '^cu_[0-9]*00$')), '') END AS ambiguous")
query("subject_by_profile", lambda s, d: subject.resolved_subject(_persons(s, d), "nobody"), "WITH p AS (SELECT DISTINCT id FROM node_occ WHERE type = 'Person' AND regexp_matches(id, '^cu_[0-9]*00$')) SELECT min(id) AS subject_id, CASE WHEN count(*) > 0 THEN 'birth_year' END AS detection, CASE WHEN count(*) > 1 THEN string_agg(id, ',' ORDER BY id) ELSE '' END AS ambiguous FROM p")
query("subject_check", lambda s, d: subject.checked(nodes(s, d), edges(s, d), "su_1"), "WITH i AS (SELECT role FROM edge_occ WHERE type = 'INVOLVES' AND 'su_1' IN (source_id, target_id)), p AS (SELECT count(DISTINCT id) AS n FROM node_occ WHERE type = 'Person' AND id = 'su_1') SELECT 'su_1' AS subject_id, (SELECT n FROM p) AS n_nodes, (SELECT n FROM p) = 1 AS exactly_one, count(*) AS n_involves, CASE WHEN count(*) > 0 THEN round(100 * (count(*) FILTER (role = 'protagonist'))::DOUBLE / count(*), 2) END AS pct_protagonist FROM i")
query("subject_type", lambda s, d: subject.wrong_type(nodes(s, d), ["su_1", "ph_1", "cu_1", "er_1"]), "SELECT id, string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM node_occ WHERE id IN ('su_1', 'ph_1', 'cu_1', 'er_1') AND type <> 'Person' GROUP BY id")
query("event_load", lambda s, d: subject.event_chunks(nodes(s, d).unionByName(nodes(s, d).filter("type = 'Event'").withColumn("chunk_id", F.expr("concat('ch_', lpad(CAST(pos % 700 AS STRING), 12, '0'))")))), "WITH o AS (SELECT id, chunk_id FROM node_occ WHERE type = 'Event' UNION ALL SELECT id, 'ch_' || lpad(CAST(pos % 700 AS VARCHAR), 12, '0') FROM node_occ WHERE type = 'Event'), k AS (SELECT DISTINCT id, CAST(regexp_extract(chunk_id, '([0-9]+)', 1) AS BIGINT) AS o FROM o) SELECT id, string_agg(CAST(o AS VARCHAR), ',' ORDER BY o) AS ordinals, min(o) AS first FROM k GROUP BY id")


def _transforms(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Phases by user; each turns into the one that is a third of it."""
    users = s.read.parquet(f"{d}/events.parquet").select("user_id").distinct()
    n = users.select(F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("id"))
    t = users.filter("user_id % 3 = 0 AND user_id > 0").select(F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("source"), F.concat(F.lit("u_"), (F.col("user_id") / 3).cast("long").cast("string")).alias("target"))
    return n, t.join(n.withColumnRenamed("id", "target"), "target", "left_semi").select("source", "target")


query("phase_chains", lambda s, d: subject.chains(*_transforms(s, d)), """WITH RECURSIVE u AS (SELECT DISTINCT user_id AS u FROM events), t AS (SELECT u AS a, u // 3 AS b FROM u WHERE u % 3 = 0 AND u > 0 AND u // 3 IN (SELECT u FROM u)),
k AS (SELECT a AS x, a AS y FROM t UNION SELECT b, b FROM t UNION SELECT k.x, z.o FROM k JOIN (SELECT a AS i, b AS o FROM t UNION ALL SELECT b, a FROM t) z ON z.i = k.y),
c AS (SELECT x, min('u_' || CAST(y AS VARCHAR)) AS root FROM k GROUP BY x),
l AS (SELECT u AS x, 0 AS lv FROM u WHERE u NOT IN (SELECT b FROM t) UNION ALL SELECT t.b, lv + 1 FROM l JOIN t ON t.a = l.x), v AS (SELECT x, max(lv) AS lv FROM l GROUP BY x)
SELECT root AS chain, 'u_' || CAST(x AS VARCHAR) AS id, CAST(row_number() OVER (PARTITION BY root ORDER BY lv, 'u_' || CAST(x AS VARCHAR)) AS INTEGER) AS place, count(*) OVER (PARTITION BY root) AS n FROM c JOIN v USING (x)""")
query("phase_events", lambda s, d: subject.phase_events(nodes(s, d), edges(s, d)), "WITH p AS (SELECT DISTINCT id FROM node_occ WHERE type = 'Phase'), k AS (SELECT id, min(type) AS t FROM node_occ GROUP BY id), c AS (SELECT target_id AS id, count(DISTINCT source_id) AS n FROM edge_occ JOIN k ON k.id = source_id AND t = 'Event' WHERE type = 'DURING' GROUP BY 1) SELECT id, coalesce(n, 0) AS n_events, coalesce(n, 0) <= 2 AS isolated FROM p LEFT JOIN c USING (id)")
