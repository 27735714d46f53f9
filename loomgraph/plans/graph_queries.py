"""Queries over node and edge occurrences, with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.schema import EDGE_RULES
from ..functions.staging import stage
from ..operators import graph, metrics, resolve, validate
from ..sources.adapter import edges, nodes, with_occurrences

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


NORM = "lower(trim(regexp_replace(name, '\\s+', ' ', 'g')))"

#: Resolved tables as common table expressions of oracles.
RESOLVED = f"""WITH per_name AS (SELECT type, {NORM} AS norm, id, count(*) AS n FROM node_occ GROUP BY ALL),
grp AS (SELECT *, count(*) OVER (PARTITION BY type, norm) AS n_ids FROM per_name),
mem AS (SELECT *, rank() OVER (PARTITION BY type, norm ORDER BY n DESC) AS place, count(*) OVER (PARTITION BY id) AS groups FROM grp WHERE n_ids > 1),
dec AS MATERIALIZED (SELECT type, norm, string_agg(id, ',' ORDER BY id) AS ids, count(*) FILTER (place = 1) AS n_top, min(id) FILTER (place = 1) AS top, max(groups) AS groups FROM mem GROUP BY type, norm),
mrg AS MATERIALIZED (SELECT m.id AS loser, d.top AS canonical_id FROM mem m JOIN dec d USING (type, norm) WHERE d.n_top = 1 AND d.groups = 1 AND m.id <> d.top),
col AS (SELECT id FROM node_occ GROUP BY id HAVING count(DISTINCT type) > 1),
spl AS MATERIALIZED (SELECT id, type, id || '__' || lower(type) AS new_id, count(*) AS n FROM node_occ JOIN col USING (id) GROUP BY id, type),
mov AS (SELECT o.*, coalesce(m.canonical_id, s.new_id, o.id) AS final_id FROM node_occ o LEFT JOIN spl s USING (id, type) LEFT JOIN mrg m ON m.loser = coalesce(s.new_id, o.id)),
loc AS MATERIALIZED (SELECT chunk_id, id, arg_min(type, (pos, type)) AS t FROM node_occ GROUP BY chunk_id, id),
typ AS MATERIALIZED (SELECT e.*, a.t AS source_type, b.t AS target_type FROM edge_occ e LEFT JOIN loc a ON a.chunk_id = e.chunk_id AND a.id = e.source_id LEFT JOIN loc b ON b.chunk_id = e.chunk_id AND b.id = e.target_id),
mve AS (SELECT t.*, coalesce(m1.canonical_id, s1.new_id, t.source_id) AS source, coalesce(m2.canonical_id, s2.new_id, t.target_id) AS target FROM typ t
  LEFT JOIN spl s1 ON s1.id = t.source_id AND s1.type = t.source_type LEFT JOIN mrg m1 ON m1.loser = coalesce(s1.new_id, t.source_id)
  LEFT JOIN spl s2 ON s2.id = t.target_id AND s2.type = t.target_type LEFT JOIN mrg m2 ON m2.loser = coalesce(s2.new_id, t.target_id)
  WHERE t.source_type IS NOT NULL AND t.target_type IS NOT NULL),
nam AS (SELECT final_id, type, name, count(*) AS n, min(pos) AS first FROM mov GROUP BY ALL),
res AS MATERIALIZED (SELECT a.final_id AS id, a.type, b.name, a.n_provenances, a.merged_from, b.n_names, a.confidence, a.n_chunks FROM
  (SELECT final_id, type, count(*) AS n_provenances, string_agg(DISTINCT id, ',' ORDER BY id) AS merged_from, round(max(confidence), 6) AS confidence, count(DISTINCT chunk_id) AS n_chunks FROM mov GROUP BY ALL) a
  JOIN (SELECT final_id, type, arg_max(name, (n, -first)) AS name, count(*) AS n_names FROM nam GROUP BY ALL) b USING (final_id, type)),
edg AS MATERIALIZED (SELECT source, target, type, role, count(*) AS n_provenances, min(chunk_id) AS first_chunk FROM mve WHERE source <> target GROUP BY ALL)
"""


def query(name: str, function: Callable[[DataFrame, DataFrame], DataFrame], sql: str | None) -> None:
    """function gets node and edge occurrences, which none reads more than twice: written, they would be larger than what they are made of."""
    QUERIES[name] = lambda spark, sf_dir: function(nodes(spark, sf_dir), edges(spark, sf_dir))
    if sql:
        ORACLES[name] = with_occurrences(sql)


query("node_index", lambda n, e: resolve.node_index(n), f"WITH a AS (SELECT type, id, {NORM} AS norm, count(*) AS n FROM node_occ GROUP BY ALL), b AS (SELECT type, norm, CAST(sum(n) AS BIGINT) AS n_name FROM a GROUP BY ALL), c AS (SELECT type, id, CAST(sum(n) AS BIGINT) AS n_id, min(norm) AS norm FROM a GROUP BY ALL) SELECT type, norm, id, n_id, n_name FROM c JOIN b USING (type, norm)")
query("type_collisions", lambda n, e: resolve.type_collisions(n), "SELECT id, string_agg(DISTINCT type, ',' ORDER BY type) AS types, count(DISTINCT type) AS n_types, count(*) AS n FROM node_occ GROUP BY id HAVING count(DISTINCT type) > 1")
query("dup_exact", lambda n, e: resolve.exact_duplicates(n), f"SELECT type, {NORM} AS norm, string_agg(DISTINCT id, ',' ORDER BY id) AS ids, count(DISTINCT id) AS n_ids FROM node_occ GROUP BY type, norm HAVING count(DISTINCT id) > 1")
query("dup_near", lambda n, e: resolve.near_duplicates(n), f"""WITH a AS MATERIALIZED (SELECT DISTINCT type, id, {NORM} AS norm FROM node_occ), s AS (SELECT type, id, norm, substr(norm, 1, k) AS start FROM a, range(1, 200) r(k) WHERE k < length(norm))
SELECT x.type, x.id AS id_a, s.id AS id_b, x.norm AS norm_a, s.norm AS norm_b, 'prefix' AS reason FROM a x JOIN s ON s.type = x.type AND s.start = x.norm AND s.id <> x.id""")
query("merge_decisions", lambda n, e: resolve.merge_decisions(n), RESOLVED + "SELECT type, norm, ids, CASE WHEN n_top = 1 AND groups = 1 THEN top END AS canonical_id, CASE WHEN n_top = 1 AND groups = 1 THEN 'auto' ELSE 'review' END AS decision, CASE WHEN groups > 1 THEN 'id in several groups' WHEN n_top > 1 THEN 'tie' END AS reason FROM dec")
query("merge_map", lambda n, e: resolve.merge_map(n), RESOLVED + "SELECT loser, canonical_id FROM mrg")
query("split_map", lambda n, e: resolve.split_map(n), RESOLVED + "SELECT id, type, new_id, n FROM spl")
query("resolved_nodes", lambda n, e: resolve.resolved_nodes(n), RESOLVED + "SELECT * FROM res")
query("resolved_node_counts", lambda n, e: resolve.resolved_nodes(n, chunks=False).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("n_provenances").alias("n_provenances")), RESOLVED + "SELECT type, count(*) AS n, CAST(sum(n_provenances) AS BIGINT) AS n_provenances FROM res GROUP BY type")
query("resolved_edges", resolve.resolved_edges, RESOLVED + "SELECT concat_ws('|', source, type, target, role) AS edge_key, * FROM edg")
query("resolver_stats", lambda n, e: resolve.resolver_stats(resolve.resolved_nodes(n, chunks=False)), RESOLVED + ", s AS (SELECT list_sort(list(n_provenances)) AS v, count(*) AS n FROM res) SELECT v[CAST(floor(n / 2) AS BIGINT) + 1] AS median, v[CAST(least(floor(n * 95 / 100), n - 1) AS BIGINT) + 1] AS p95, v[n] AS max, n FROM s")
_TYPED = """WITH loc AS MATERIALIZED (SELECT chunk_id, id, arg_min(type, (pos, type)) AS t FROM node_occ GROUP BY chunk_id, id),
typ AS MATERIALIZED (SELECT e.*, a.t AS source_type, b.t AS target_type FROM edge_occ e LEFT JOIN loc a ON a.chunk_id = e.chunk_id AND a.id = e.source_id LEFT JOIN loc b ON b.chunk_id = e.chunk_id AND b.id = e.target_id) """
query("orphan_edges", resolve.orphan_edges, _TYPED + "SELECT chunk_id, source_id, target_id, type, CASE WHEN source_type IS NULL THEN 'source' ELSE 'target' END AS missing FROM typ WHERE source_type IS NULL OR target_type IS NULL")
query("proposals", lambda n, e: resolve.proposals(n), RESOLVED + "SELECT 'embodies' AS kind, max(new_id) FILTER (type <> 'Theme') AS source_id, max(new_id) FILTER (type = 'Theme') AS target_id, 0.5::DOUBLE AS confidence FROM spl GROUP BY id HAVING count(*) FILTER (type = 'Theme') > 0 AND count(*) FILTER (type <> 'Theme') > 0")
query("evidence_sample", lambda n, e: resolve.evidence(n), "WITH a AS (SELECT id, chunk_id, max(confidence) AS c FROM node_occ WHERE type = 'Theme' GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, chunk_id) AS place FROM a) SELECT id, chunk_id, round(c, 6) AS confidence, CAST(place AS INTEGER) AS place FROM b WHERE place <= 3")
query("provenance_dedup", lambda n, e: resolve.distinct_provenances(n), "SELECT id, type, count(*) AS n_all, count(DISTINCT (chunk_id, confidence)) AS n_distinct FROM node_occ GROUP BY id, type")
query("flat_views", lambda n, e: resolve.flat_provenances(n), "SELECT type || ':' || id || '__' || CAST(row_number() OVER (PARTITION BY type, id ORDER BY pos, confidence) - 1 AS VARCHAR) AS prov_id, id, chunk_id, round(confidence, 6) AS confidence FROM node_occ")


def _compatible_sql(kind: str, source: str, target: str) -> str:
    within = lambda c, values: f"coalesce({c} IN ({', '.join(repr(v) for v in values)}), false)" if values else "true"
    return "CASE " + " ".join(f"WHEN {kind} = '{k}' THEN {within(source, s)} AND {within(target, t)}" for k, (s, t) in EDGE_RULES.items()) + " ELSE false END"


_ROLE = "CASE WHEN type = 'INVOLVES' THEN coalesce(role IN ('protagonist', 'participant', 'mentioned'), false) ELSE role IS NULL END"
_REASON = f"CASE WHEN source_type IS NULL OR target_type IS NULL THEN 'endpoint not local' WHEN NOT ({_compatible_sql('type', 'source_type', 'target_type')}) THEN 'incompatible types' WHEN NOT ({_ROLE}) THEN 'invalid role' END"

query("edge_compat", validate.checked_edges, _TYPED + f"SELECT type, {_REASON} AS reason, count(*) AS n FROM typ GROUP BY ALL")
query("invalid_edges", validate.invalid_edges, _TYPED + f"SELECT chunk_id, source_id, target_id, type, role, {_REASON} AS reason FROM typ WHERE ({_REASON}) IS NOT NULL")
query("role_valid", lambda n, e: e.groupBy("type", "role", validate.role_valid(F.col("type"), F.col("role")).alias("valid")).agg(F.count(F.lit(1)).alias("n")), f"SELECT type, role, {_ROLE} AS valid, count(*) AS n FROM edge_occ GROUP BY ALL")
query("referential_integrity", lambda n, e: (lambda k: validate.dangling(resolve.resolved_nodes(n, k, chunks=False), resolve.resolved_edges(n, e, k).unionByName(e.select(F.concat(F.lit("x_"), "source_id").alias("source"), F.col("target_id").alias("target"), "type").filter("type = 'OCCURS_IN'"), allowMissingColumns=True)))(resolve.told(n)),
      RESOLVED + ", a AS (SELECT source, target, type FROM edg UNION ALL SELECT 'x_' || source_id, target_id, type FROM edge_occ WHERE type = 'OCCURS_IN'), b AS (SELECT *, unnest([source, target]) AS missing FROM a) SELECT b.* FROM b LEFT JOIN (SELECT DISTINCT id FROM res) k ON k.id = b.missing WHERE k.id IS NULL")
query("name_check", lambda n, e: validate.bad_names(n), "SELECT type, count(*) AS n, count(*) FILTER (coalesce(trim(name), '') = '') AS n_bad FROM node_occ GROUP BY type")
query("embodies", lambda n, e: (lambda k: validate.embody_actions(resolve.proposals(k.names), resolve.resolved_nodes(n, k, chunks=False), resolve.resolved_edges(n, e, k)))(resolve.told(n)),
      RESOLVED + f", p AS (SELECT max(new_id) FILTER (type <> 'Theme') AS source_id, max(new_id) FILTER (type = 'Theme') AS target_id FROM spl GROUP BY id HAVING count(*) = 2), k AS (SELECT id, min(type) AS t FROM res GROUP BY id) SELECT source_id, target_id, a.t AS source_type, b.t AS target_type, CASE WHEN a.t IS NULL OR b.t IS NULL THEN 'dangling' WHEN NOT ({_compatible_sql(chr(39) + 'EMBODIES' + chr(39), 'a.t', 'b.t')}) THEN 'incompatible' WHEN EXISTS (SELECT 1 FROM edg WHERE type = 'EMBODIES' AND source = source_id AND target = target_id) THEN 'duplicate' ELSE 'materialised' END AS action FROM p LEFT JOIN k a ON a.id = source_id LEFT JOIN k b ON b.id = target_id")
query("split_suffix", lambda n, e: resolve.split_map(n).select("new_id", text.without_split(F.col("new_id")).alias("bare"), text.slug(F.col("new_id")).alias("slug")), RESOLVED + "SELECT new_id, id AS bare, trim(regexp_replace(lower(new_id), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM spl")


def resolved(function: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """function gets resolved nodes and edges, written once."""
    def run(n: DataFrame, e: DataFrame) -> DataFrame:
        known = resolve.told(n)
        return function(stage(resolve.resolved_nodes(n, known, chunks=False), "nodes"), stage(resolve.resolved_edges(n, e, known, chunks=False), "edges"))

    return run


_PAIRS = RESOLVED + ", par AS (SELECT DISTINCT least(source, target) AS a, greatest(source, target) AS b FROM edg), deg AS (SELECT r.id, r.type, coalesce(d, 0) AS degree FROM res r LEFT JOIN (SELECT id, count(*) AS d FROM (SELECT unnest([a, b]) AS id FROM par) GROUP BY id) USING (id)) "
query("degree_stats", resolved(graph.degree_stats), _PAIRS + "SELECT type, count(*) AS n, min(degree) AS least, max(degree) AS most, round(quantile_cont(degree, 0.5), 4) AS median, round(quantile_cont(degree, 0.9), 4) AS p90, round(quantile_cont(degree, 0.99), 4) AS p99, count(*) FILTER (degree <= 1) AS n_leaves FROM deg GROUP BY type")
query("hubs", resolved(graph.hubs), _PAIRS + "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY degree DESC, id) AS INTEGER) AS place FROM deg) WHERE place <= 10")
# one part of the graph is reached from its node of the highest degree, the small parts that are left pair by pair
query("components", resolved(graph.component_sizes), _PAIRS.replace("WITH per_name", "WITH RECURSIVE per_name", 1) + """, sym AS MATERIALIZED (SELECT a AS x, b AS y FROM par WHERE a <> b UNION SELECT b, a FROM par WHERE a <> b),
big AS (SELECT x AS node FROM (SELECT x FROM sym GROUP BY x ORDER BY count(*) DESC, x LIMIT 1) UNION SELECT y FROM big JOIN sym ON x = node),
rst AS MATERIALIZED (SELECT * FROM sym WHERE x NOT IN (SELECT node FROM big)), rch AS (SELECT x AS node, x AS seen FROM rst UNION SELECT node, y FROM rch JOIN rst ON x = seen),
cmp AS (SELECT node, min(seen) AS root FROM rch GROUP BY node UNION ALL SELECT node, (SELECT min(node) FROM big) FROM big), siz AS (SELECT coalesce(root, id) AS root, count(*) AS size FROM (SELECT DISTINCT id FROM res) LEFT JOIN cmp ON node = id GROUP BY 1)
SELECT size, count(*) AS n FROM siz GROUP BY size""")
query("one_hop", resolved(lambda n, e: graph.one_hop(n.filter("type = 'Phase'"), e)), RESOLVED + ", s AS (SELECT id FROM res WHERE type = 'Phase') SELECT DISTINCT * FROM (SELECT source, target, type, role, false AS reversed FROM edg UNION ALL SELECT target, source, type, role, true FROM edg) WHERE source IN (SELECT id FROM s)")
query("node_trim", resolved(lambda n, e: graph.trimmed(n.filter("type = 'Phase'"), graph.one_hop(n.filter("type = 'Phase'"), e).select(F.col("target").alias("id")), n, 40)),
      RESOLVED + ", s AS (SELECT id FROM res WHERE type = 'Phase'), h AS (SELECT target AS id FROM edg WHERE source IN (SELECT id FROM s) UNION SELECT source FROM edg WHERE target IN (SELECT id FROM s)), a AS (SELECT id, min(ring) AS ring FROM (SELECT id, 0 AS ring FROM s UNION ALL SELECT id, 1 FROM h) GROUP BY id), k AS (SELECT id, min(type) AS type, sum(n_provenances) AS n FROM res GROUP BY id) SELECT id, type, ring FROM a JOIN k USING (id) ORDER BY ring, n >= 20, CASE type WHEN 'Event' THEN 0 WHEN 'Person' THEN 1 WHEN 'Place' THEN 2 WHEN 'Phase' THEN 3 WHEN 'Era' THEN 4 WHEN 'Theme' THEN 5 WHEN 'Reflection' THEN 6 WHEN 'Work' THEN 7 ELSE 9 END, id LIMIT 40")
query("caps_intermediates", lambda n, e: graph.caps(e.filter("type IN ('FOLLOWS', 'CAUSED')").select(F.col("source_id").alias("source"), F.col("target_id").alias("target"))), "WITH f AS (SELECT source_id AS s, target_id AS t FROM edge_occ WHERE type IN ('FOLLOWS', 'CAUSED')), u AS (SELECT s AS id, 1 AS a, 0 AS b FROM f UNION ALL SELECT t, 0, 1 FROM f) SELECT id, CASE WHEN max(a) = 0 THEN 'cap' WHEN max(b) = 1 THEN 'intermediate' ELSE 'leaf' END AS part, CAST(sum(b) AS BIGINT) AS n_under FROM u GROUP BY id")


def _rings(e: DataFrame) -> DataFrame:
    """Phases and eras that lead to each other: the edges back to one phase make rings."""
    moves = e.filter("type = 'OCCURS_IN'").groupBy("source_id", "target_id").agg(F.round(F.max("confidence"), 6).alias("confidence"), F.min("pos").alias("pos"))
    back = moves.select(F.col("target_id").alias("source"), F.col("source_id").alias("target"), F.round(F.col("confidence") - 0.1, 6).alias("confidence"), (F.col("pos") + 1).alias("pos"))
    both = moves.select(F.col("source_id").alias("source"), F.col("target_id").alias("target"), "confidence", "pos").unionByName(back.filter("target = 'ph_1'"))
    return both


_RINGS = """e AS (SELECT source_id AS s, target_id AS t FROM edge_occ WHERE type = 'OCCURS_IN' GROUP BY ALL UNION SELECT target_id, source_id FROM edge_occ WHERE type = 'OCCURS_IN' AND source_id = 'ph_1' GROUP BY ALL),
r AS (SELECT s AS a, t AS b FROM e UNION SELECT r.a, e.t FROM r JOIN e ON e.s = r.b), c AS (SELECT a FROM r WHERE a = b), h AS (SELECT b AS x FROM r WHERE a IN (SELECT a FROM c))"""
query("acyclic_check", lambda n, e: graph.peel(_rings(e).select("source", "target")).agg(F.count(F.lit(1)).alias("n_left")), f"WITH RECURSIVE {_RINGS} SELECT count(*) AS n_left FROM e WHERE s IN (SELECT x FROM h)")
query("cycle_break", lambda n, e: graph.break_cycles(_rings(e))[1].select("source", "target", "confidence"), None)
query("reciprocal", lambda n, e: graph.reciprocal(e.filter("type = 'OCCURS_IN'").select(F.col("source_id").alias("source"), F.col("target_id").alias("target"), "type").unionByName(e.filter("type = 'OCCURS_IN' AND source_id < 'ph_3'").select(F.col("target_id").alias("source"), F.col("source_id").alias("target"), "type")), "OCCURS_IN"), "WITH o AS (SELECT DISTINCT source_id, target_id FROM edge_occ WHERE type = 'OCCURS_IN' AND source_id < 'ph_3') SELECT least(source_id, target_id) AS source, greatest(source_id, target_id) AS target FROM o")
query("type_counts", lambda n, e: metrics.type_counts(n), "WITH t AS (SELECT unnest(['Person', 'Event', 'Place', 'Phase', 'Theme', 'Reflection', 'Work', 'Era']) AS type), c AS (SELECT type, count(DISTINCT id) AS n FROM node_occ GROUP BY type) SELECT type, coalesce(n, 0) AS n, true AS in_schema FROM t LEFT JOIN c USING (type)")
query("confidence_stats", lambda n, e: metrics.confidence_stats(n), "SELECT type, count(*) AS n, round(avg(confidence), 6) AS mean, min(confidence) AS least, max(confidence) AS most, round(quantile_cont(confidence, 0.1), 6) AS p10, round(quantile_cont(confidence, 0.25), 6) AS p25, round(quantile_cont(confidence, 0.5), 6) AS median, round(quantile_cont(confidence, 0.75), 6) AS p75, round(quantile_cont(confidence, 0.9), 6) AS p90, count(*) FILTER (confidence < 0.5::DOUBLE) AS below_50, count(*) FILTER (confidence < 0.7::DOUBLE) AS below_70, count(*) FILTER (confidence < 0.9::DOUBLE) AS below_90 FROM node_occ GROUP BY type")
_EVENTS = "kin AS (SELECT id, min(type) AS t FROM node_occ GROUP BY id), evq AS (SELECT source_id AS id, bool_or(type = 'LOCATED_AT') AS place, bool_or(type = 'DURING') AS time, bool_or(type = 'DURING' AND t = 'Era') AS era, bool_or(type = 'INVOLVES') AS person, bool_or(type = 'EMBODIES' AND t = 'Theme') AS theme FROM edge_occ LEFT JOIN kin ON kin.id = target_id GROUP BY source_id), evs AS (SELECT DISTINCT id FROM node_occ WHERE type = 'Event'), evr AS (SELECT count(*) AS n_events, " + ", ".join(f"round(100 * (count(*) FILTER (coalesce({c}, false)))::DOUBLE / count(*), 2) AS pct_{c}" for c in ("place", "time", "era", "person", "theme")) + " FROM evs LEFT JOIN evq USING (id))"
query("event_quality", metrics.event_quality, f"WITH {_EVENTS} SELECT * FROM evr")
_PHASES = "pha AS (SELECT p.id, coalesce(n_events, 0) AS n_events, coalesce(n_eras, 0) > 0 AS anchored FROM (SELECT DISTINCT id FROM node_occ WHERE type = 'Phase') p LEFT JOIN (SELECT target_id AS id, count(DISTINCT source_id) AS n_events FROM edge_occ WHERE type = 'DURING' GROUP BY 1) USING (id) LEFT JOIN (SELECT source_id AS id, count(DISTINCT target_id) AS n_eras FROM edge_occ WHERE type = 'OCCURS_IN' GROUP BY 1) USING (id))"
query("temporal_backbone", metrics.temporal_backbone, f"WITH {_PHASES} SELECT * FROM pha")
_ROLES = "rol AS (SELECT count(*) AS n, " + ", ".join(f"round(100 * (count(*) FILTER (role = '{r}'))::DOUBLE / count(*), 2) AS pct_{r}" for r in ("protagonist", "participant", "mentioned")) + " FROM edge_occ WHERE type = 'INVOLVES')"
query("involves_roles", lambda n, e: metrics.involves_roles(e), f"WITH {_ROLES} SELECT * FROM rol")
_NARRATIVE = "nar AS (SELECT count(*) FILTER (type = 'CAUSED') AS n_caused, count(*) FILTER (type = 'FOLLOWS') AS n_follows, count(*) FILTER (type = 'ECHOES') AS n_echoes FROM edge_occ), nrr AS (SELECT *, CASE WHEN n_follows = 0 THEN 'inf'::DOUBLE ELSE round(n_caused::DOUBLE / n_follows, 6) END AS ratio FROM nar)"
query("narrative_ratio", lambda n, e: metrics.narrative(e), f"WITH {_NARRATIVE} SELECT * FROM nrr")
query("theme_rank", lambda n, e: metrics.theme_rank(e), "SELECT target_id AS id, count(*) AS n_in, count(DISTINCT source_id) AS n_sources FROM edge_occ WHERE type = 'EMBODIES' GROUP BY 1 ORDER BY n_in DESC, id LIMIT 20")
query("reflection_dist", lambda n, e: metrics.per_chunk(n, "Theme"), "WITH c AS (SELECT chunk_id, count(*) FILTER (type = 'Theme') AS n_nodes FROM node_occ GROUP BY 1) SELECT n_nodes, count(*) AS n_chunks FROM c GROUP BY 1")
query("person_duplicates", lambda n, e: metrics.person_duplicates(n, text.name_norm(F.col("name"))), f"WITH a AS (SELECT DISTINCT id, {NORM} AS norm FROM node_occ WHERE type = 'Person') SELECT norm, count(*) AS n, min(id) AS first FROM a GROUP BY norm HAVING count(*) > 1")
query("phase_pairs", lambda n, e: metrics.phase_order(n, e, text.ordinal(F.col("chunk_id"))), "WITH era AS (SELECT source_id AS id, arg_max(target_id, pos) AS era FROM edge_occ WHERE type = 'OCCURS_IN' GROUP BY 1), m AS (SELECT id, round(avg(CAST(regexp_extract(chunk_id, '([0-9]+)', 1) AS BIGINT)), 4) AS mean FROM node_occ WHERE type = 'Phase' GROUP BY 1) SELECT id, mean, era, CAST(row_number() OVER w AS INTEGER) AS place, lead(id) OVER w AS next_id FROM m JOIN era USING (id) WINDOW w AS (PARTITION BY era ORDER BY mean, id)")
_CHECKS = f"WITH {_EVENTS}, {_PHASES}, {_ROLES}, {_NARRATIVE}, one AS (SELECT evr.*, nrr.ratio, (SELECT round(100 * (count(*) FILTER (anchored))::DOUBLE / count(*), 2) FROM pha) AS pct_anchored, (SELECT round((count(DISTINCT id) FILTER (type = 'Theme'))::DOUBLE / count(DISTINCT chunk_id), 6) FROM node_occ) AS themes_per_chunk, (SELECT count(DISTINCT chunk_id) FROM node_occ) AS n_chunks, (SELECT max(c)::DOUBLE FROM (SELECT count(*) AS c FROM edge_occ WHERE type = 'EMBODIES' GROUP BY target_id)) AS top_theme, (SELECT pct_protagonist FROM rol) AS pct_protagonist FROM evr, nrr), chk AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"check\", {m}::DOUBLE AS value, CASE WHEN {m} IS NULL THEN 'n/a' WHEN {m} {'<' if more else '>'} {s} THEN 'stop' WHEN {m} {'>=' if more else '<='} {g} THEN 'pass' ELSE 'fail' END AS status FROM one" for c, m, g, s, more in metrics.THRESHOLDS
) + " UNION ALL SELECT 'pct_protagonist_on_involves', pct_protagonist, CASE WHEN pct_protagonist IS NULL THEN 'n/a' WHEN pct_protagonist > 85 OR pct_protagonist < 25 THEN 'stop' WHEN pct_protagonist BETWEEN 40 AND 65 THEN 'pass' ELSE 'fail' END FROM one UNION ALL SELECT 'graph_loaded', n_chunks::DOUBLE, CASE WHEN n_chunks > 0 THEN 'pass' ELSE 'stop' END FROM one) "
query("stage_checks", metrics.checks, _CHECKS + "SELECT * FROM chk")
query("verdict_table", lambda n, e: metrics.verdict(metrics.checks(n, e)), _CHECKS + "SELECT count(*) FILTER (status = 'stop') AS n_stop, count(*) FILTER (status = 'pass') AS n_pass, count(*) FILTER (status = 'fail') AS n_fail, CASE WHEN count(*) FILTER (status = 'stop') >= 3 THEN 'stop' WHEN count(*) FILTER (status = 'pass') >= 6 AND count(*) FILTER (status = 'stop') = 0 THEN 'ok' ELSE 'mixed' END AS verdict FROM chk")
