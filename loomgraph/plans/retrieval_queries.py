"""Queries over themes, retrieval and documents, with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.staging import stage
from ..operators import cluster, graph, hierarchy, resolve, retrieve, similar
from ..sources import documents
from ..sources.adapter import edges, nodes, with_occurrences
from .graph_queries import RESOLVED
from .text_queries import _PAIRS, _V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def query(name: str, function: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    QUERIES[name] = function
    if sql:
        ORACLES[name] = sql


def _judgments(e: DataFrame) -> DataFrame:
    """Stands in for a judge: near pairs of like labels are the same, other near pairs refinements. Written once, as the
    pairs of all vectors are costly and most callers read them more than once."""
    pairs = similar.cosine_pairs(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 8, 0.3)
    label = e.select("vec_id", "label")
    both = pairs.join(label.select(F.col("vec_id").alias("id_a"), F.col("label").alias("la")), "id_a").join(label.select(F.col("vec_id").alias("id_b"), F.col("label").alias("lb")), "id_b")
    verdict = F.when((F.col("id_a") + F.col("id_b")) % 2 == 0, "same").when(F.col("la") == F.col("lb"), "refinement").otherwise("distinct")
    return stage(both.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), verdict.alias("verdict"), F.round(F.col("cosine") + 0.65, 6).alias("confidence")), "judgments")


_JUDGED = _PAIRS + ", jud AS (SELECT id_a AS a, id_b AS b, CASE WHEN (id_a + id_b) % 2 = 0 THEN 'same' WHEN x.label = y.label THEN 'refinement' ELSE 'distinct' END AS verdict, round(cosine + 0.65::DOUBLE, 6) AS confidence FROM cos JOIN vec x ON x.id = id_a JOIN vec y ON y.id = id_b)"
query("judgments", lambda s, d: _judgments(_read(s, d, "embeddings")).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean")), f"WITH {_JUDGED} SELECT verdict, count(*) AS n, round(avg(confidence), 6) AS mean FROM jud GROUP BY verdict")
query("theme_components", lambda s, d: graph.same_clusters(_judgments(_read(s, d, "embeddings")), _read(s, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 17).alias("freq"))),
      f"WITH RECURSIVE {_JUDGED}, sm AS (SELECT a, b FROM jud WHERE verdict = 'same' UNION SELECT b, a FROM jud WHERE verdict = 'same'), r AS (SELECT a AS node, a AS seen FROM sm UNION SELECT r.node, sm.b FROM r JOIN sm ON sm.a = r.seen), c AS (SELECT node, min(seen) AS root FROM r GROUP BY node), i AS (SELECT p.root, min(confidence) FILTER (verdict = 'same') AS confidence, max(CASE WHEN verdict = 'refinement' THEN 1 ELSE 0 END) AS conflict FROM jud JOIN c p ON p.node = a JOIN c q ON q.node = b AND q.root = p.root GROUP BY p.root), m AS (SELECT root, string_agg(CAST(node AS VARCHAR), ',' ORDER BY node) AS members, count(*) AS n, arg_min(node, (-(node % 17), node)) AS canonical_id FROM c GROUP BY root) SELECT canonical_id, members, round(confidence, 6) AS confidence, CASE WHEN conflict = 1 THEN 'conflict' WHEN confidence >= 0.97::DOUBLE THEN 'applied' ELSE 'review' END AS status FROM m JOIN i USING (root) WHERE n > 1")
query("orphan_shortlist", lambda s, d: retrieve.shortlist(_read(s, d, "embeddings").filter("vec_id % 10 <> 0").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), _read(s, d, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))),
      f"WITH {_V}, s AS (SELECT o.id AS orphan, h.id AS h, list_inner_product(h.v, o.v) AS s FROM vec o, vec h WHERE o.id % 10 <> 0 AND h.id % 50 = 0), k AS (SELECT *, row_number() OVER (PARTITION BY orphan ORDER BY s DESC, h) AS p FROM s) SELECT orphan, string_agg(CAST(h AS VARCHAR), ',' ORDER BY p) AS heads, round(max(s), 6) AS top_score FROM k WHERE p <= 5 GROUP BY orphan")
query("free_slugs", lambda s, d: retrieve.free_slugs(_read(s, d, "part").select(F.col("p_partkey").alias("id"), t.slug(F.col("p_name")).alias("slug"))), "WITH a AS (SELECT p_partkey AS id, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part), b AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY id) AS n FROM a) SELECT id, CASE WHEN n = 1 THEN slug ELSE slug || '_' || CAST(n AS VARCHAR) END AS slug FROM b")


def _found(s: SparkSession, d: str) -> DataFrame:
    """The eight nearest chunks of five questions; a vector stands for the order of the next number."""
    v = _read(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    top = similar.top_k(v.filter("id < 5").select(F.col("id").alias("q_id"), F.col("v").alias("q")), v, 8)
    return top.withColumn("chunk_id", F.concat(F.lit("ch_"), F.lpad((F.col("id") + 1).cast("string"), 12, "0")))


_FOUND = f"{_V}, sco AS (SELECT q.id AS q_id, c.id, list_inner_product(q.v, c.v) AS score FROM vec q, vec c WHERE q.id < 5), top AS (SELECT *, 'ch_' || lpad(CAST(id + 1 AS VARCHAR), 12, '0') AS chunk_id, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, id) AS INTEGER) AS place FROM sco QUALIFY place <= 8), rkd AS (SELECT q_id, id AS node, max(score) AS score, count(DISTINCT chunk_id) AS n_chunks FROM top JOIN (SELECT DISTINCT chunk_id, id AS node FROM node_occ) o USING (chunk_id) GROUP BY ALL)".replace("SELECT q_id, id AS node, max", "SELECT q_id, node, max")
query("ranked_nodes", lambda s, d: similar.ranked_nodes(_found(s, d), nodes(s, d)), with_occurrences(f"WITH {_FOUND} SELECT * FROM rkd"))
_ASKED = "Who made the France things of priority urgent in Germany, and Brand#11 with Standard tin?"
_STOP = ["the", "and", "who", "with"]


def _central(s: SparkSession, d: str) -> DataFrame:
    found = _found(s, d)
    kinds = nodes(s, d).groupBy("id").agg(F.min_by("name", "pos").alias("name"), F.min("type").alias("type")).withColumnRenamed("id", "node")
    asked = found.select("q_id").distinct().withColumn("text", F.lit(_ASKED))
    return retrieve.central_nodes(asked, similar.ranked_nodes(found, nodes(s, d)).join(kinds, "node"), _STOP)


_WORDS = "', '".join(sorted({w for w in "made france things priority urgent germany brand 11 standard tin".split() if len(w) >= 3}))
query("central_node", _central, with_occurrences(f"WITH {_FOUND}, kin AS (SELECT id AS node, arg_min(name, pos) AS name, min(type) AS type FROM node_occ GROUP BY id), wrd AS (SELECT unnest(['{_WORDS}']) AS w), mat AS (SELECT q_id, node, score, type, CASE WHEN lower(node) = w OR starts_with(lower(node), w || '__') THEN 1000 WHEN ends_with(lower(node), '_' || w) THEN 900 WHEN contains('_' || lower(node) || '_', '_' || w || '_') THEN 700 - length(node) * 0.01::DOUBLE WHEN list_contains(string_split_regex(lower(name), '[^a-z0-9_]+'), w) THEN 600 WHEN contains(lower(name), w) THEN 400 END AS m FROM rkd JOIN kin USING (node), wrd), tot AS (SELECT q_id, node, score, m + CASE WHEN type = 'Place' THEN 50 ELSE 0 END + score AS total FROM mat) SELECT q_id, node, round(total, 6) AS total FROM tot QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY total DESC NULLS LAST, score DESC, node) = 1"))
query("primary_node", lambda s, d: retrieve.primary_nodes(nodes(s, d)), with_occurrences("WITH n AS (SELECT id, count(*) AS n FROM node_occ GROUP BY id) SELECT chunk_id, arg_min(id, (CASE WHEN n >= 20 THEN 1 ELSE 0 END, CASE type WHEN 'Event' THEN 0 WHEN 'Person' THEN 1 WHEN 'Place' THEN 2 WHEN 'Phase' THEN 3 WHEN 'Era' THEN 4 WHEN 'Theme' THEN 5 WHEN 'Reflection' THEN 6 WHEN 'Work' THEN 7 ELSE 9 END, id)) AS id FROM node_occ JOIN n USING (id) GROUP BY chunk_id"))
query("context_text", lambda s, d: retrieve.contexts(_found(s, d), _read(s, d, "documents").select(F.col("doc_id").alias("id"), "text")), with_occurrences(f"WITH {_FOUND} SELECT q_id, string_agg('[' || CAST(id AS VARCHAR) || '] ' || substr(regexp_replace(text, '\\s+', ' ', 'g'), 1, 200), chr(10) ORDER BY place) AS context FROM top JOIN documents ON doc_id = id GROUP BY q_id"))
query("node_coverage", lambda s, d: retrieve.coverage(_read(s, d, "embeddings").select(F.concat(F.lit("ch_"), F.lpad((F.col("vec_id") * 3 - 30).cast("string"), 12, "0")).alias("chunk_id")), nodes(s, d)),
      with_occurrences("WITH idx AS (SELECT DISTINCT 'ch_' || lpad(CAST(vec_id * 3 - 30 AS VARCHAR), 12, '0') AS chunk_id FROM embeddings), c AS (SELECT DISTINCT chunk_id FROM node_occ), a AS (SELECT (SELECT count(*) FROM c WHERE chunk_id NOT IN (SELECT chunk_id FROM idx)) AS n_missing, (SELECT count(*) FROM idx WHERE chunk_id NOT IN (SELECT chunk_id FROM c)) AS n_extra, (SELECT count(*) FROM idx WHERE chunk_id IN (SELECT chunk_id FROM c)) AS n_both, (SELECT count(DISTINCT id) FROM node_occ) AS n_nodes, (SELECT count(DISTINCT id) FROM node_occ WHERE chunk_id IN (SELECT chunk_id FROM idx)) AS n_covered) SELECT *, round(100 * n_covered::DOUBLE / n_nodes, 2) AS pct_covered FROM a"))
query("grounding_chunk", lambda s, d: retrieve.grounding(edges(s, d).select(F.col("source_id").alias("source"), F.col("target_id").alias("target")), nodes(s, d)), with_occurrences("""
WITH w AS MATERIALIZED (SELECT DISTINCT source_id AS source, target_id AS target FROM edge_occ), o AS MATERIALIZED (SELECT DISTINCT id, chunk_id FROM node_occ), s AS (SELECT source, target, min(a.chunk_id) AS shared FROM w JOIN o a ON a.id = source JOIN o b ON b.id = target AND b.chunk_id = a.chunk_id GROUP BY ALL),
l AS (SELECT id, min(chunk_id) AS c FROM o GROUP BY id) SELECT source, target, coalesce(shared, x.c, y.c, 'UNKNOWN') AS chunk_id, shared IS NOT NULL AS together FROM w LEFT JOIN s USING (source, target) LEFT JOIN l x ON x.id = source LEFT JOIN l y ON y.id = target"""))


def _gaps(s: SparkSession, d: str) -> DataFrame:
    """Every theme with every place."""
    n = nodes(s, d)
    places = n.filter("type IN ('Place', 'Theme')").select("id", t.ordinal(F.col("chunk_id")).alias("ord")).distinct()
    themes = n.filter("type = 'Theme' AND id LIKE 'th_%'").select(F.col("id").alias("a")).distinct()
    return retrieve.least_gaps(themes.crossJoin(n.filter("type = 'Place'").select(F.col("id").alias("b")).distinct()), places)


query("chunk_gap", _gaps, with_occurrences("""
WITH p AS MATERIALIZED (SELECT DISTINCT id, type, CAST(regexp_extract(chunk_id, '([0-9]+)', 1) AS BIGINT) AS ord FROM node_occ WHERE type IN ('Place', 'Theme')), b AS (SELECT id, ord FROM p WHERE type = 'Place'),
x AS MATERIALIZED (SELECT a.id AS a, k.id AS b, a.ord FROM p a, (SELECT DISTINCT id FROM b) k WHERE a.type = 'Theme' AND a.id LIKE 'th_%'), g AS (SELECT x.a, x.b, x.ord - b.ord AS gap FROM x ASOF JOIN b ON x.b = b.id AND x.ord >= b.ord UNION ALL SELECT x.a, x.b, b.ord - x.ord FROM x ASOF JOIN b ON x.b = b.id AND x.ord <= b.ord)
SELECT a, b, min(gap) AS gap FROM g GROUP BY ALL"""))
query("gold_compare", lambda s, d: retrieve.compared(nodes(s, d).filter("pos % 3 <> 0"), nodes(s, d).filter("confidence > 0.7")), with_occurrences("WITH g AS (SELECT DISTINCT id, type, 1 AS g FROM node_occ WHERE pos % 3 <> 0), m AS (SELECT DISTINCT id, type, 1 AS m FROM node_occ WHERE confidence > 0.7::DOUBLE) SELECT type, count(*) FILTER (g = 1 AND m = 1) AS n_both, count(*) FILTER (m IS NULL) AS n_gold, count(*) FILTER (g IS NULL) AS n_model FROM g FULL JOIN m USING (id, type) GROUP BY type"))


def _round_trip(s: SparkSession, d: str) -> DataFrame:
    """Occurrences through nested documents and JSON text and back: what is lost or new."""
    n, e = nodes(s, d), edges(s, d)
    exact = F.sum(F.col("confidence").cast("decimal(20,12)"))  # a sum of doubles depends on the order of the rows
    told = documents.extractions(n, e).select(F.to_json(F.struct("chunk_id", "nodes", "edges")).alias("j")).select(F.from_json("j", documents.EXTRACTION).alias("x")).select("x.*")
    back = documents.edge_occurrences(told).groupBy("type").agg(F.count(F.lit(1)).alias("n_back"), exact.alias("c_back"))
    there = e.groupBy("type").agg(F.count(F.lit(1)).alias("n"), exact.alias("c"))
    return there.join(back, "type", "full").select("type", "n", (F.col("n") == F.col("n_back")).alias("same_count"), (F.col("c") == F.col("c_back")).alias("same_sum"))


query("export_round_trip", _round_trip, with_occurrences("SELECT type, count(*) AS n, true AS same_count, true AS same_sum FROM edge_occ GROUP BY type"))
query("upsert_latest", lambda s, d: documents.latest(nodes(s, d).select("id", "name", "type", "confidence", "pos", "chunk_id").withColumn("o", F.struct("pos", "type", "confidence")), ["id"], "o").select("id", "name", "type", "pos", F.round("confidence", 6).alias("confidence")), with_occurrences("SELECT id, arg_max(name, (pos, type, confidence)) AS name, arg_max(type, (pos, type, confidence)) AS type, max(pos) AS pos, round(arg_max(confidence, (pos, type, confidence)), 6) AS confidence FROM node_occ GROUP BY id"))
query("run_totals", lambda s, d: nodes(s, d).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n").alias("n_nodes"), F.max("n").alias("most"), F.round(F.avg("n"), 6).alias("mean")), with_occurrences("WITH c AS (SELECT chunk_id, count(*) AS n FROM node_occ GROUP BY 1) SELECT count(*) AS n_chunks, CAST(sum(n) AS BIGINT) AS n_nodes, max(n) AS most, round(avg(n), 6) AS mean FROM c"))
query("unique_triples", lambda s, d: edges(s, d).select("source_id", "target_id", "type").distinct().groupBy("type").agg(F.count(F.lit(1)).alias("n")), with_occurrences("SELECT type, count(DISTINCT (source_id, target_id)) AS n FROM edge_occ GROUP BY type"))
query("review_queue", lambda s, d: resolve.resolved_nodes(nodes(s, d), chunks=False).filter("n_provenances >= 20 OR n_names > 1").select("id", "type", F.when(F.col("n_names") > 1, 1).otherwise(2).alias("priority"), "n_provenances"), with_occurrences(RESOLVED + "SELECT id, type, CASE WHEN n_names > 1 THEN 1 ELSE 2 END AS priority, n_provenances FROM res WHERE n_provenances >= 20 OR n_names > 1"))
query("average_linkage", lambda s, d: cluster.clusters(_read(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")), 0.62), None)
query("echo_candidates", lambda s, d: cluster.echoes(_read(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.col("vec_id").alias("ord")), 0.35), None)


def _raw_hierarchy(j: DataFrame) -> DataFrame:
    """Refinements as seeds, near pairs of even first ids as judgments, both from the general to the special."""
    seed = j.filter("verdict <> 'same'").select(F.col("b").alias("source"), (F.col("a") % 60).alias("target"), "confidence", F.lit("seed").alias("origin"))
    return seed.unionByName(j.filter("a % 2 = 0").select(F.col("b").alias("source"), (F.col("a") % 60).alias("target"), (F.col("confidence") - 0.1).alias("confidence"), F.lit("judgment").alias("origin")))


_HIERARCHY = _JUDGED + ", hrw AS (SELECT b AS source, a % 60 AS target, confidence, 'seed' AS origin FROM jud WHERE verdict <> 'same' UNION ALL SELECT b, a % 60, confidence - 0.1::DOUBLE, 'judgment' FROM jud WHERE a % 2 = 0), hie AS (SELECT source, target, max(confidence) AS confidence, string_agg(DISTINCT origin, '+' ORDER BY origin) AS origins FROM hrw WHERE source <> target GROUP BY ALL)"
query("hierarchy_edges", lambda s, d: hierarchy.united(_raw_hierarchy(_judgments(_read(s, d, "embeddings")))).withColumn("confidence", F.round("confidence", 6)), f"WITH {_HIERARCHY} SELECT source, target, round(confidence, 6) AS confidence, origins FROM hie")
query("hierarchy_build", lambda s, d: hierarchy.built(hierarchy.united(_raw_hierarchy(_judgments(_read(s, d, "embeddings")))), _read(s, d, "embeddings").filter("vec_id % 3 > 0").select(F.col("vec_id").alias("id"))), f"WITH {_HIERARCHY}, h AS (SELECT target AS id, count(*) AS n_under FROM hie GROUP BY 1), k AS (SELECT id, n_under, id IN (SELECT vec_id FROM embeddings WHERE vec_id % 3 > 0) AS there FROM h) SELECT id, n_under, CASE WHEN there THEN 'promoted' ELSE 'made' END AS action, CASE WHEN there THEN 1.0 ELSE 0.7 END::DOUBLE AS confidence, NOT there AS review_needed FROM k")


def _materialised(s: SparkSession, d: str) -> DataFrame:
    j = _judgments(_read(s, d, "embeddings"))
    judged = j.select("a", "b", (F.col("verdict") == "same").alias("verdict"), F.when(F.col("a") % 3 == 0, "ba").otherwise("ab").alias("direction"), (F.col("confidence") - 0.4).alias("confidence"))
    return hierarchy.materialised(judged, _raw_hierarchy(j)).withColumn("confidence", F.round("confidence", 6))


def _unjudged(s: SparkSession, d: str) -> DataFrame:
    """Pairs, and a cache of those of even first ids the other way round."""
    j = _judgments(_read(s, d, "embeddings"))
    return hierarchy.unjudged(j.select("a", "b"), j.filter("a % 2 = 0").select(F.col("b").alias("a"), F.col("a").alias("b"))).select("a", "b")


query("edge_materialise", _materialised,
      f"WITH {_HIERARCHY}, t AS (SELECT CASE WHEN a % 3 = 0 THEN b ELSE a END AS source, CASE WHEN a % 3 = 0 THEN a ELSE b END AS target, verdict = 'same' AS v, confidence - 0.4::DOUBLE AS c FROM jud) SELECT source, target, round(c, 6) AS confidence, CASE WHEN NOT v THEN 'none' WHEN c < 0.6::DOUBLE THEN 'low confidence' WHEN EXISTS (SELECT 1 FROM hrw h WHERE h.source = t.source AND h.target = t.target) THEN 'duplicate' ELSE 'added' END AS action FROM t")
query("partition_once", lambda s, d: hierarchy.placed_once(_read(s, d, "lineitem").select((F.col("l_suppkey") % 40).alias("cluster"), (F.col("l_partkey") % 30).alias("id"), F.when(F.col("l_quantity") > 49, "cap").when(F.col("l_quantity") > 48, "member").otherwise("unattached").alias("part"), F.col("l_orderkey").alias("pos"), (F.col("l_partkey") % 7).alias("cap_id"))),
      "WITH c AS (SELECT l_suppkey % 40 AS cluster, l_partkey % 30 AS id, CASE WHEN l_quantity > 49 THEN 'cap' WHEN l_quantity > 48 THEN 'member' ELSE 'unattached' END AS part, l_orderkey AS pos, l_partkey % 7 AS cap_id FROM lineitem), o AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY cluster, id ORDER BY CASE part WHEN 'cap' THEN 0 WHEN 'member' THEN 1 ELSE 2 END, pos, cap_id) = 1), u AS (SELECT DISTINCT cluster, cap_id AS id FROM o WHERE part = 'member') SELECT cluster, id, CASE WHEN part = 'cap' AND (cluster, id) NOT IN (SELECT (cluster, id) FROM u) THEN 'unattached' ELSE part END AS part, CASE WHEN part = 'member' THEN cap_id END AS cap_id FROM o")
query("unjudged_pairs", _unjudged, f"WITH {_JUDGED} SELECT a, b FROM jud WHERE a % 2 <> 0")
