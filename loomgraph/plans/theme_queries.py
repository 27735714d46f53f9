"""Queries over merges of themes and the building of a hierarchy, with oracle SQL.

Embeddings stand in for themes, a rule on pairs of them for a judge, line items for what a judge said about clusters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph, hierarchy, themes
from .retrieval_queries import _JUDGED, _judgments, _raw_hierarchy, _read
from .retrieval_queries import ORACLES as _KNOWN
from .text_queries import _PAIRS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, function: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    QUERIES[name] = function
    if sql:
        ORACLES[name] = sql


APPLY = 0.955


def _themes(s: SparkSession, d: str) -> DataFrame:
    return _read(s, d, "embeddings").selectExpr(
        "CAST(vec_id AS STRING) AS id", "'theme ' || CAST(vec_id % 90 AS STRING) AS name", "array('t' || CAST(vec_id % 5 AS STRING)) AS aliases",
        "array('ch_' || CAST(vec_id % 40 AS STRING), 'ch_' || CAST(vec_id % 13 AS STRING)) AS chunk_ids", "vec_id % 17 AS freq",
    )


def _edges(s: SparkSession, d: str) -> DataFrame:
    ends = "CAST(vec_id AS STRING) AS source, CAST((vec_id * 7 + {}) % 400 AS STRING) AS target, CASE WHEN vec_id % 3 = 0 THEN 'ECHOES' ELSE 'EMBODIES' END AS type, CASE WHEN vec_id % 4 = 0 THEN 'r' END AS role, vec_id % 11 = 0 AS review_needed"
    e = _read(s, d, "embeddings")
    split = lambda k: e.selectExpr(*[x.strip() for x in ends.format(k).split(", ")])
    return split(3).unionByName(split(4)).unionByName(split(3))


def _clusters(s: SparkSession, d: str, judged: DataFrame | None = None) -> DataFrame:
    freq = _read(s, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 17).alias("freq"))
    return graph.same_clusters(judged or _judgments(_read(s, d, "embeddings")), freq, APPLY)


_CLS = f"cls AS ({_KNOWN['theme_components'].replace('0.97::DOUBLE', f'{APPLY}::DOUBLE')})"
_MAP = f"""{_CLS}, pairs AS (
  SELECT CAST(canonical_id AS VARCHAR) AS canonical_id, unnest(string_split(members, ',')) AS loser FROM cls WHERE status = 'applied'
), mm AS (SELECT loser, canonical_id FROM pairs WHERE loser <> canonical_id)"""
_THEMES = """thm AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, 'theme ' || CAST(vec_id % 90 AS VARCHAR) AS name, 't' || CAST(vec_id % 5 AS VARCHAR) AS alias,
    ['ch_' || CAST(vec_id % 40 AS VARCHAR), 'ch_' || CAST(vec_id % 13 AS VARCHAR)] AS chunk_ids, vec_id % 17 AS freq FROM embeddings
)"""
_EDGES = "edh AS (" + " UNION ALL ".join(
    f"""SELECT CAST(vec_id AS VARCHAR) AS source, CAST((vec_id * 7 + {k}) % 400 AS VARCHAR) AS target, CASE WHEN vec_id % 3 = 0 THEN 'ECHOES' ELSE 'EMBODIES' END AS type,
    CASE WHEN vec_id % 4 = 0 THEN 'r' END AS role, vec_id % 11 = 0 AS review_needed FROM embeddings"""
    for k in (3, 4, 3)
) + ")"

query("theme_merge_map", lambda s, d: themes.canonical_map(_clusters(s, d)), f"WITH {_MAP} SELECT loser, canonical_id FROM mm")
query("theme_merge_nodes", lambda s, d: themes.merged_nodes(_themes(s, d), themes.canonical_map(_clusters(s, d))), f"""
WITH {_MAP}, {_THEMES},
f AS (SELECT t.*, coalesce(canonical_id, id) AS final FROM thm t LEFT JOIN mm ON loser = id),
own AS (SELECT final, max(name) AS name FROM f WHERE id = final GROUP BY final),
told AS (SELECT final, alias AS a FROM f UNION SELECT f.final, f.name FROM f LEFT JOIN own USING (final) WHERE f.name IS DISTINCT FROM own.name),
ali AS (SELECT final, string_agg(a, ',' ORDER BY a) AS aliases FROM told GROUP BY final),
prv AS (SELECT final, count(DISTINCT c) AS n FROM (SELECT final, unnest(chunk_ids) AS c FROM f) GROUP BY final)
SELECT f.final AS id, any_value(own.name) AS name, any_value(ali.aliases) AS aliases,
  CASE WHEN count(*) > 1 THEN string_agg(f.id, ',' ORDER BY f.id) ELSE '' END AS merged_from, CAST(any_value(prv.n) AS INTEGER) AS n_provenances
FROM f LEFT JOIN own USING (final) JOIN ali USING (final) JOIN prv USING (final) GROUP BY f.final""")
query("theme_merge_edges", lambda s, d: themes.merged_edges(_edges(s, d), themes.canonical_map(_clusters(s, d))), f"""
WITH {_MAP}, {_EDGES}, r AS (
  SELECT coalesce(a.canonical_id, source) AS source, coalesce(b.canonical_id, target) AS target, type, role, review_needed
  FROM edh LEFT JOIN mm a ON a.loser = source LEFT JOIN mm b ON b.loser = target
) SELECT source, target, type, role, count(*) AS n, bool_or(review_needed) AS review_needed FROM r WHERE source <> target GROUP BY ALL""")


def _refinements(judged: DataFrame) -> DataFrame:
    """Every judged pair that is not the same refines one way; general_id is the smaller id, every fifth time the larger."""
    j = judged.filter("verdict <> 'same'")
    general = F.when((F.col("a") + F.col("b")) % 5 == 0, F.col("b")).otherwise(F.col("a"))
    special = F.when(general == F.col("a"), F.col("b")).otherwise(F.col("a"))
    return j.select(special.cast("string").alias("specific"), general.cast("string").alias("general"), "confidence", (F.col("a") * 100_000 + F.col("b")).alias("pos"))


_REF = """ref AS (
  SELECT CASE WHEN (a + b) % 5 = 0 THEN a ELSE b END AS sp, CASE WHEN (a + b) % 5 = 0 THEN b ELSE a END AS ge, confidence, a * 100000 + b AS pos
  FROM jud WHERE verdict <> 'same'
)"""


def _remapped(s: SparkSession, d: str) -> DataFrame:
    judged = _judgments(_read(s, d, "embeddings"))
    r = _refinements(judged)
    conflicts = r.filter("CAST(specific AS BIGINT) % 7 = 0").select("specific", "general")
    return themes.remapped_refinements(r, themes.canonical_map(_clusters(s, d, judged)), conflicts)


query("refinement_remap", _remapped, f"""
WITH {_MAP}, {_JUDGED}, {_REF}, m AS (
  SELECT coalesce(x.canonical_id, CAST(sp AS VARCHAR)) AS specific, coalesce(y.canonical_id, CAST(ge AS VARCHAR)) AS general, confidence,
    coalesce(x.canonical_id <> CAST(sp AS VARCHAR), false) OR coalesce(y.canonical_id <> CAST(ge AS VARCHAR), false) AS remapped, pos
  FROM ref LEFT JOIN mm x ON x.loser = CAST(sp AS VARCHAR) LEFT JOIN mm y ON y.loser = CAST(ge AS VARCHAR) WHERE sp % 7 <> 0
) SELECT specific, general, confidence, remapped FROM m WHERE specific <> general QUALIFY row_number() OVER (PARTITION BY specific, general ORDER BY pos) = 1""")


def _promoted(s: SparkSession, d: str) -> DataFrame:
    c = _clusters(s, d)
    members = F.split("members", ",")
    edited = c.select("members", F.when(F.size(members) % 3 == 2, F.lit("nobody")).otherwise(F.element_at(members, -1)).alias("canonical_id"), (F.size(members) % 2 == 0).alias("applied"))
    return themes.promoted(c, edited)


query("manual_promotion", _promoted, f"""
WITH {_CLS}, e AS (
  SELECT *, string_split(members, ',') AS m FROM cls
), f AS (
  SELECT *, CASE WHEN len(m) % 3 = 2 THEN 'nobody' ELSE m[-1] END AS chosen, len(m) % 2 = 0 AS applied FROM e
), g AS (SELECT *, status = 'review' AND applied AND list_contains(m, chosen) AS taken FROM f)
SELECT CASE WHEN taken THEN chosen ELSE CAST(canonical_id AS VARCHAR) END AS canonical_id, members, confidence, CASE WHEN taken THEN 'applied' ELSE status END AS status FROM g""")

# what a judge said about clusters of parts, from line items
_MEMBERS = "mem AS (SELECT DISTINCT l_suppkey % 40 AS cluster, CAST(l_partkey % 60 AS VARCHAR) AS id FROM lineitem WHERE l_linenumber <= 4)"
_CLAIMS = """clm AS (
  SELECT l_suppkey % 40 AS cluster, CAST(l_partkey % 70 AS VARCHAR) AS id, CASE WHEN l_quantity > 45 THEN 'cap' WHEN l_quantity > 25 THEN 'member' ELSE 'unattached' END AS part,
    CAST(l_partkey % 9 AS VARCHAR) AS cap_id, l_orderkey * 10 + l_linenumber AS pos FROM lineitem WHERE l_linenumber >= 3
)"""
_NAMES = "nam AS (SELECT CAST(p_partkey AS VARCHAR) AS id, min(p_name) AS name FROM part WHERE p_partkey % 4 <> 0 GROUP BY 1)"


def _table(s: SparkSession, d: str, cte: str, **tables: str) -> DataFrame:
    body = cte.split(" AS (", 1)[1].rsplit(")", 1)[0].replace("VARCHAR", "STRING")
    for t in ("lineitem", "part"):
        body = body.replace(f" FROM {t}", f" FROM {{{t}}}")
    return s.sql(body, **{t: _read(s, d, t) for t in ("lineitem", "part") if f"{{{t}}}" in body})


_members, _claims, _names = (lambda s, d: _table(s, d, _MEMBERS)), (lambda s, d: _table(s, d, _CLAIMS)), (lambda s, d: _table(s, d, _NAMES))


def _judged_caps(s: SparkSession, d: str) -> DataFrame:
    c = _claims(s, d).filter("part = 'member'")
    return c.select("cap_id", F.when(F.col("cap_id") != "3", F.concat(F.lit("cap "), "cap_id")).alias("label"), F.col("id").alias("member"), "pos")


def _seeds(s: SparkSession, d: str) -> DataFrame:
    return _claims(s, d).filter("part = 'cap'").select(F.col("id").alias("specific"), F.concat(F.lit("1"), "cap_id").alias("general"), "pos", F.lit(0.5).alias("confidence"))


_CAPS = f"""{_CLAIMS}, {_NAMES}, told AS (
  SELECT cap_id, CASE WHEN cap_id <> '3' THEN 'cap ' || cap_id END AS label, id AS member, 0 AS origin, pos FROM clm WHERE part = 'member'
  UNION ALL SELECT '1' || cap_id, NULL, id, 1, pos FROM clm WHERE part = 'cap'
), fst AS (SELECT cap_id, member, min((origin, pos)) AS seen FROM told GROUP BY ALL),
shw AS (SELECT cap_id, coalesce(name, member) AS shown, row_number() OVER (PARTITION BY cap_id ORDER BY seen, member) AS place FROM fst LEFT JOIN nam ON nam.id = member QUALIFY place <= 6),
exa AS (SELECT cap_id, string_agg(shown, ', ' ORDER BY place) AS examples FROM shw GROUP BY cap_id),
cap AS (SELECT cap_id, coalesce(any_value(name), max(label), cap_id) AS name, bool_or(origin = 1) AS is_seed, any_value(name) IS NULL AS is_new FROM told LEFT JOIN nam ON nam.id = cap_id GROUP BY cap_id)"""
query("cap_universe", lambda s, d: themes.cap_universe(_judged_caps(s, d), _seeds(s, d), _names(s, d)), f"WITH {_CAPS} SELECT cap_id, name, is_seed, is_new, examples FROM cap JOIN exa USING (cap_id)")


def _lonely(s: SparkSession, d: str) -> DataFrame:
    """Clusters by another rule, many of one member."""
    return _read(s, d, "part").select((F.col("p_partkey") % 150).alias("cluster"), F.col("p_partkey").cast("string").alias("id")).filter("CAST(id AS BIGINT) < 230")


def _orphans(s: SparkSession, d: str) -> DataFrame:
    caps = themes.cap_universe(_judged_caps(s, d), _seeds(s, d), _names(s, d))
    return themes.orphans(_claims(s, d).filter("part = 'unattached'").select("id"), _lonely(s, d), caps, _names(s, d))


query("orphan_set", _orphans, f"""
WITH {_CAPS}, lon AS (SELECT p_partkey % 150 AS cluster, min(CAST(p_partkey AS VARCHAR)) AS id FROM part WHERE p_partkey < 230 GROUP BY 1 HAVING count(*) = 1),
b AS (SELECT id, max(origin) AS origin FROM (SELECT id, 'unattached' AS origin FROM clm WHERE part = 'unattached' UNION ALL SELECT id, 'singleton' FROM lon) GROUP BY id)
SELECT id, coalesce(name, id) AS name, origin FROM b LEFT JOIN nam USING (id) WHERE id NOT IN (SELECT cap_id FROM cap)""")
query("seed_injection", lambda s, d: themes.injected(_members(s, d), _seeds(s, d).withColumn("general", F.expr("substring(general, 2, 9)")).select("specific", "general", "confidence").distinct()), f"""
WITH {_MEMBERS}, {_CLAIMS}, sed AS (SELECT DISTINCT id AS specific, cap_id AS general, 0.5::DOUBLE AS confidence FROM clm WHERE part = 'cap')
SELECT a.cluster, specific, general, confidence FROM sed JOIN mem a ON a.id = specific JOIN mem b ON b.id = general AND b.cluster = a.cluster""")
_described = lambda s, d: themes.described(_members(s, d), _names(s, d).withColumn("description", F.concat(F.lit("about "), "name")), 8)
query("cluster_build", _described, f"""
WITH {_MEMBERS}, {_NAMES} SELECT cluster, size, id, coalesce(name, id) AS name, 'about ' || name AS description, name IS NULL AS unknown
FROM mem JOIN (SELECT cluster, count(*) AS size FROM mem GROUP BY cluster HAVING count(*) >= 8) USING (cluster) LEFT JOIN nam USING (id)""")
query("partition_warnings", lambda s, d: themes.partition_warnings(_members(s, d), _claims(s, d)), f"""
WITH {_MEMBERS}, {_CLAIMS}, p AS (SELECT cluster, id, count(*) AS n, count(*) FILTER (part = 'cap') AS caps FROM clm GROUP BY ALL),
b AS (SELECT coalesce(m.cluster, p.cluster) AS cluster, m.id AS member, n, caps FROM mem m FULL JOIN p ON m.cluster = p.cluster AND m.id = p.id)
SELECT cluster, CAST(greatest(coalesce(sum(caps), 0) - 2, 0) AS BIGINT) AS caps_beyond_two, count(*) FILTER (member IS NULL) AS aliens, count(*) FILTER (n > 1) AS claimed_twice, count(*) FILTER (n IS NULL) AS unclaimed
FROM b GROUP BY cluster""")


def _replies(s: SparkSession, d: str) -> DataFrame:
    j = _judgments(_read(s, d, "embeddings"))
    general = F.when(F.col("a") % 4 == 0, F.col("a")).when(F.col("a") % 4 == 1, F.col("b")).when(F.col("a") % 4 == 2, F.lit(-1))
    return j.select("a", "b", F.when(F.col("b") % 9 == 0, "maybe").otherwise(F.col("verdict")).alias("verdict"), general.alias("general_id"))


query("judgment_validation", lambda s, d: themes.checked_judgments(_replies(s, d)), f"""
WITH {_JUDGED}, r AS (
  SELECT a, b, CASE WHEN b % 9 = 0 THEN 'maybe' ELSE verdict END AS v, CASE a % 4 WHEN 0 THEN a WHEN 1 THEN b WHEN 2 THEN -1 END AS g FROM jud
), c AS (SELECT *, v IN ('same', 'refinement', 'distinct') AS known, v = 'refinement' AND (g IS NULL OR g NOT IN (a, b)) AS alien FROM r)
SELECT a, b, CASE WHEN known THEN v ELSE 'error' END AS verdict, CASE WHEN alien THEN NULL ELSE g END AS general_id, NOT known OR alien AS review FROM c""")


def _decisions(s: SparkSession, d: str) -> DataFrame:
    p = _read(s, d, "part")
    cap = (F.col("p_partkey") % 7).cast("string")
    shortlist = F.array(*[((F.col("p_partkey") + k) % 5).cast("string") for k in (0, 1, 2)])
    return p.select(F.col("p_partkey").alias("orphan"), F.when(F.col("p_size") % 3 == 0, "standalone").otherwise("specializes").alias("action"), F.when(F.col("p_size") % 10 != 1, cap).alias("cap_id"), shortlist.alias("shortlist"))


_DECIDED = """dcs AS (
  SELECT p_partkey AS orphan, CASE WHEN p_size % 3 = 0 THEN 'standalone' ELSE 'specializes' END AS action, CASE WHEN p_size % 10 <> 1 THEN p_partkey % 7 END AS cap,
    [p_partkey % 5, (p_partkey + 1) % 5, (p_partkey + 2) % 5] AS shortlist FROM part
), dcd AS (SELECT *, action = 'specializes' AND cap IS NOT NULL AND list_contains(shortlist, cap) AS holds FROM dcs)"""
query("orphan_validation", lambda s, d: themes.checked_orphans(_decisions(s, d)), f"WITH {_DECIDED} SELECT orphan, CASE WHEN holds THEN action ELSE 'standalone' END AS action, CASE WHEN holds THEN CAST(cap AS VARCHAR) END AS cap_id FROM dcd")
query("cap_attachments", lambda s, d: themes.attachments(themes.checked_orphans(_decisions(s, d))), f"WITH {_DECIDED} SELECT CAST(cap AS VARCHAR) AS cap_id, count(*) AS n FROM dcd WHERE holds GROUP BY cap ORDER BY n DESC, cap_id LIMIT 12")
query("cluster_size_buckets", lambda s, d: themes.size_buckets(_lonely(s, d).unionByName(_members(s, d).withColumn("cluster", F.col("cluster") + 1000))), f"""
WITH {_MEMBERS}, c AS (SELECT p_partkey % 150 AS cluster FROM part WHERE p_partkey < 230 UNION ALL SELECT cluster + 1000 FROM mem), z AS (SELECT cluster, count(*) AS n FROM c GROUP BY cluster)
SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 6 THEN '4-6' WHEN n <= 12 THEN '7-12' ELSE '13+' END AS bucket, count(*) AS n_clusters FROM z GROUP BY 1""")


def _report(s: SparkSession, d: str) -> DataFrame:
    """Candidate pairs by band, in percent, and those to be judged that touch a hub."""
    from ..operators import similar

    e = _read(s, d, "embeddings")
    pairs = similar.cosine_pairs(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 8, 0.3)
    banded = pairs.withColumn("band", similar.band(F.col("cosine") * 2, F.lit(None).cast("double")))
    hub = lambda c: F.col(c) % 10 == 0
    return similar.band_report(banded, hub("id_a") | hub("id_b"))


query("candidate_summary", _report, f"""
WITH {_PAIRS}, b AS (SELECT *, CASE WHEN cosine * 2 >= 0.92::DOUBLE THEN 'auto' WHEN cosine * 2 >= 0.8::DOUBLE THEN 'judge' ELSE 'drop' END AS band FROM cos)
SELECT band, count(*) AS n, round(100 * count(*)::DOUBLE / (SELECT count(*) FROM b), 2) AS pct, count(*) FILTER (id_a % 10 = 0 OR id_b % 10 = 0) AS n_hub FROM b GROUP BY band""")


def _channels(s: SparkSession, d: str) -> DataFrame:
    from ..operators import similar

    e = _read(s, d, "embeddings")
    dense = similar.cosine_pairs(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 8, 0.3).withColumn("cosine", F.round("cosine", 6))
    lexical = dense.filter("(id_a + id_b) % 4 = 0").select(F.col("id_a"), (F.col("id_b") + 1).alias("id_b"), F.lit(0.7).alias("jaccard")).unionByName(dense.filter("id_a % 3 = 0").select("id_a", "id_b", F.lit(0.4).alias("jaccard"))).groupBy("id_a", "id_b").agg(F.max("jaccard").alias("jaccard"))
    return similar.channels(dense, lexical).withColumn("band", similar.band(F.coalesce("cosine", F.lit(0.0)) * 2, F.coalesce("jaccard", F.lit(0.0))))


query("candidate_channels", _channels, f"""
WITH {_PAIRS}, den AS (SELECT id_a, id_b, round(cosine, 6) AS cosine FROM cos),
lex AS (SELECT id_a, id_b, max(j) AS jaccard FROM (SELECT id_a, id_b + 1 AS id_b, 0.7::DOUBLE AS j FROM den WHERE (id_a + id_b) % 4 = 0 UNION ALL SELECT id_a, id_b, 0.4::DOUBLE FROM den WHERE id_a % 3 = 0) GROUP BY ALL),
u AS (SELECT id_a, id_b, cosine, jaccard FROM den FULL JOIN lex USING (id_a, id_b))
SELECT *, concat_ws('+', CASE WHEN cosine IS NOT NULL THEN 'dense' END, CASE WHEN jaccard IS NOT NULL THEN 'lexical' END) AS channels,
  CASE WHEN coalesce(cosine, 0) * 2 >= 0.92::DOUBLE THEN 'auto' WHEN coalesce(cosine, 0) * 2 >= 0.8::DOUBLE OR coalesce(jaccard, 0) >= 0.6::DOUBLE THEN 'judge' ELSE 'drop' END AS band FROM u""")


def _judgment_report(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.ordered_judgments(_judgments(_read(s, d, "embeddings")), 15)


query("judgment_report", _judgment_report, f"""
WITH {_JUDGED}, r AS (SELECT *, count(*) OVER (PARTITION BY verdict) AS n_verdict, row_number() OVER (PARTITION BY verdict ORDER BY confidence DESC, a, b) AS place FROM jud)
SELECT a, b, verdict, confidence, n_verdict, CAST(place AS INTEGER) AS place FROM r WHERE place <= 15""")


def _hierarchy_record(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.record(hierarchy.united(_raw_hierarchy(_judgments(_read(s, d, "embeddings")))), _read(s, d, "embeddings").filter("vec_id % 3 > 0").select(F.col("vec_id").alias("id")))


_HIER = _KNOWN["hierarchy_edges"].rsplit(" SELECT ", 1)[0]
query("hierarchy_record", _hierarchy_record, f"""{_HIER}, k AS (SELECT target, target IN (SELECT vec_id FROM embeddings WHERE vec_id % 3 > 0) AS there FROM hie GROUP BY target)
SELECT (SELECT count(*) FROM hie) AS n_edges, (SELECT count(*) FROM hie WHERE contains(origins, '+')) AS n_both, count(*) FILTER (there) AS n_promoted, count(*) FILTER (NOT there) AS n_made FROM k""")
