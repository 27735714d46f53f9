"""Queries over pages, records, labels and hybrid retrieval, with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.schema import NODE_TYPES
from ..functions.staging import stage
from ..operators import answers, graph, metrics, pagination, records, resolve, segment, validate
from ..sources.adapter import edges, nodes, with_occurrences
from .graph_queries import _PAIRS, RESOLVED
from .retrieval_queries import _FOUND, _central, _found, _read
from .graph_queries import ORACLES as _GRAPH
from .graph_queries import QUERIES as _GRAPH_QUERIES
from .retrieval_queries import ORACLES as _KNOWN
from .text_queries import _LINES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, function: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    QUERIES[name] = function
    if sql:
        ORACLES[name] = with_occurrences(sql) if "node_occ" in sql or "edge_occ" in sql else sql


# pages ---------------------------------------------------------------------------------------------------------------
def _positioned(s: SparkSession, d: str) -> DataFrame:
    """Lines of documents; their length stands in for the place where they begin."""
    return segment.lines(_read(s, d, "documents").withColumn("text", F.replace("text", F.lit(". "), F.lit(".\n")))).withColumn("x0", (F.length("text") % 23).cast("double"))


_POS = _LINES.replace("string_split(text, chr(10))", "string_split(replace(text, '. ', '.' || chr(10)), chr(10))")
_IND = f"""{_POS}, pos AS (SELECT *, (length(text) % 23)::DOUBLE AS x0 FROM lin), ful AS (SELECT * FROM pos WHERE trim(text, ' ') <> ''),
own AS (SELECT page, median(x0) AS m, count(*) AS k FROM ful GROUP BY page), ind AS (SELECT pos.page, line_no, text, coalesce(x0 > CASE WHEN k >= 3 THEN m ELSE (SELECT median(x0) FROM ful) END + 5, false) AS indented FROM pos LEFT JOIN own USING (page))"""
query("indent_flags", lambda s, d: pagination.indented(_positioned(s, d)).groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.count_if("indented").alias("n_indented")), f"WITH {_IND} SELECT page, count(*) AS n, count(*) FILTER (indented) AS n_indented FROM ind GROUP BY page")


def _titles(s: SparkSession, d: str) -> DataFrame:
    """Short lines that stand on more than one page."""
    return _positioned(s, d).select("page", F.trim("text").alias("title")).filter("length(title) BETWEEN 1 AND 30").groupBy("title").agg(F.count_distinct("page").alias("n")).filter("n > 1").select("title")


_TIT = "tit AS (SELECT trim(text, ' ') AS title FROM lin WHERE length(trim(text, ' ')) BETWEEN 1 AND 30 GROUP BY 1 HAVING count(DISTINCT page) > 1)"
query("paragraph_reconstruct", lambda s, d: pagination.reconstructed(pagination.indented(_positioned(s, d)), _titles(s, d)).select("page", "para", F.md5("text").alias("text"), "first", "n"), rf"""
WITH {_IND}, {_TIT}, mar AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat FROM ind),
t2 AS (SELECT *, flat IN (SELECT title FROM tit) AS t FROM mar),
opn AS (SELECT *, coalesce(lag(flat) OVER w = '', true) OR t OR coalesce(lag(t) OVER w, false) OR indented AS opens FROM t2 WINDOW w AS (PARTITION BY page ORDER BY line_no)),
par AS (SELECT *, sum(opens::INT) OVER (PARTITION BY page ORDER BY line_no) AS para FROM opn WHERE flat <> '')
SELECT page, CAST(para AS BIGINT) AS para, md5(string_agg(flat, ' ' ORDER BY line_no)) AS text, min(line_no) AS first, CAST(count(*) AS INTEGER) AS n FROM par GROUP BY ALL""")


def _raw(s: SparkSession, d: str) -> DataFrame:
    """Documents under three titles; some lack one, have one twice or in another order."""
    one, two = F.when(F.col("doc_id") % 11 == 0, "TWO").otherwise("ONE"), F.when(F.col("doc_id") % 5 == 0, "2").when(F.col("doc_id") % 11 == 0, "ONE").otherwise("TWO")
    raw = F.concat(one, F.lit("\n\n"), F.coalesce("text", F.lit("")), F.lit("\n\n"), two, F.lit("\n\n\n"), F.coalesce("source", F.lit("-")), F.when(F.col("doc_id") % 7 == 0, "\n\nONE").otherwise(""), F.lit("\n\n THREE\n\n"), F.coalesce("lang", F.lit("-")), F.lit(" \n"))
    return _read(s, d, "documents").select(F.col("doc_id").alias("page"), raw.alias("raw"))


def _three(s: SparkSession) -> DataFrame:
    return s.createDataFrame([(1, "ONE"), (2, "TWO"), (3, "THREE")], "number int, title string")


_PARTS = r"""raw AS (SELECT doc_id AS page, CASE WHEN doc_id % 11 = 0 THEN 'TWO' ELSE 'ONE' END || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10) || CASE WHEN doc_id % 5 = 0 THEN '2' WHEN doc_id % 11 = 0 THEN 'ONE' ELSE 'TWO' END || chr(10) || chr(10) || chr(10)
  || coalesce(source, '-') || CASE WHEN doc_id % 7 = 0 THEN chr(10) || chr(10) || 'ONE' ELSE '' END || chr(10) || chr(10) || ' THREE' || chr(10) || chr(10) || coalesce(lang, '-') || ' ' || chr(10) AS raw FROM documents),
blk AS (SELECT page, unnest(range(len(b))) AS i, unnest(b) AS text FROM (SELECT page, string_split(raw, chr(10) || chr(10)) AS b FROM raw)),
blp AS (SELECT *, CAST(coalesce(sum(length(text) + 2) OVER (PARTITION BY page ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM blk),
ttl AS (SELECT unnest([1, 2, 3]) AS number, unnest(['ONE', 'TWO', 'THREE']) AS title),
hit AS (SELECT page, number, count(*) AS times, min(start) AS start, min(start + length(text)) AS stop FROM blp JOIN ttl ON regexp_replace(text, '^\s+|\s+$', '', 'g') = title GROUP BY ALL),
nxt AS (SELECT *, lead(start) OVER (PARTITION BY page ORDER BY number) AS next FROM hit),
sta AS (SELECT raw.page, CASE WHEN count(number) < 3 THEN 'missing' WHEN max(times) > 1 THEN 'duplicate' WHEN bool_or(next < start) THEN 'out of order' ELSE 'ok' END AS status FROM raw LEFT JOIN nxt USING (page) GROUP BY raw.page)"""
query("part_status", lambda s, d: pagination.part_structure(_raw(s, d), _three(s))[1], f"WITH {_PARTS} SELECT * FROM sta")
query("part_structure", lambda s, d: pagination.part_structure(_raw(s, d), _three(s))[0], rf"""
WITH {_PARTS}, bod AS (SELECT nxt.*, title, coalesce(next, length(raw)) AS until, substr(raw, stop + 1, coalesce(next, length(raw)) - stop) AS body FROM nxt JOIN sta USING (page) JOIN raw USING (page) JOIN ttl USING (number) WHERE status = 'ok')
SELECT page, number, title, start, stop, stop + length(regexp_extract(body, '^[\n ]*')) AS body_start, greatest(stop + length(regexp_extract(body, '^[\n ]*')), until - length(regexp_extract(body, '[\n ]*$'))) AS body_end FROM bod""")


def _filtered(s: SparkSession, d: str) -> DataFrame:
    kept, gone = pagination.without_titles(pagination.blocks(_raw(s, d)), pagination.part_structure(_raw(s, d), _three(s))[0])
    return kept.groupBy("page").agg(F.count(F.lit(1)).alias("n_kept")).join(gone.groupBy("page").agg(F.count(F.lit(1)).alias("n_gone")), "page", "left").select("page", "n_kept", F.coalesce("n_gone", F.lit(0)).alias("n_gone"))


query("title_filter", _filtered, rf"""WITH {_PARTS}, x AS (SELECT blp.page, coalesce(status = 'ok' AND regexp_replace(text, '^\s+|\s+$', '', 'g') IN ('ONE', 'TWO', 'THREE'), false) AS gone FROM blp JOIN sta USING (page))
SELECT page, count(*) FILTER (NOT gone) AS n_kept, count(*) FILTER (gone) AS n_gone FROM x GROUP BY page HAVING count(*) FILTER (NOT gone) > 0""")
query("title_pages", lambda s, d: pagination.title_pages(_positioned(s, d).select("page", "text"), _positioned(s, d).filter("length(trim(text)) BETWEEN 1 AND 16").select(F.trim("text").alias("title")).unionByName(s.createDataFrame([("No such title",)], "title string"))), f"""
WITH {_POS}, t AS (SELECT DISTINCT trim(text, ' ') AS title FROM lin WHERE length(trim(text, ' ')) BETWEEN 1 AND 16 UNION SELECT 'No such title'), f AS (SELECT trim(text, ' ') AS title, count(*) AS n, min(page) AS page FROM lin GROUP BY 1)
SELECT title, CASE WHEN n = 1 THEN page END AS page, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' ELSE 'ok' END AS status FROM t LEFT JOIN f USING (title)""")
query("compact_pages", lambda s, d: pagination.compact_lists(_read(s, d, "lineitem").select(F.col("l_suppkey").alias("grp"), (F.col("l_orderkey") % 90).alias("page")).filter("page % 7 <> 3 AND (grp % 2 = 0 OR page < 19)")), """
WITH g AS (SELECT DISTINCT l_suppkey AS grp, l_orderkey % 90 AS page FROM lineitem WHERE l_orderkey % 90 % 7 <> 3 AND (l_suppkey % 2 = 0 OR l_orderkey % 90 < 19)), i AS (SELECT *, page - row_number() OVER (PARTITION BY grp ORDER BY page) AS k FROM g),
r AS (SELECT grp, min(page) AS a, max(page) AS b FROM i GROUP BY grp, k), n AS (SELECT grp, count(*) AS n, string_agg(CAST(page AS VARCHAR), ', ' ORDER BY page) AS every FROM g GROUP BY grp)
SELECT grp, CASE WHEN any_value(n) <= 20 THEN any_value(every) ELSE string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE CAST(a AS VARCHAR) || '-' || CAST(b AS VARCHAR) END, ', ' ORDER BY a) END AS pages FROM r JOIN n USING (grp) GROUP BY grp""")
query("hyphen_residue", lambda s, d: pagination.hyphen_residue(segment.lines(_read(s, d, "documents").withColumn("text", F.regexp_replace("text", r"[,.] ", "- \n")))), r"""
WITH lin AS (SELECT doc_id AS page, CAST(unnest(range(len(l))) AS INTEGER) AS line_no, unnest(l) AS text FROM (SELECT doc_id, string_split(regexp_replace(text, '[,.] ', '- ' || chr(10), 'g'), chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
n AS (SELECT *, lead(text) OVER (PARTITION BY page ORDER BY line_no) AS next, regexp_replace(text, '[ \t]+$', '') AS bare FROM lin)
SELECT page, line_no, substr(text || chr(10) || next, 1, 80) AS context FROM n WHERE next IS NOT NULL AND regexp_matches(bare, '[\p{L}\p{N}][-–—]$') AND NOT regexp_matches(next, '^[ \t]*\p{Ll}')""")
query("page_concat", lambda s, d: pagination.joined_pages(_read(s, d, "conversations").select(F.col("conv_id").alias("book"), F.col("turn").alias("page"), "text"), "\n--\n"), "SELECT conv_id AS book, string_agg(text, chr(10) || '--' || chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id")

# labels --------------------------------------------------------------------------------------------------------------
_PATH = "'data/x.y/part_ch_' || lpad(CAST(o_orderkey AS STRING), 9, '0') || CASE WHEN o_orderkey % 3 = 0 THEN '.json' ELSE '' END"


def _orders(s: SparkSession, d: str) -> DataFrame:
    return _read(s, d, "orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", f"CASE WHEN o_orderkey % 4 = 0 THEN 'data/other.json' ELSE {_PATH} END AS path", "'run ch_' || CAST(o_custkey AS STRING) || ' x' AS told")


query("canonical_chunk", lambda s, d: _orders(s, d).select("o_orderkey", labels.canonical_chunk(F.col("path"), F.when(F.col("o_custkey") % 2 == 0, F.col("told"))).alias("chunk_id")), "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'ch_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') WHEN o_custkey % 2 = 0 THEN 'ch_' || CAST(o_custkey AS VARCHAR) END AS chunk_id FROM orders")
query("shrunk_path", lambda s, d: _orders(s, d).select("o_orderkey", labels.shrunk_path(F.col("path")).alias("short"), labels.source_label(F.concat(F.lit("/root/repo\\"), "path"), F.lit("/root/repo")).alias("label")), "WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'data/other' ELSE 'data/x.y/part_ch_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS stem, CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 3 = 0 THEN '.json' ELSE '' END AS suffix FROM orders) SELECT o_orderkey, stem || '_shrunk' || suffix AS short, stem || suffix AS label FROM p")
query("profile_text", lambda s, d: _read(s, d, "customer").select("c_custkey", labels.profile(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") + 70), F.when(F.col("c_custkey") % 5 > 0, "Rome"), F.when(F.col("c_custkey") % 7 == 0, F.array(F.lit("a"), F.lit("b"))), F.array().cast("array<string>"), F.col("c_mktsegment"), F.when(F.col("c_custkey") % 4 == 0, "")).alias("profile")), """
SELECT c_custkey, concat_ws(chr(10), 'Nome canonico: ' || c_name, CASE WHEN c_custkey % 6 = 0 THEN 'Anni: ' || c_custkey || '–' || (c_custkey + 70) || ' d.C.' WHEN c_custkey % 2 = 0 THEN 'Anno di nascita: ' || c_custkey || ' d.C. (vivente)' WHEN c_custkey % 3 = 0 THEN 'Anno di morte: ' || (c_custkey + 70) || ' d.C.' END,
  CASE WHEN c_custkey % 5 > 0 THEN 'Luogo di nascita: Rome' END, CASE WHEN c_custkey % 7 = 0 THEN 'Nomi formali: a, b' END, 'Ruolo: ' || c_mktsegment) AS profile FROM customer""")
query("chunk_message", lambda s, d: _read(s, d, "documents").filter("text IS NOT NULL").select("doc_id", F.md5(labels.chunk_message(F.concat(F.lit("ch_"), F.col("doc_id").cast("string")), F.col("text"))).alias("message")), "SELECT doc_id, md5('chunk_id: ch_' || doc_id || chr(10) || chr(10) || 'chunk_text:' || chr(10) || text) AS message FROM documents WHERE text IS NOT NULL")
_part = lambda s, d: _read(s, d, "part").select("p_partkey", F.concat(F.lit("pt_"), F.col("p_partkey").cast("string")).alias("id"), F.when(F.col("p_partkey") % 5 > 0, F.concat("p_name", F.lit(" of "), "p_type", F.lit(" and "), "p_type")).alias("name"), F.when(F.col("p_partkey") % 10 > 0, F.col("p_brand")).alias("kind"))
query("node_labels", lambda s, d: _part(s, d).select("p_partkey", labels.node_label(F.col("id"), F.col("name"), F.col("kind")).alias("label"), labels.short_label(F.col("id"), F.col("name"), F.col("kind")).alias("short")), """
WITH p AS (SELECT p_partkey, 'pt_' || p_partkey AS id, CASE WHEN p_partkey % 5 > 0 THEN p_name || ' of ' || p_type || ' and ' || p_type END AS name, CASE WHEN p_partkey % 10 > 0 THEN p_brand END AS kind FROM part),
l AS (SELECT *, coalesce(name, id) || ' [' || coalesce(kind, '?') || ']' AS n FROM p)
SELECT p_partkey, CASE WHEN name IS NULL AND kind IS NULL THEN id ELSE n || '  (' || id || ')' END AS label, CASE WHEN name IS NULL AND kind IS NULL THEN id WHEN length(n) > 60 THEN substr(n, 1, 59) || '…' ELSE n END AS short FROM l""")
query("calibrated_rate", lambda s, d: nodes(s, d).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("chunk_id").alias("c")).select("type", labels.per_hundred(F.col("n"), F.col("c")).alias("rate")), "SELECT type, round(count(*) * 100.0::DOUBLE / count(DISTINCT chunk_id), 2) AS rate FROM node_occ GROUP BY type")


def _pair_texts(s: SparkSession, d: str) -> DataFrame:
    p = _read(s, d, "part")
    side = lambda k: F.struct((F.col("p_partkey") + k).alias("id"), F.concat(F.lit("n "), "p_name").alias("name"), (F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")) if k else F.lit(None).cast("string")).alias("description"), F.split(F.col("p_type"), " ").alias("spans"))
    return p.select("p_partkey", labels.pair_text(side(0), side(1), 2).alias("prompt"))


query("pair_prompt", _pair_texts, """
WITH x AS (SELECT *, string_split(p_type, ' ') AS w FROM part), y AS (SELECT *, chr(10) || array_to_string(list_transform(w[1:2], lambda v: '- ' || v), chr(10)) AS spans FROM x)
SELECT p_partkey, 'A: ' || p_partkey || ' | n ' || p_name || chr(10) || '-' || spans || chr(10) || chr(10) || 'B: ' || (p_partkey + 1) || ' | n ' || p_name || chr(10) || CASE WHEN p_partkey % 3 > 0 THEN p_type ELSE '-' END || spans AS prompt FROM y""")

# records -------------------------------------------------------------------------------------------------------------
_prov = lambda n: records.provenance(F.col("chunk_id"), "m1", "2024-01-01T00:00:00", F.col("confidence"), F.col("name"))
query("provenance_record", lambda s, d: nodes(s, d).select("id", "pos", _prov(None).alias("p")).select("id", "pos", "p.*").withColumn("confidence", F.round("confidence", 6)), "SELECT id, pos, chunk_id, 'm1' AS model, '2024-01-01T00:00:00' AS timestamp, '1' AS schema_version, round(confidence, 6) AS confidence, name AS evidence_span, false AS human_validated FROM node_occ")
query("slim_provenance", lambda s, d: nodes(s, d).select("id", "type", F.explode(records.slim(F.array(_prov(None)))).alias("p")).groupBy("id", "type").agg(F.count("p").cast("int").alias("n"), F.round(F.max("p.confidence"), 6).alias("most")), "SELECT id, type, CAST(count(*) AS INTEGER) AS n, round(max(confidence), 6) AS most FROM node_occ GROUP BY id, type")
query("flat_edges", lambda s, d: records.flat_edges(edges(s, d).select("pos", "source_id", "target_id", "type", F.struct(F.round("confidence", 6).alias("confidence"), F.coalesce("role", F.lit("")).alias("evidence_span")).alias("provenance"))), "SELECT pos, source_id, target_id, type, round(confidence, 6) AS confidence, coalesce(role, '') AS evidence_span FROM edge_occ")
_runs = lambda s, d: _read(s, d, "orders").select(F.concat(F.lit("ch_"), F.col("o_orderkey").cast("string")).alias("chunk_id"), F.round(F.col("o_totalprice") / 1000, 3).alias("seconds"), (F.col("o_orderkey") % 900).alias("tokens_in"), (F.col("o_custkey") % 90).alias("tokens_out"), F.when(F.col("o_orderkey") % 50 == 0, "error").otherwise("ok").alias("status"))
_ENVELOPE = "SELECT count(*) AS total_chunks_processed, count(*) FILTER (o_orderkey % 50 <> 0) AS n_ok, count(*) FILTER (o_orderkey % 50 = 0) AS n_error, CAST(sum(o_orderkey % 900) AS BIGINT) AS tokens_in, CAST(sum(o_custkey % 90) AS BIGINT) AS tokens_out, round(sum(round(o_totalprice / 1000, 3)), 3) AS seconds, count(DISTINCT o_orderkey) AS n_chunks_requested, 'data/chunks.json' AS source, '3' AS stage_version FROM orders"
query("log_envelope", lambda s, d: records.envelope(_runs(s, d), _runs(s, d), "data/chunks.json", "3"), _ENVELOPE)
query("run_metadata", lambda s, d: records.run_metadata(records.envelope(_runs(s, d), _runs(s, d), "data/chunks.json", "3")), f"SELECT source, stage_version, n_chunks_requested, total_chunks_processed FROM ({_ENVELOPE})")
query("chunk_selection", lambda s, d: records.selected(nodes(s, d), explicit=["ch_000000000007", "ch_000000000003", "ch_none"]), "SELECT chunk_id, CASE chunk_id WHEN 'ch_000000000007' THEN 1 ELSE 2 END AS place FROM (SELECT DISTINCT chunk_id FROM node_occ WHERE chunk_id IN ('ch_000000000007', 'ch_000000000003', 'ch_none'))")
query("chunk_selection_gold", lambda s, d: records.selected(nodes(s, d), gold=nodes(s, d).filter("type = 'Work' AND pos % 7 = 0")).select("chunk_id"), "SELECT DISTINCT chunk_id FROM node_occ WHERE type = 'Work' AND pos % 7 = 0")


def _unready(s: SparkSession, d: str) -> DataFrame:
    n = nodes(s, d)
    return records.unready(resolve.merge_decisions(n), n.filter("type <> 'Work'"))


query("resolver_preflight", _unready, RESOLVED + """, bad AS (SELECT type, norm, ids, CASE WHEN n_top = 1 AND groups = 1 THEN top END AS canonical_id FROM dec), los AS (SELECT unnest(string_split(ids, ',')) AS id, canonical_id FROM bad WHERE canonical_id IS NOT NULL)
SELECT 'open decision' AS problem, ids AS what FROM bad WHERE canonical_id IS NULL UNION ALL SELECT 'unknown loser', id FROM los WHERE id <> canonical_id AND id NOT IN (SELECT id FROM node_occ WHERE type <> 'Work')""")
query("node_samples", lambda s, d: records.node_samples(nodes(s, d)), """WITH r AS (SELECT *, row_number() OVER (PARTITION BY id, type ORDER BY pos, confidence, name) AS place FROM node_occ), c AS (SELECT id, type, chunk_id, row_number() OVER (PARTITION BY id, type ORDER BY chunk_id) AS k FROM (SELECT DISTINCT id, type, chunk_id FROM node_occ)),
h AS (SELECT id, type, string_agg(chunk_id, ',' ORDER BY chunk_id) AS chunks FROM c WHERE k <= 5 GROUP BY ALL)
SELECT id, type, max(name) FILTER (place = 1) AS name, count(*) AS n_provenances, any_value(chunks) AS chunks, string_agg(substr(coalesce(name, ''), 1, 100), '|' ORDER BY place) FILTER (place <= 3) AS spans FROM r JOIN h USING (id, type) GROUP BY id, type""")
_ACTIONS = ["not-embodies", "dangling", "incompatible", "duplicate", "materialised"]
QUERIES["embodies_counts"] = lambda s, d: records.action_counts(_GRAPH_QUERIES["embodies"](s, d), _ACTIONS)
ORACLES["embodies_counts"] = f"WITH e AS ({_GRAPH['embodies']}) SELECT " + ", ".join(f"count(*) FILTER (action = '{a}') AS {a.replace('-', '_')}" for a in _ACTIONS) + " FROM e"
query("themes_dump", lambda s, d: records.theme_dump(_read(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.concat("p_type", F.lit("  "), F.repeat(F.concat("p_name", F.lit(" ")), 14)).alias("description"))), r"""
WITH p AS (SELECT p_partkey AS id, p_name AS name, trim(regexp_replace(p_type || '  ' || repeat(p_name || ' ', 14), '\s+', ' ', 'g')) AS f FROM part)
SELECT id, name, CASE WHEN length(f) > 200 THEN substr(f, 1, 200) || '...' ELSE f END AS description, CAST(row_number() OVER (PARTITION BY lower(substr(name, 1, 1)) ORDER BY lower(name), id) AS INTEGER) AS place FROM p""")
query("node_breakdown", lambda s, d: records.type_breakdown(nodes(s, d).filter("type <> 'Event'").withColumn("type", F.when(F.col("id").startswith("br_"), "Brand").otherwise(F.col("type"))), NODE_TYPES), f"SELECT t AS type, count(DISTINCT id) AS n, string_agg(DISTINCT id, ',' ORDER BY id) AS ids, t IN ({', '.join(repr(t) for t in NODE_TYPES)}) AS in_schema FROM (SELECT id, CASE WHEN starts_with(id, 'br_') THEN 'Brand' ELSE type END AS t FROM node_occ WHERE type <> 'Event') GROUP BY t")
query("compact_report", lambda s, d: records.compact_comparison(nodes(s, d).filter("pos % 3 <> 0"), nodes(s, d).filter("confidence > 0.7")), "WITH g AS (SELECT chunk_id, type, count(*) AS g FROM node_occ WHERE pos % 3 <> 0 GROUP BY ALL), m AS (SELECT chunk_id, type, count(*) AS m FROM node_occ WHERE confidence > 0.7::DOUBLE GROUP BY ALL) SELECT chunk_id, type, '[' || coalesce(g, 0) || ', ' || coalesce(m, 0) || ']' AS pair FROM g FULL JOIN m USING (chunk_id, type)")
query("few_shots", lambda s, d: records.few_shots(_read(s, d, "benchmark").select(F.concat(F.lit("gold/v.1/"), F.col("item_id").cast("string"), F.lit(".json")).alias("path"), F.substring("text", 1, 20).alias("reply")), _read(s, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.substring("text", 1, 30).alias("text"))), "SELECT CAST(doc_id AS VARCHAR) AS chunk_id, substr(d.text, 1, 30) AS text, substr(b.text, 1, 20) AS reply FROM benchmark b JOIN documents d ON doc_id = item_id")


def _speakers(s: SparkSession, d: str) -> DataFrame:
    c = _read(s, d, "conversations").select(F.col("conv_id").alias("conv"), F.concat(F.lit("r"), (F.col("turn") % 5).cast("string")).alias("raw"), "turn").groupBy("conv", "raw").agg(F.min("turn").alias("first"))
    scores = c.filter("conv % 4 > 0").select("conv", "raw", F.explode(F.array(F.lit("Ann"), F.lit("Cy"))).alias("label"), "first")
    scores = scores.withColumn("cosine", F.when(F.col("label") == "Ann", ((F.col("first") * 7 + F.col("conv")) % 5) / 5).otherwise(((F.col("first") * 3 + F.col("conv")) % 5) / 5))
    return records.speaker_targets(scores.select("conv", "raw", "label", "cosine"), c, ["Ann", "Bob", "Cy"])


query("speaker_match", _speakers, """
WITH c AS (SELECT conv_id AS conv, 'r' || (turn % 5) AS raw, min(turn) AS first FROM conversations GROUP BY ALL),
a AS (SELECT conv, raw, 'Ann' AS label FROM c WHERE conv % 4 > 0 QUALIFY row_number() OVER (PARTITION BY conv ORDER BY (first * 7 + conv) % 5 DESC, first) = 1),
l1 AS (SELECT c.* FROM c LEFT JOIN a USING (conv, raw) WHERE a.label IS NULL),
y AS (SELECT conv, raw, 'Cy' AS label FROM l1 WHERE conv % 4 > 0 QUALIFY row_number() OVER (PARTITION BY conv ORDER BY (first * 3 + conv) % 5 DESC, first) = 1),
dn AS (SELECT * FROM a UNION ALL SELECT * FROM y), k AS (SELECT conv, count(*) AS n FROM dn GROUP BY conv),
l2 AS (SELECT c.conv, c.raw, row_number() OVER (PARTITION BY c.conv ORDER BY first, c.raw) AS place FROM c LEFT JOIN dn ON dn.conv = c.conv AND dn.raw = c.raw WHERE dn.label IS NULL)
SELECT conv, raw, label FROM dn UNION ALL SELECT l2.conv, raw, coalesce(CASE WHEN l2.conv % 4 > 0 THEN ['Bob'][place] ELSE ['Ann', 'Bob', 'Cy'][place] END, 'S' || (coalesce(n, 0) + place)) FROM l2 LEFT JOIN k USING (conv)""")


def _layout(s: SparkSession, d: str) -> DataFrame:
    n = nodes(s, d).groupBy("id").agg(F.min("pos").alias("pos"), F.min("type").alias("type"))
    points = _read(s, d, "embeddings").select(F.col("vec_id").alias("i"), (F.col("vec_id") * 1.5).cast("double").alias("x"), (F.col("vec_id") % 10).cast("double").alias("y"))
    fixed = n.filter("type = 'Era'").select("id", F.lit(0.0).alias("x"), F.lit(1.0).alias("y"))
    return records.placed_on_points(n, points, fixed, ["cu_1"])


query("layout_assign", _layout, """
WITH n AS (SELECT id, min(pos) AS pos, min(type) AS type FROM node_occ GROUP BY id), e AS (SELECT id, row_number() OVER (ORDER BY pos, id) AS place FROM n WHERE id <> 'cu_1' AND type <> 'Era'),
p AS (SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id * 1.5::DOUBLE AS x, (vec_id % 10)::DOUBLE AS y FROM embeddings)
SELECT id, x, y, true AS fixed FROM e JOIN p USING (place) UNION ALL SELECT id, 0.0::DOUBLE, 1.0::DOUBLE, true FROM n WHERE type = 'Era'""")
query("map_topics", lambda s, d: records.on_maps(nodes(s, d), _read(s, d, "part").groupBy((F.col("p_size") % 6).alias("map"), F.col("p_brand").alias("topic")).agg(F.collect_list(F.concat(F.lit("pt_"), (F.col("p_partkey") * 2).cast("string"))).alias("ids"))), "SELECT DISTINCT p_size % 6 AS map, p_brand AS topic, 'pt_' || (p_partkey * 2) AS id FROM part WHERE 'pt_' || (p_partkey * 2) IN (SELECT id FROM node_occ)")

# hybrid retrieval ----------------------------------------------------------------------------------------------------
MOST = 60


def _hybrid(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(found, resolved nodes, kept, walked) of five questions."""
    found, n = stage(_found(s, d), "found"), stage(nodes(s, d), "occurrences")
    told = resolve.told(n)
    known, links = stage(resolve.resolved_nodes(n, told, chunks=False), "nodes"), stage(resolve.resolved_edges(n, edges(s, d), told), "edges")
    kept, walked = answers.expanded(answers.seeds(found, n), known, links, MOST)
    return found, known, stage(kept, "kept"), stage(walked, "walked")


_TYPE_RANK = "CASE type WHEN 'Event' THEN 0 WHEN 'Person' THEN 1 WHEN 'Place' THEN 2 WHEN 'Phase' THEN 3 WHEN 'Era' THEN 4 WHEN 'Theme' THEN 5 WHEN 'Reflection' THEN 6 WHEN 'Work' THEN 7 ELSE 9 END"
_HYBRID = RESOLVED.replace("WITH per_name", f"WITH {_FOUND}, per_name", 1) + f""", see AS (SELECT DISTINCT q_id, o.id FROM top JOIN node_occ o USING (chunk_id)),
wal AS (SELECT DISTINCT q_id, source, target, type, role, reversed FROM (SELECT source, target, type, role, false AS reversed FROM edg UNION ALL SELECT target, source, type, role, true FROM edg) x JOIN see ON see.id = x.source),
rin AS (SELECT q_id, id, min(ring) AS ring FROM (SELECT q_id, id, 0 AS ring FROM see UNION ALL SELECT q_id, target, 1 FROM wal) GROUP BY ALL), knw AS (SELECT id, min(type) AS type, sum(n_provenances) AS n FROM res GROUP BY id),
kep AS (SELECT q_id, id, type, ring FROM rin JOIN knw USING (id) QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY ring, n >= 20, {_TYPE_RANK}, id) <= {MOST}),
ked AS (SELECT wal.* FROM wal WHERE (q_id, source) IN (SELECT (q_id, id) FROM kep) AND (q_id, target) IN (SELECT (q_id, id) FROM kep)),
fnm AS (SELECT id, min(name) AS name FROM res GROUP BY id),
oed AS (SELECT ked.*, coalesce(a.name, source) AS source_name, coalesce(b.name, target) AS target_name FROM ked LEFT JOIN fnm a ON a.id = source LEFT JOIN fnm b ON b.id = target),
ode AS (SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY type, source_name, target_name, source, target, role NULLS FIRST, reversed) AS INTEGER) AS place FROM oed)"""
_names = lambda known: known.groupBy("id").agg(F.min("name").alias("name"))


def _context(s: SparkSession, d: str) -> DataFrame:
    found, known, kept, walked = _hybrid(s, d)
    docs = _read(s, d, "documents").select(F.col("doc_id").alias("id"), "text", F.coalesce("source", F.lit("-")).alias("title"))
    chunks = found.join(docs, "id").select("q_id", "place", "chunk_id", (F.col("id") % 6 + 1).alias("part"), "title", F.round("score", 2).alias("score"), "text")
    # four chunks are told and whether there are more, so five of each kept node are enough
    first = F.row_number().over(Window.partitionBy("id").orderBy("chunk_id"))
    held = nodes(s, d).select("id", "chunk_id").join(kept.select("id").distinct(), "id", "left_semi").distinct().withColumn("n", first).filter("n <= 5").groupBy("id").agg(F.collect_list("chunk_id").alias("chunk_ids"))
    described = kept.join(_names(known), "id").join(held, "id", "left").withColumn("description", F.when(F.col("type") == "Work", F.concat(F.lit("made  of "), "name"))).withColumn("chunk_ids", F.coalesce("chunk_ids", F.array().cast("array<string>")))
    return answers.full_context(chunks, described, answers.ordered_edges(walked, _names(known)), chunk_limit=80)


query("hybrid_nodes", lambda s, d: _hybrid(s, d)[2], _HYBRID + " SELECT q_id, id, type, ring FROM kep")
query("edge_order", lambda s, d: (lambda h: answers.ordered_edges(h[3], _names(h[1])))(_hybrid(s, d)), _HYBRID + " SELECT * FROM ode")
query("retrieval_payload", lambda s, d: (lambda h: answers.payload(h[0], h[2], _central(s, d)))(_hybrid(s, d)), _HYBRID + f""", cen AS ({_KNOWN['central_node']})
SELECT q_id, (SELECT count(*) FROM top t WHERE t.q_id = k.q_id) AS n_chunks, count(*) FILTER (ring = 0) AS n_seeds, count(*) AS n_nodes, any_value(node) AS central_node FROM kep k LEFT JOIN cen USING (q_id) GROUP BY q_id""")
query("full_context", _context, _HYBRID + r""", chl AS (SELECT q_id, string_agg(chr(10) || '[' || place || '] chunk ' || chunk_id || ' | parte ' || (top.id % 6 + 1) || ': ' || coalesce(source, '-') || ' (score ' || printf('%.3f', round(score, 2)) || ')' || chr(10)
  || CASE WHEN length(f) > 80 THEN rtrim(substr(f, 1, 79)) || '…' ELSE f END, chr(10) ORDER BY place) AS c FROM top JOIN (SELECT *, coalesce(trim(regexp_replace(text, '\s+', ' ', 'g')), '') AS f FROM documents) d ON doc_id = top.id GROUP BY q_id),
chk AS (SELECT id, list_sort(list(DISTINCT chunk_id)) AS l FROM node_occ GROUP BY id),
nol AS (SELECT q_id, string_agg('- ' || type || ' «' || name || '» (id=' || id || ')' || CASE WHEN type = 'Work' THEN ': made of ' || name ELSE '' END || CASE WHEN len(l) > 0 THEN ' [chunk: ' || array_to_string(l[1:4], ', ') || CASE WHEN len(l) > 4 THEN ', ...' ELSE '' END || ']' ELSE '' END, chr(10) ORDER BY id) AS n FROM kep JOIN fnm USING (id) LEFT JOIN chk USING (id) GROUP BY q_id),
edl AS (SELECT q_id, string_agg('- ' || source_name || ' --[' || type || CASE WHEN role <> '' THEN ', ruolo=' || role ELSE '' END || ']--> ' || target_name, chr(10) ORDER BY place) AS e FROM ode GROUP BY q_id)
SELECT q_id, concat_ws(chr(10), '=== PASSAGGI DEL TESTO SORGENTE ===', c, chr(10) || '=== ENTITÀ E RELAZIONI (grafo, 1 hop) ===', n, CASE WHEN e IS NOT NULL THEN chr(10) || 'Relazioni:' || chr(10) || e END) AS context FROM chl LEFT JOIN nol USING (q_id) LEFT JOIN edl USING (q_id)""")
_history = lambda s, d: _read(s, d, "conversations").select(F.col("conv_id").alias("session"), "turn", "role", F.col("text").alias("content"))
_turns = lambda s, d: _read(s, d, "conversations").filter("turn = 0").select((F.col("conv_id") * 2).alias("session"), F.col("text").alias("question"), F.when(F.col("conv_id") % 3 == 0, "  ").otherwise(F.concat(F.lit(" ok "), "role")).alias("answer"))
query("session_commit", lambda s, d: answers.committed(_history(s, d), _turns(s, d)).groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("last"), F.max_by("content", "turn").alias("latest")), """
WITH h AS (SELECT conv_id AS session, turn, text AS content FROM conversations), l AS (SELECT session, max(turn) AS last FROM h GROUP BY 1),
t AS (SELECT conv_id * 2 AS session, text AS question, 'ok ' || role AS answer FROM conversations WHERE turn = 0 AND conv_id % 3 <> 0),
u AS (SELECT * FROM h UNION ALL SELECT t.session, coalesce(last, -1) + 1, question FROM t LEFT JOIN l USING (session) UNION ALL SELECT t.session, coalesce(last, -1) + 2, answer FROM t LEFT JOIN l USING (session))
SELECT session, count(*) AS n, max(turn) AS last, arg_max(content, turn) AS latest FROM u GROUP BY session""")
query("message_kind", lambda s, d: _read(s, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", answers.message_kind(F.col("n") - 2, F.when(F.col("conv_id") % 5 > 0, F.col("conv_id") % 2 == 0)).alias("kind")), "SELECT conv_id, CASE WHEN count(*) > 2 AND conv_id % 5 > 0 AND conv_id % 2 = 0 THEN 'follow-up' ELSE 'first' END AS kind FROM conversations GROUP BY conv_id")
query("neighbourhood", lambda s, d: answers.neighbourhood(s.createDataFrame([(1, "er_1"), (2, "ph_1")], "q_id int, id string"), edges(s, d).filter("type IN ('OCCURS_IN', 'DURING')").select(F.col("source_id").alias("source"), F.col("target_id").alias("target"))).groupBy("q_id", "depth").agg(F.count(F.lit(1)).alias("n")), """
WITH e AS (SELECT DISTINCT source_id AS a, target_id AS b FROM edge_occ WHERE type IN ('OCCURS_IN', 'DURING')), x AS (SELECT a, b FROM e UNION SELECT b, a FROM e), s AS (SELECT 1 AS q_id, 'er_1' AS id UNION ALL SELECT 2, 'ph_1'),
o AS (SELECT DISTINCT q_id, b AS id FROM s JOIN x ON a = id), t AS (SELECT DISTINCT q_id, b AS id FROM o JOIN x ON a = id), d AS (SELECT q_id, id, min(depth) AS depth FROM (SELECT *, 0 AS depth FROM s UNION ALL SELECT *, 1 FROM o UNION ALL SELECT *, 2 FROM t) GROUP BY q_id, id)
SELECT q_id, depth, count(*) AS n FROM d GROUP BY ALL""")


def _sizes(s: SparkSession, d: str) -> DataFrame:
    n = nodes(s, d)
    ranges = s.createDataFrame([(0, 2, 4), (2, 10, 8), (10, 100, 16)], "lo int, hi int, size int")
    return answers.size_class(graph.degrees(resolve.resolved_nodes(n), resolve.resolved_edges(n, edges(s, d))), ranges).groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum("degree").alias("degrees"))


query("size_classes", _sizes, _PAIRS + "SELECT CASE WHEN degree < 2 THEN 4 WHEN degree < 10 THEN 8 WHEN degree < 100 THEN 16 END AS size, count(*) AS n, CAST(sum(degree) AS BIGINT) AS degrees FROM deg GROUP BY 1")


def _document(s: SparkSession, d: str) -> DataFrame:
    """One nested row: counts by type, event quality and the verdict."""
    n, e = nodes(s, d), edges(s, d)
    counts = metrics.type_counts(n).agg(F.array_join(F.array_sort(F.collect_list(F.concat("type", F.lit("="), F.col("n").cast("string")))), ",").alias("types"))
    quality = metrics.event_quality(n, e).select(F.struct("n_events", "pct_place").alias("events"))
    found = metrics.verdict(metrics.checks(n, e)).select("verdict")
    return counts.crossJoin(F.broadcast(quality)).crossJoin(F.broadcast(found)).select("types", F.to_json("events").alias("events"), "verdict")  # one row each


_DOC = {k: _GRAPH[k] for k in ("type_counts", "event_quality", "verdict_table")}
ORACLES["metrics_document"] = f"""WITH t AS ({_DOC['type_counts']}), q AS ({_DOC['event_quality']}), v AS ({_DOC['verdict_table']})
SELECT (SELECT string_agg(type || '=' || n, ',' ORDER BY type) FROM t) AS types, (SELECT '{{"n_events":' || n_events || ',"pct_place":' || pct_place || '}}' FROM q) AS events, verdict FROM v"""
QUERIES["metrics_document"] = _document
