"""Queries that write files and read them again, and queries on what goes to a model and comes back, with oracle SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import drop, stage
from ..functions.text import truncate
from ..operators import dialogue, judging, metrics, resolve, segment, similar
from ..sources import files
from ..sources.adapter import edges, nodes, with_occurrences
from .graph_queries import ORACLES as _GRAPH
from .graph_queries import RESOLVED
from .retrieval_queries import _JUDGED, _judgments, _read
from .text_queries import ORACLES as _TEXT
from .text_queries import _CHUNKS, _PAIRS, _paragraphs, _segments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, function: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    QUERIES[name] = function
    if sql:
        ORACLES[name] = with_occurrences(sql) if "node_occ" in sql or "edge_occ" in sql else sql


# sinks and scans ----------------------------------------------------------------------------------------------------
def _json(sort_keys: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(s: SparkSession, d: str) -> DataFrame:
        path = files.fresh_path(s, "json")
        files.write_json(_read(s, d, "part").select("p_type", "p_name", F.struct("p_size", "p_brand").alias("more"), "p_partkey"), path, sort_keys)
        return s.read.text(path).select(F.col("value").alias("line"))

    return run


query("stable_json", _json(True), """SELECT '{"more":{"p_brand":"' || p_brand || '","p_size":' || p_size || '},"p_name":"' || p_name || '","p_partkey":' || p_partkey || ',"p_type":"' || p_type || '"}' AS line FROM part""")
query("ordered_json", _json(False), """SELECT '{"p_type":"' || p_type || '","p_name":"' || p_name || '","more":{"p_size":' || p_size || ',"p_brand":"' || p_brand || '"},"p_partkey":' || p_partkey || '}' AS line FROM part""")


def _atomic(s: SparkSession, d: str) -> DataFrame:
    """Written twice; the second table is what is left, and nothing beside it."""
    path = files.fresh_path(s, "atomic")
    files.write_atomic(_read(s, d, "part").select("p_partkey"), path)
    files.write_atomic(_read(s, d, "part").select("p_partkey", "p_name").filter("p_size > 10"), path)
    return s.read.parquet(path).withColumn("columns", F.lit(2))


query("atomic_sink", _atomic, "SELECT p_partkey, p_name, 2 AS columns FROM part WHERE p_size > 10")


def _text_sink(s: SparkSession, d: str) -> DataFrame:
    """Cleaned texts as files of text, their log as JSON."""
    path = files.fresh_path(s, "text")
    clean = segment.rule_fold(_read(s, d, "documents").filter("text IS NOT NULL"), [("blanks", "[ \t]+", " "), ("breaks", "\n", " ")])
    clean.select("clean").write.text(f"{path}/clean")
    files.write_json(clean.agg(F.sum("n_blanks").alias("n_blanks"), F.count(F.lit(1)).alias("n")), f"{path}/log", sort_keys=True)
    lines = s.read.text(f"{path}/clean").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))
    return lines.join(s.read.schema("n long, n_blanks long").json(f"{path}/log"))


query("text_sink", _text_sink, "SELECT count(*) AS n_lines, CAST(sum(length(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n', ' ', 'g'))) AS BIGINT) AS n_chars, count(*) AS n, CAST(sum(len(regexp_extract_all(text, '[ \t]+'))) AS BIGINT) AS n_blanks FROM documents WHERE text IS NOT NULL".replace("'\n'", "chr(10)"))


def _chunk_sink(s: SparkSession, d: str) -> DataFrame:
    """Chunks in a folder for each part; one part is read again."""
    path = files.fresh_path(s, "chunks")
    segment.chunks(_paragraphs(_read(s, d, "documents"))).withColumn("part_number", (F.col("page") % 6 + 1).cast("int")).write.partitionBy("part_number").parquet(path)
    return s.read.parquet(path).filter("part_number = 3").select("page", "chunk", "tokens", "part_number")


query("chunk_sink", _chunk_sink, f"WITH {_CHUNKS} SELECT page, chunk, tokens, 3 AS part_number FROM chk WHERE page % 6 = 2")


def _maps(s: SparkSession, d: str) -> DataFrame:
    """Merge decisions as automatic and to be reviewed, and split decisions, with their numbers."""
    path, n = files.fresh_path(s, "maps"), nodes(s, d)
    merges = resolve.merge_decisions(n).select(F.when(F.col("decision") == "auto", "auto").otherwise("to_review").alias("bucket"), "type", "norm", "ids", "canonical_id")
    merges.unionByName(resolve.split_map(n).select(F.lit("split").alias("bucket"), "type", F.col("new_id").alias("norm"), F.col("id").alias("ids"), F.lit(None).cast("string").alias("canonical_id"))).write.partitionBy("bucket").json(path)
    return s.read.schema("type string, norm string, ids string, canonical_id string, bucket string").json(path).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count("canonical_id").alias("n_decided"), F.min("ids").alias("first"))


query("decision_maps", _maps, RESOLVED + "SELECT CASE WHEN n_top = 1 AND groups = 1 THEN 'auto' ELSE 'to_review' END AS bucket, count(*) AS n, count(*) FILTER (n_top = 1 AND groups = 1) AS n_decided, min(ids) AS first FROM dec GROUP BY 1 UNION ALL SELECT 'split', count(*), 0, min(id) FROM spl")
_NODE, _EDGE = "id string, type string, name string, n_provenances long, merged_from string, n_names long, confidence double, n_chunks long", "edge_key string, source string, target string, type string, role string, n_provenances long, first_chunk string"


def _graph_sink(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, str]:
    """A resolved graph written and read again under declared schemas."""
    path, n = files.fresh_path(s, "graph"), stage(nodes(s, d), "occurrences")
    known = resolve.told(n)
    files.write_graph(resolve.resolved_nodes(n, known), resolve.resolved_edges(n, edges(s, d), known), resolve.proposals(known.names).groupBy().agg(F.array_sort(F.collect_list(F.struct("source_id", "target_id", "confidence"))).alias("proposals")), path)
    drop(n)
    return *files.read_graph(s, path, _NODE, _EDGE), path


def _types(s: SparkSession, d: str) -> DataFrame:
    n, e, _ = _graph_sink(s, d)
    return n.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("n_provenances").alias("n_provenances")).unionByName(e.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("n_provenances").alias("n_provenances")))


query("graph_sink", _types, RESOLVED + "SELECT type, count(*) AS n, CAST(sum(n_provenances) AS BIGINT) AS n_provenances FROM res GROUP BY 1 UNION ALL SELECT type, count(*), CAST(sum(n_provenances) AS BIGINT) FROM edg GROUP BY 1")
query("proposal_scan", lambda s, d: files.read_optional(s, f"{_graph_sink(s, d)[2]}/log", "proposals array<struct<source_id: string, target_id: string, confidence: double>>").select(F.explode("proposals").alias("p")).select("p.*"), RESOLVED + "SELECT max(new_id) FILTER (type <> 'Theme') AS source_id, max(new_id) FILTER (type = 'Theme') AS target_id, 0.5::DOUBLE AS confidence FROM spl GROUP BY id HAVING count(*) FILTER (type = 'Theme') > 0 AND count(*) FILTER (type <> 'Theme') > 0")
query("graph_store", lambda s, d: (lambda g: files.adjacency(g[0].filter("type <> 'Work'"), g[1]).groupBy("type", "reversed").agg(F.count(F.lit(1)).alias("n")))(_graph_sink(s, d)), RESOLVED + ", i AS (SELECT id FROM res WHERE type <> 'Work'), k AS (SELECT type FROM edg WHERE source IN (SELECT id FROM i) AND target IN (SELECT id FROM i)) SELECT type, unnest([true, false]) AS reversed, n FROM (SELECT type, count(*) AS n FROM k GROUP BY type)")


def _flat(s: SparkSession, d: str) -> DataFrame:
    """Nodes, edges and provenances as three tables."""
    path, n = files.fresh_path(s, "flat"), nodes(s, d)
    n.groupBy("id", "type").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/nodes")
    edges(s, d).groupBy("source_id", "target_id", "type").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/edges")
    resolve.flat_provenances(n).write.parquet(f"{path}/provenance")
    return s.createDataFrame([(k, s.read.parquet(f"{path}/{k}").count()) for k in ("nodes", "edges", "provenance")], "part string, n long")


query("flat_sink", _flat, "SELECT 'nodes' AS part, count(*) AS n FROM (SELECT DISTINCT id, type FROM node_occ) UNION ALL SELECT 'edges', count(*) FROM (SELECT DISTINCT source_id, target_id, type FROM edge_occ) UNION ALL SELECT 'provenance', count(*) FROM node_occ")


def _index(s: SparkSession, d: str) -> DataFrame:
    e = _read(s, d, "embeddings")
    return e.select(F.concat(F.lit("ch_"), F.col("vec_id").cast("string")).alias("chunk_id"), (F.col("label") + 1).alias("part"), F.concat(F.lit("text of "), F.col("vec_id").cast("string")).alias("text"), F.transform("embedding", lambda x: x.cast("double") * 3).alias("v"))


def _index_scan(s: SparkSession, d: str) -> DataFrame:
    path = files.fresh_path(s, "index")
    files.write_index(_index(s, d), path, "m")
    read = s.read.schema("chunk_id string, part int, text string, v array<float>").parquet(f"{path}/chunks")
    return read.select("chunk_id", "part", "text", F.size("v").alias("dims"), F.round(similar.dot(F.col("v"), F.col("v")), 4).alias("norm"))


def _manifest(s: SparkSession, d: str) -> DataFrame:
    """An index is fresh for its own chunks, and stale for others."""
    path = files.fresh_path(s, "index")
    files.write_index(_index(s, d), path, "m")
    told = files.read_optional(s, f"{path}/manifest", "model string, n long, digest string")
    nothing = files.read_optional(s, f"{path}/no-such-manifest", "model string, n long, digest string")
    now, later = files.manifest(_index(s, d), "m"), files.manifest(_index(s, d).withColumn("text", F.concat("text", F.lit("!"))), "m")
    return files.stale(told, now).unionByName(files.stale(told, later)).unionByName(files.stale(nothing, now))


query("index_scan", _index_scan, "SELECT 'ch_' || vec_id AS chunk_id, label + 1 AS part, 'text of ' || vec_id AS text, CAST(len(embedding) AS INTEGER) AS dims, 1.0::DOUBLE AS norm FROM embeddings")
query("manifest_freshness", _manifest, "SELECT 'm' AS model, count(*) AS n_indexed, count(*) AS n, unnest([false, true]) AS stale FROM embeddings")


def _gold(s: SparkSession, d: str) -> DataFrame:
    """Extractions in files of one and of many, joined into one table."""
    path, n = files.fresh_path(s, "gold"), nodes(s, d).filter("type IN ('Event', 'Phase')")
    one = n.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("id", "type"))).alias("nodes"))
    one.filter("chunk_id LIKE '%1'").write.json(f"{path}/one")
    one.filter("chunk_id NOT LIKE '%1'").groupBy(F.substring("chunk_id", -1, 1).alias("k")).agg(F.collect_list(F.struct("chunk_id", "nodes")).alias("extractions")).drop("k").write.json(f"{path}/many")
    read = files.read_envelopes(s, [f"{path}/one", f"{path}/many"], "chunk_id string, nodes array<struct<id: string, type: string>>")
    return read.select("chunk_id", F.explode("nodes").alias("x")).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"), F.min("x.id").alias("first"))


query("gold_join", _gold, "SELECT chunk_id, count(*) AS n, min(id) AS first FROM node_occ WHERE type IN ('Event', 'Phase') GROUP BY 1")


def _run_log(s: SparkSession, d: str) -> DataFrame:
    o = _read(s, d, "orders")
    found = o.select(F.col("o_orderkey").alias("run"), F.struct(F.lit("old").alias("model"), F.col("o_orderpriority").alias("mode")).alias("header"))
    return files.with_metadata(found, o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("run"), F.lit("new").alias("model"), F.lit(None).cast("string").alias("mode")), ["model", "mode"])


query("run_log_scan", _run_log, "SELECT o_orderkey AS run, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS model, o_orderpriority AS mode FROM orders")
query("theme_scan", lambda s, d: files.themes(nodes(s, d).groupBy("id", "type").agg(F.min("name").alias("name"), F.collect_list(F.struct("chunk_id", "confidence")).alias("provenances"))), "SELECT id, min(name) AS name, CAST(count(*) AS INTEGER) AS freq FROM node_occ WHERE type = 'Theme' GROUP BY id")


def _refinement_scan(s: SparkSession, d: str) -> DataFrame:
    path = files.fresh_path(s, "map")
    pairs = _judgments(_read(s, d, "embeddings")).filter("verdict = 'refinement'")
    files.write_json(pairs.agg(F.collect_list(F.struct(F.col("b").alias("specific"), F.col("a").alias("general"), "confidence")).alias("refinements")), path)
    kind = "refinements array<struct<specific: long, general: long, confidence: double>>"
    return files.read_optional(s, path, kind).select(F.explode("refinements").alias("x")).select("x.*").unionByName(files.read_optional(s, path + "-none", "specific long, general long, confidence double"))


query("refinement_scan", _refinement_scan, f"WITH {_JUDGED} SELECT b AS specific, a AS general, confidence FROM jud WHERE verdict = 'refinement'")
_RULES = """rules:
- id: blanks
  pattern: '[ ]+'
  replacement: ' '
  enabled: true
- id: off
  pattern: ''
  replacement: x
  enabled: false
- id: empty
  pattern: ''
  replacement: x
  enabled: true
- id: twice
  pattern: a
  replacement: b
  enabled: true
- id: twice
  pattern: c
  replacement: d
  enabled: false
- id: short
  pattern: e
"""


def _rule_scan(s: SparkSession, d: str) -> DataFrame:
    path = files.fresh_path(s, "rules")
    s.createDataFrame([(i, x) for i, x in enumerate(_RULES.split("\n"))], "no int, line string").select(F.format_string("%05d %s", "no", "line").alias("value")).write.text(path)
    lines = s.read.text(path).select(F.substring("value", 1, 5).cast("int").alias("no"), F.substring("value", 7, 1_000).alias("line"))
    return files.rule_table(lines)


query("rule_scan", _rule_scan, "SELECT * FROM (VALUES ('blanks', '[ ]+', ' ', true, NULL), ('off', '', 'x', false, NULL), ('empty', '', 'x', true, 'empty pattern'), ('twice', 'a', 'b', true, 'repeated id'), ('twice', 'c', 'd', false, 'repeated id'), ('short', 'e', NULL, NULL, 'missing field')) t(id, pattern, replacement, enabled, problem)")


def _listed(s: SparkSession, d: str) -> DataFrame:
    """Files of one suffix among those of a folder."""
    path = files.fresh_path(s, "listed")
    for suffix in ("WAV", "txt"):
        s.range(3).select(F.col("id").cast("string").alias("value")).coalesce(1).write.text(f"{path}/{suffix}")
    hadoop = s.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
    for i in range(2):
        out = fs.create(hadoop.Path(f"{path}/b/x{i}.MP3"))
        out.writeByte(1)
        out.close()
    return files.files_of(s, path, ["mp3", ".wav"])


query("audio_listing", _listed, "SELECT * FROM (VALUES ('x0.MP3', 'mp3'), ('x1.MP3', 'mp3')) t(name, suffix)")


def _dialogue_sink(s: SparkSession, d: str) -> DataFrame:
    c = _segments(_read(s, d, "conversations"))
    turns = dialogue.turns(c, dialogue.speakers(c, ["Ann", "Bob", "Cy"]))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("**"), "label", F.lit("**: "), "text").alias("md")))), lambda x: x["md"]), "\n\n")
    path = files.fresh_path(s, "dialogue")
    turns.groupBy("conv").agg(lines.alias("md")).select("conv", F.concat(F.lit("# conversation "), F.col("conv").cast("string"), F.lit("\n\n"), "md").alias("md")).write.parquet(path)
    return s.read.parquet(path).select("conv", F.md5("md").alias("md"), F.md5(judging.recap(F.col("md"), F.lit("  short "))).alias("recap"))


query("dialogue_sink", _dialogue_sink, f"WITH t AS ({_TEXT['turn_merge']}), m AS (SELECT conv, '# conversation ' || conv || chr(10) || chr(10) || string_agg('**' || label || '**: ' || text, chr(10) || chr(10) ORDER BY turn) AS md FROM t GROUP BY conv) SELECT conv, md5(md) AS md, md5('# conversation ' || conv || chr(10) || chr(10) || 'short') AS recap FROM m")
query("retrieval_log", lambda s, d: (lambda p: (files.write_json(_read(s, d, "conversations").filter("role = 'user'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("questions")), p, True), s.read.schema("conv_id long, questions array<struct<text: string, turn: long>>").json(p).select("conv_id", F.size("questions").alias("n"), F.element_at("questions", 1)["text"].alias("first")))[1])(files.fresh_path(s, "log")), "SELECT conv_id, CAST(count(*) AS INTEGER) AS n, arg_min(text, (turn, text)) AS first FROM conversations WHERE role = 'user' GROUP BY conv_id")
query("upsert_statement", lambda s, d: nodes(s, d).select("type").distinct().select("type", files.upsert_statement(F.col("type")).alias("statement")), "SELECT DISTINCT type, 'MERGE (n:Node {id: $id}) SET n:' || type || ', n += $props' AS statement FROM node_occ")
query("dashboard_html", lambda s, d: files.html_table(metrics.checks(nodes(s, d), edges(s, d)).withColumn("value", F.round("value", 2).cast("decimal(20,2)")), "status", "Checks <3>"), f"""WITH c AS ({_GRAPH['stage_checks']}), l AS (SELECT status, '<tr><td>' || "check" || '</td><td>' || coalesce(CAST(CAST(round(value, 2) AS DECIMAL(20,2)) AS VARCHAR), '') || '</td></tr>' AS line FROM c)
SELECT status, '<!DOCTYPE html><html><head><meta charset=utf-8><title>Checks <3></title></head><body><h1>Checks <3></h1><table><tr><th>check</th><th>value</th></tr>' || string_agg(line, '' ORDER BY line) || '</table></body></html>' AS html FROM l GROUP BY status""")
query("chart_report", lambda s, d: files.html_table(nodes(s, d).groupBy("type", "confidence").agg(F.count(F.lit(1)).alias("n")).select("type", F.round(F.col("confidence") * 100).cast("int").alias("pct"), "n").groupBy("type", "pct").agg(F.sum("n").alias("n")), "type", "Confidence"), """WITH c AS (SELECT type, CAST(round(confidence * 100) AS INTEGER) AS pct, count(*) AS n FROM node_occ GROUP BY 1, 2), l AS (SELECT type, '<tr><td>' || pct || '</td><td>' || n || '</td></tr>' AS line FROM c)
SELECT type, '<!DOCTYPE html><html><head><meta charset=utf-8><title>Confidence</title></head><body><h1>Confidence</h1><table><tr><th>pct</th><th>n</th></tr>' || string_agg(line, '' ORDER BY line) || '</table></body></html>' AS html FROM l GROUP BY type""")

# to a model and back ------------------------------------------------------------------------------------------------
_chunks = lambda s, d: _read(s, d, "benchmark").select(F.concat(F.lit("ch_"), F.col("item_id").cast("string")).alias("chunk_id"), F.regexp_replace("text", r"[^A-Za-z ]", " ").alias("text"))
query("request_payload", lambda s, d: judging.requests(_chunks(s, d), "m", "Read.", 100), """SELECT 'ch_' || item_id AS chunk_id, '{"model":"m","max_tokens":100,"system":"Read.","messages":[{"role":"user","content":"chunk_id: ch_' || item_id || '\\n\\nchunk_text:\\n' || regexp_replace(text, '[^A-Za-z ]', ' ', 'g') || '"}]}' AS body FROM benchmark""")
query("tool_schema", lambda s, d: s.createDataFrame([(json.dumps(judging.tool_schema()),)], "j string").select(F.size(F.from_json(F.get_json_object("j", "$.properties.nodes.items.properties.type.enum"), "array<string>")).alias("n_nodes"), F.size(F.from_json(F.get_json_object("j", "$.properties.edges.items.properties.type.enum"), "array<string>")).alias("n_edges"), F.get_json_object("j", "$.required").alias("required")), "SELECT 8 AS n_nodes, 14 AS n_edges, '[\"nodes\",\"edges\"]' AS required")
query("chat_messages", lambda s, d: _read(s, d, "conversations").filter("turn < 3").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("h")).select("conv_id", F.size(judging.chat_messages("Be brief.", F.transform("h", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))), F.lit("Why?"))).alias("n"), F.to_json(F.element_at(judging.chat_messages("Be brief.", F.lit(None), F.lit("Why?")), -1)).alias("last")), """SELECT conv_id, CAST(count(*) + 2 AS INTEGER) AS n, '{"role":"user","content":"Why?"}' AS last FROM conversations WHERE turn < 3 GROUP BY conv_id""")
query("pair_keys", lambda s, d: _judgments(_read(s, d, "embeddings")).select("a", "b", judging.pair_key(F.col("b").cast("string"), F.col("a").cast("string"), F.lit("m")).alias("free"), judging.pair_key(F.col("b").cast("string"), F.col("a").cast("string"), ordered=True).alias("ordered")), f"WITH {_JUDGED} SELECT a, b, sha1(least(a::VARCHAR, b::VARCHAR) || '|' || greatest(a::VARCHAR, b::VARCHAR) || '|m') AS free, sha1(b || '->' || a) AS ordered FROM jud")
query("cluster_keys", lambda s, d: judging.cluster_key(_read(s, d, "part").select("p_brand", F.col("p_partkey").alias("id")).withColumnRenamed("p_brand", "cluster"), "m", "v1"), "SELECT p_brand AS cluster, sha1(string_agg(DISTINCT p_partkey::VARCHAR, ',' ORDER BY p_partkey::VARCHAR) || '|m|v1') AS key FROM part GROUP BY 1")
query("batch_collect", lambda s, d: judging.collected(_read(s, d, "orders").select(F.col("o_orderkey").alias("place"), F.concat(F.lit("ch_"), F.col("o_orderkey").cast("string")).alias("chunk_id")), _read(s, d, "lineitem").filter("l_linenumber = 2").select(F.concat(F.lit("ch_"), F.col("l_orderkey").cast("string")).alias("chunk_id"), F.when(F.col("l_returnflag") == "R", "errored").otherwise("succeeded").alias("type"), F.col("l_linestatus").alias("reply"))), "WITH r AS (SELECT 'ch_' || l_orderkey AS chunk_id, max((CASE WHEN l_returnflag = 'R' THEN 'errored' ELSE 'succeeded' END, l_linestatus)) AS x FROM lineitem WHERE l_linenumber = 2 GROUP BY 1) SELECT o_orderkey AS place, 'ch_' || o_orderkey AS chunk_id, coalesce(x[1], 'missing') AS status, x[2] AS reply FROM orders LEFT JOIN r ON r.chunk_id = 'ch_' || o_orderkey")
_reply = lambda: F.when(F.col("event_id") % 4 == 0, "no idea").when(F.col("event_id") % 4 == 1, 'So: {"nodes": [], "edges": []}').when(F.col("event_id") % 4 == 2, '{"nodes": []}').otherwise('<think>{"nodes": 1}</think>{"nodes": [{"id": "a", "type": "Person", "name": "A"}], "edges": "[]"}')
query("reply_status", lambda s, d: _read(s, d, "events").select("event_id", judging.reply_status(_reply()).alias("status"), F.size(judging.normalised(F.regexp_extract(_reply(), r"(\{.nodes.: \[.*\})$", 1))["nodes"]).alias("n")).fillna(-1), "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'no_tool_use' WHEN 1 THEN 'ok' WHEN 2 THEN 'validation_error' ELSE 'validation_error' END AS status, CASE event_id % 4 WHEN 1 THEN 0 WHEN 3 THEN 1 ELSE -1 END AS n FROM events")
query("resolved_coherence", lambda s, d: judging.incoherent(resolve.resolved_nodes(nodes(s, d), chunks=False).select("id", "n_provenances", F.when(F.contains("merged_from", F.lit(",")), F.when(F.col("n_provenances") % 2 == 0, "exact").otherwise("none")).otherwise("none").alias("merge_method"), F.size(F.split("merged_from", ",")).alias("n_merged"), (F.col("n_names") > 1).alias("review_needed"), F.when(F.col("n_provenances") > 30, "names differ").alias("review_reason"))), RESOLVED + "SELECT id, CASE WHEN contains(merged_from, ',') AND n_provenances % 2 = 1 THEN 'merged without a method' ELSE 'review without a reason' END AS problem FROM res WHERE (contains(merged_from, ',') AND n_provenances % 2 = 1) OR (n_names > 1 AND n_provenances <= 30)")
query("edge_coherence", lambda s, d: judging.incoherent(resolve.resolved_edges(stage(nodes(s, d), "occurrences"), edges(s, d)).select(F.col("edge_key").alias("id"), (F.col("n_provenances") - 1).alias("n_provenances"), F.lit("none").alias("merge_method"), F.lit(1).alias("n_merged"), F.lit(False).alias("review_needed"), F.lit("").alias("review_reason"))), RESOLVED + "SELECT concat_ws('|', source, type, target, role) AS id, 'no provenance' AS problem FROM edg WHERE n_provenances = 1")
query("global_graph", lambda s, d: judging.global_nodes(nodes(s, d).filter("type <> 'Place'"), edges(s, d)), "WITH f AS (SELECT id, arg_min(type, (pos, type, name)) AS type, arg_min(name, (pos, type, name)) AS name FROM node_occ WHERE type <> 'Place' GROUP BY id), e AS (SELECT DISTINCT unnest([source_id, target_id]) AS id FROM edge_occ) SELECT * FROM f UNION ALL SELECT id, 'Unknown', id FROM e WHERE id NOT IN (SELECT id FROM f)")
query("segment_reassign", lambda s, d: judging.reassigned(_read(s, d, "events").select(F.col("event_id").alias("seg"), F.lit(0.0).alias("start"), (F.col("event_id") % 12 / 10).alias("end"), F.col("event_type").alias("label"), F.when(F.col("event_id") % 9 > 0, "view").alias("best"), (F.col("event_id") % 7 / 25).alias("lead"))), "WITH x AS (SELECT event_id AS seg, event_type, event_id % 9 > 0 AND (event_id % 7)::DOUBLE / 25 >= 0.1::DOUBLE AND (event_id % 12)::DOUBLE / 10 >= 0.7::DOUBLE AND event_type <> 'view' AS moved FROM events) SELECT seg, CASE WHEN moved THEN 'view' ELSE event_type END AS label, moved FROM x")
query("enrolment_profiles", lambda s, d: judging.profiles(_read(s, d, "embeddings").select("label", F.col("embedding").alias("v"))), _TEXT["centroids"].replace("SELECT cluster, d, round", "SELECT cluster AS label, d, round"))
query("audio_slices", lambda s, d: _read(s, d, "embeddings").select("vec_id", F.size(judging.audio_slice(F.col("embedding"), 10, F.col("vec_id") % 9 - 1.0, F.col("vec_id") % 9 - 0.55)).alias("n")), "SELECT vec_id, CAST(greatest(least(floor((vec_id % 9 - 0.55::DOUBLE) * 10), len(embedding)) - greatest((vec_id % 9 - 1) * 10, 0), 0) AS INTEGER) AS n FROM embeddings")
query("speaker_relabel", lambda s, d: _read(s, d, "conversations").select("conv_id", "turn", F.to_json(judging.with_speaker(F.array(F.struct(F.lit("a").alias("w"), F.col("role").alias("speaker")), F.struct(F.lit("b").alias("w"), F.lit(None).cast("string").alias("speaker"))), F.lit("Ann"))).alias("words"), F.array_join(judging.ingest_command(F.concat(F.lit("in/"), F.col("conv_id").cast("string")), F.lit("out.wav")), " ").alias("command")), """SELECT conv_id, turn, '[{"w":"a","speaker":"Ann"},{"w":"b"}]' AS words, 'ffmpeg -y -i in/' || conv_id || ' -ac 1 -ar 16000 out.wav' AS command FROM conversations""")


def _word_boxes(s: SparkSession, d: str) -> DataFrame:
    """Words of documents on lines ten apart, some of them a little higher or lower."""
    w = _read(s, d, "documents").filter("text IS NOT NULL").select(F.col("doc_id").alias("page"), F.posexplode(F.split(F.substring(F.md5("text"), 1, 32), "")).alias("i", "text")).filter("text <> ''")
    return w.select("page", (F.floor(F.col("i") / 8) * 10 + F.col("i") % 3 - 1.0).cast("double").alias("top"), ((F.col("i") * 5) % 8 * 7.0).cast("double").alias("x0"), "text")


query("visual_lines", lambda s, d: judging.visual_lines(_word_boxes(s, d)), "WITH w AS (SELECT doc_id AS page, unnest(range(32)) AS i, unnest(string_split(substr(md5(text), 1, 32), '')) AS t FROM documents WHERE text IS NOT NULL) SELECT page, CAST(i // 8 AS INTEGER) AS line_no, string_agg(t, ' ' ORDER BY (i * 5) % 8) AS text, 0.0::DOUBLE AS x0 FROM w GROUP BY page, i // 8")
query("top_cosines", lambda s, d: judging.top_cosines(similar.cosine_pairs(_read(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 8, 0.3), {"p50": 0.5, "p90": 0.9, "p99": 0.99}), f"WITH {_PAIRS}, b AS (SELECT id, max(cosine) AS c FROM (SELECT unnest([id_a, id_b]) AS id, cosine FROM cos) GROUP BY id) SELECT count(*) AS n, round(quantile_cont(c, 0.5), 6) AS p50, round(quantile_cont(c, 0.9), 6) AS p90, round(quantile_cont(c, 0.99), 6) AS p99 FROM b")


def _stipple(s: SparkSession, d: str) -> DataFrame:
    e = _read(s, d, "events")
    pixels = e.select((F.col("event_id") % 37).cast("double").alias("x"), (F.col("user_id") % 23).cast("double").alias("y"), (F.col("event_id") % 5 + 1).cast("double").alias("w"))
    points = s.createDataFrame([(0, 5.0, 5.0), (1, 30.0, 4.0), (2, 17.0, 18.0), (3, 900.0, 900.0)], "id int, x double, y double")
    return judging.lloyd(points, pixels, 2).select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_ROUND = "SELECT q.id, coalesce(nx, q.x) AS x, coalesce(ny, q.y) AS y FROM {p} q LEFT JOIN (SELECT nea, sum(x * w) / sum(w) AS nx, sum(y * w) / sum(w) AS ny FROM (SELECT pix.*, (SELECT arg_max(k.id, (2 * pix.x * k.x + 2 * pix.y * k.y - k.x * k.x - k.y * k.y, -k.id)) FROM {p} k) AS nea FROM pix) GROUP BY nea) m ON m.nea = q.id"
query("lloyd_points", _stipple, f"WITH pix AS MATERIALIZED (SELECT (event_id % 37)::DOUBLE AS x, (user_id % 23)::DOUBLE AS y, (event_id % 5 + 1)::DOUBLE AS w FROM events), p0 AS (SELECT * FROM (VALUES (0, 5.0::DOUBLE, 5.0::DOUBLE), (1, 30.0, 4.0), (2, 17.0, 18.0), (3, 900.0, 900.0)) t(id, x, y)), p1 AS MATERIALIZED ({_ROUND.format(p='p0')}), p2 AS ({_ROUND.format(p='p1')}) SELECT id, round(x, 6) AS x, round(y, 6) AS y FROM p2")
query("token_count", lambda s, d: _read(s, d, "documents").select("doc_id", judging.token_count(F.col("text")).alias("n"), truncate(F.col("text"), 100).alias("preview")).drop("preview"), r"SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]')), 0) AS INTEGER) AS n FROM documents")
