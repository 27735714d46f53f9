"""Queries over documents, conversations and embeddings, with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import dialogue, segment, similar

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, function: Callable[[DataFrame], DataFrame], sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: function(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    if sql:
        ORACLES[name] = sql


query("norm_header_footer", "documents", lambda d: d.select("doc_id", F.md5(t.collapse(F.col("text"))).alias("norm")), r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS norm FROM documents")
_lig = lambda: F.concat(F.col("text"), F.lit(" ofﬁce ﬂy aﬄict​"))
query("char_normalise", "documents", lambda d: d.select("doc_id", F.md5(t.normalise_characters(_lig())).alias("clean"), t.ligatures(_lig()).alias("n")), "SELECT doc_id, md5(text || ' office fly afflict') AS clean, 3 AS n FROM documents")
query("dehyphenate", "documents", lambda d: d.select("doc_id", F.length(t.dehyphenate(F.replace(F.col("text"), F.lit(".\n"), F.lit("-\n")))).alias("n"), t.broken_words(F.replace(F.col("text"), F.lit(".\n"), F.lit("-\n"))).alias("n_joined")), r"""
WITH l AS (SELECT doc_id, unnest(range(len(x))) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(replace(text, '.' || chr(10), '-' || chr(10)), chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM l),
k AS (SELECT *, next IS NOT NULL AND regexp_matches(line, '[\p{L}\p{N}]-[ \t]*$') AND regexp_matches(next, '^[ \t]*[\p{L}\p{N}_]') AS hit FROM n)
SELECT doc_id, CAST(sum(length(line)) + count(*) - 1 - coalesce(sum(length(regexp_extract(line, '-[ \t]*$')) + 1 + length(regexp_extract(next, '^[ \t]*'))) FILTER (hit), 0) AS INTEGER) AS n, CAST(count(*) FILTER (hit) AS INTEGER) AS n_joined FROM k GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE text IS NULL""")
_RULES = [("blanks", "[ \t]+", " "), ("signs", "[*#%&$]+", ""), ("shout", "!!+", "!"), ("numbers", "[0-9]{3,}", "<n>")]
query("rule_fold", "documents", lambda d: segment.rule_fold(d, _RULES).select("doc_id", *[f"n_{r[0]}" for r in _RULES], F.md5("clean").alias("clean")),
      "WITH a AS (SELECT doc_id, text AS t0 FROM documents), " + ", ".join(f"{'bcde'[i]} AS (SELECT *, CAST(len(regexp_extract_all(t{i}, '{p}')) AS INTEGER) AS n_{n}, regexp_replace(t{i}, '{p}', '{r}', 'g') AS t{i + 1} FROM {'abcd'[i]})" for i, (n, p, r) in enumerate(_RULES)) + " SELECT doc_id, n_blanks, n_signs, n_shout, n_numbers, md5(t4) AS clean FROM e")
query("inspect_digit_in_word", "documents", lambda d: d.select("doc_id", t.digit_words(F.col("text")).alias("n")), "SELECT doc_id, CAST(len(list_filter(regexp_extract_all(text, '[A-Za-z0-9_]*[0-9]+[A-Za-z0-9_]*'), lambda x: NOT regexp_full_match(x, '[0-9]+'))) AS INTEGER) AS n FROM documents")
query("inspect_lonely_digits", "documents", lambda d: d.select("doc_id", t.lonely_digits(F.col("text")).alias("n")), r"SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\s'), lambda x: regexp_full_match(x, '[0-9]{1,3}'))) AS INTEGER) AS n FROM documents")
_ALLOWED = "a-zA-Z0-9 \\n.,;:!?()'\"-"
query("inspect_rare_chars", "documents", lambda d: d.select(F.explode(F.split(F.regexp_replace("text", f"[{_ALLOWED}]", ""), "")).alias("char")).filter("char <> ''").groupBy("char").agg(F.count(F.lit(1)).alias("n")), f"SELECT char, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(text, '[{_ALLOWED.replace(chr(39), chr(39) * 2)}]', '', 'g'), '')) AS char FROM documents) WHERE char <> '' GROUP BY char")
query("inspect_repeat_punct", "documents", lambda d: d.select("doc_id", t.repeated_signs(F.col("text")).alias("n")), r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\.{3,}|,{3,}|;{3,}|:{3,}|!{3,}|\?{3,}|…{3,}')) AS INTEGER) AS n FROM documents")
query("inspect_isolated_caps", "documents", lambda d: d.select("doc_id", t.isolated_capitals(F.col("text")).alias("n")), r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[a-zà-ÿ][A-ZÀ-Þ][\s.,;:!?]')) AS INTEGER) AS n FROM documents")
query("name_normalise", "customer", lambda d: d.select("c_custkey", t.name_norm(F.concat(F.lit("  "), "c_name", F.lit("  of "), "c_mktsegment")).alias("norm")), r"SELECT c_custkey, lower(trim(regexp_replace('  ' || c_name || '  of ' || c_mktsegment, '\s+', ' ', 'g'))) AS norm FROM customer")
query("slugify", "part", lambda d: d.select("p_partkey", t.slug(F.concat(F.lit("È "), "p_name", F.lit(" / "), "p_type")).alias("slug")), "SELECT p_partkey, trim(regexp_replace(lower('E ' || p_name || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part")
query("truncate", "documents", lambda d: d.select("doc_id", t.truncate(F.col("text"), 100).alias("short")), r"WITH a AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM documents) SELECT doc_id, CASE WHEN length(f) > 100 THEN rtrim(substr(f, 1, 99)) || '…' ELSE f END AS short FROM a")
query("strip_thinking", "conversations", lambda d: d.select("conv_id", "turn", t.strip_thinking(F.concat(F.lit("<think>a\nb</think>"), "text", F.when(F.col("turn") % 2 == 0, " <think>open").otherwise(""))).alias("said")), "SELECT conv_id, turn, trim(text) AS said FROM conversations")
query("reply_json", "events", lambda d: d.select("event_id", t.reply_json(F.concat(F.lit("Sure: <think>{</think>"), "props", F.lit(" done"))).alias("body")), "SELECT event_id, props AS body FROM events")
query("clock", "events", lambda d: d.select("event_id", t.clock(F.col("value") * 50).alias("at"), t.duration(F.col("value") * 50).alias("took")),
      "WITH a AS (SELECT event_id, value * 50 AS v, greatest(CAST(round(value * 50) AS BIGINT), 0) AS r, CAST(floor(value * 50) AS BIGINT) AS f FROM events) SELECT event_id, CASE WHEN r >= 3600 THEN format('{:d}:{:02d}:{:02d}', r // 3600, r % 3600 // 60, r % 60) ELSE format('{:02d}:{:02d}', r // 60, r % 60) END AS at, CASE WHEN v < 60 THEN format('{:.1f}s', v) WHEN f >= 3600 THEN format('{:d}h {:02d}m {:02d}s', f // 3600, f % 3600 // 60, f % 60) ELSE format('{:d}m {:02d}s', f // 60, f % 60) END AS took FROM a")
query("context", "documents", lambda d: d.select("doc_id", F.locate(".", "text").alias("p"), t.context(F.col("text"), F.locate(".", "text") - 1, F.locate(".", "text")).alias("around")), "SELECT doc_id, CAST(strpos(text, '.') AS INTEGER) AS p, substr(text, CAST(greatest(strpos(text, '.') - 41, 0) AS BIGINT) + 1, CAST(strpos(text, '.') + 40 - greatest(strpos(text, '.') - 41, 0) AS BIGINT)) AS around FROM documents")

_LINES = "lin AS (SELECT doc_id AS page, CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS text FROM documents WHERE text IS NOT NULL)"
_NORM = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
_EDGES = f"edg AS (SELECT edge, norm, count(*) AS n FROM (SELECT 'header' AS edge, {_NORM} AS norm FROM lin WHERE line_no = 0 UNION ALL SELECT 'footer', {_NORM} FROM lin l WHERE line_no = (SELECT max(line_no) FROM lin m WHERE m.page = l.page)) WHERE norm <> '' GROUP BY ALL HAVING count(*) >= floor((SELECT count(DISTINCT page) FROM lin) * 0.001) + 1)"
query("lines", "documents", lambda d: segment.lines(d).groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")), f"WITH {_LINES} SELECT page, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM lin GROUP BY page")
query("recurring_header_footer", "documents", lambda d: segment.recurring_edges(d, 0.001), f"WITH {_LINES}, {_EDGES} SELECT * FROM edg")
query("strip_header_footer", "documents", lambda d: segment.without_edges(segment.lines(d), segment.recurring_edges(d, 0.001)).groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first"), F.max("line_no").alias("last")),
      f"WITH {_LINES}, {_EDGES}, m AS (SELECT *, {_NORM} IN (SELECT norm FROM edg WHERE edge = 'header') AS h, {_NORM} IN (SELECT norm FROM edg WHERE edge = 'footer') AS f FROM lin), w AS (SELECT *, min(line_no) FILTER (NOT h) OVER (PARTITION BY page) AS a, max(line_no) FILTER (NOT f) OVER (PARTITION BY page) AS b FROM m) SELECT page, count(*) AS n, min(line_no) AS first, max(line_no) AS last FROM w WHERE line_no BETWEEN a AND b GROUP BY page")
_PARAGRAPHS = _LINES + r""", pos AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY page ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM lin),
par AS (SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY line_no) - 1 AS INTEGER) AS i, CAST(start AS BIGINT) AS start, CAST(start + length(trim(text)) AS BIGINT) AS stop, CAST(len(string_split_regex(trim(text), '\s+')) AS INTEGER) AS tokens FROM pos WHERE trim(text) <> '')"""
# the oracle folds over each page, as the operator's closed form must equal
_CHUNKS = _PARAGRAPHS.replace("lin AS", "RECURSIVE lin AS", 1) + """, n AS (SELECT page, count(*) AS k FROM par GROUP BY page),
fold AS (SELECT page, i, tokens < 40 AS waits, 1 AS chunk FROM par WHERE i = 0
  UNION ALL SELECT p.page, p.i, CASE WHEN f.waits THEN false WHEN p.i = n.k - 1 AND p.tokens < 40 THEN false ELSE p.tokens < 40 END,
    CASE WHEN f.waits OR (p.i = n.k - 1 AND p.tokens < 40) THEN f.chunk ELSE f.chunk + 1 END
  FROM fold f JOIN par p ON p.page = f.page AND p.i = f.i + 1 JOIN n ON n.page = p.page),
chk AS (SELECT page, CAST(chunk AS BIGINT) AS chunk, min(p.i) AS first, max(p.i) AS last, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS n, min(start) AS char_start, max(stop) AS char_end, count(*) > 1 AS merged FROM fold f JOIN par p USING (page, i) GROUP BY page, chunk)"""
_paragraphs = lambda d: segment.paragraphs(segment.lines(d), 40)
query("paragraph_offsets", "documents", lambda d: _paragraphs(d).select("page", "i", "start", "stop", "tokens"), f"WITH {_PARAGRAPHS} SELECT page, i, start, stop, tokens FROM par")
query("chunk_merge", "documents", lambda d: segment.chunks(_paragraphs(d)), f"WITH {_CHUNKS} SELECT * FROM chk")
query("chunk_number", "documents", lambda d: segment.chunk_ids(segment.chunks(_paragraphs(d))), f"WITH {_CHUNKS} SELECT 'ch_' || lpad(CAST(row_number() OVER (ORDER BY page, chunk) AS VARCHAR), 6, '0') AS chunk_id, page, chunk, tokens, merged FROM chk")
query("token_stats", "documents", lambda d: segment.token_stats(segment.chunks(_paragraphs(d))), f"WITH {_CHUNKS}, s AS (SELECT list_sort(list(tokens)) AS v, count(*) AS n FROM chk) SELECT v[1] AS least, v[n] AS max, (SELECT round(avg(tokens), 6) FROM chk) AS mean, (SELECT median(tokens) FROM chk) AS median, v[CAST(ceil(n * 95 / 100) AS BIGINT)] AS p95 FROM s")
query("part_assign", "documents", lambda d: segment.assigned(_paragraphs(d), d.sparkSession.createDataFrame([(1, 0, 100), (2, 100, 1000), (3, 1000, 10**9)], "number int, lo long, hi long"), F.col("start")).groupBy("page", "number").agg(F.count(F.lit(1)).alias("n")), f"WITH {_PARAGRAPHS} SELECT page, CASE WHEN start < 100 THEN 1 WHEN start < 1000 THEN 2 ELSE 3 END AS number, count(*) AS n FROM par GROUP BY ALL")
query("blank_runs", "documents", lambda d: segment.blank_runs(segment.lines(d.withColumn("text", F.replace("text", F.lit(".\n"), F.lit(".\n\n\n\n"))))), f"WITH {_LINES.replace('string_split(text, chr(10))', 'string_split(replace(text, chr(46) || chr(10), chr(46) || chr(10) || chr(10) || chr(10) || chr(10)), chr(10))')}, b AS (SELECT page, line_no, line_no - row_number() OVER (PARTITION BY page ORDER BY line_no) AS g FROM lin WHERE trim(text) = '') SELECT page, min(line_no) AS first, count(*) AS n FROM b GROUP BY page, g HAVING count(*) >= 3")
query("export_lines", "documents", lambda d: segment.lines(d).groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n").alias("text")).join(d.select(F.col("doc_id").alias("page"), F.col("text").alias("was")), "page").agg(F.count_if(F.col("text") != F.col("was")).alias("n_changed"), F.count(F.lit(1)).alias("n")), "SELECT CAST(0 AS BIGINT) AS n_changed, count(*) AS n FROM documents WHERE text IS NOT NULL")

_segments = lambda c: c.select(F.col("conv_id").alias("conv"), F.col("turn").alias("pos"), F.when(F.col("turn") % 5 == 4, F.lit(None)).otherwise(F.concat("role", (F.col("turn") % 3 == 0).cast("string"))).alias("speaker"), "text")
_LABELS = ["Ann", "Bob", "Cy"]
_SEGMENTS = "seg AS (SELECT conv_id AS conv, turn AS pos, CASE WHEN turn % 5 = 4 THEN NULL ELSE role || CAST(turn % 3 = 0 AS VARCHAR) END AS speaker, text FROM conversations), fst AS (SELECT conv, speaker, min(pos) AS first FROM seg WHERE speaker IS NOT NULL GROUP BY ALL), nam AS (SELECT conv, speaker, coalesce(['Ann', 'Bob', 'Cy'][row_number() OVER (PARTITION BY conv ORDER BY first)], 'S' || CAST(row_number() OVER (PARTITION BY conv ORDER BY first) AS VARCHAR)) AS label FROM fst)"
query("speaker_map", "conversations", lambda c: dialogue.speakers(_segments(c), _LABELS), f"WITH {_SEGMENTS} SELECT * FROM nam")
query("turn_merge", "conversations", lambda c: dialogue.turns(_segments(c), dialogue.speakers(_segments(c), _LABELS)),
      f"WITH {_SEGMENTS}, s AS (SELECT conv, pos, trim(text) AS text, coalesce(label, '?') AS label FROM seg LEFT JOIN nam USING (conv, speaker) WHERE trim(text) <> ''), m AS (SELECT *, CASE WHEN lag(label) OVER (PARTITION BY conv ORDER BY pos) = label THEN 0 ELSE 1 END AS new FROM s), k AS (SELECT *, CAST(sum(new) OVER (PARTITION BY conv ORDER BY pos) AS BIGINT) AS turn FROM m) SELECT conv, turn, min(label) AS label, min(pos) AS start, max(pos) AS \"end\", count(*) AS parts, string_agg(text, ' ' ORDER BY pos) AS text FROM k GROUP BY conv, turn")
_HINTS = " OR ".join(f"contains(p, '{h}')" for h in dialogue.FOLLOW_UP)
query("followup_query", "conversations", dialogue.expanded, rf"WITH a AS (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations WHERE role = 'user'), f AS (SELECT *, ' ' || lower(text) || ' ' AS p FROM a), g AS (SELECT *, b IS NOT NULL AND ({_HINTS} OR len(list_filter(string_split_regex(trim(text), '\s+'), lambda w: w <> '')) <= 5) AS follow_up FROM f) SELECT conv_id, turn, follow_up, CASE WHEN follow_up THEN trim(b) || ' — ' || trim(text) ELSE text END AS query FROM g")


def _words(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every event is a word and a window of its user."""
    words = e.select(F.col("user_id").alias("conv"), F.col("event_id").alias("word_id"), (F.col("event_id") % 1000 * 0.5).alias("start"), (F.col("event_id") % 1000 * 0.5 + 0.4).alias("end"))
    windows = e.select(F.col("user_id").alias("conv"), (F.col("event_id") % 500 * 1.0).alias("w_start"), (F.col("event_id") % 500 + 2.0).alias("w_end"), F.col("event_type").alias("label"), (F.col("event_id") % 10 / 20).alias("margin"))
    return words, windows.groupBy("conv", "w_start", "w_end").agg(F.min("label").alias("label"), F.max("margin").alias("margin"))


def _smooth(e: DataFrame) -> DataFrame:
    """Runs of one label that last less than a second take the label before."""
    words, windows = _words(e)
    return dialogue.smoothed(dialogue.relabelled(words, windows, 0.1, "?").join(words, ["conv", "word_id"]), 1.0)


_RELABELLED = """wrd AS MATERIALIZED (SELECT user_id AS conv, event_id AS word_id, event_id % 1000 * 0.5::DOUBLE AS s, event_id % 1000 * 0.5::DOUBLE + 0.4::DOUBLE AS e FROM events),
win AS MATERIALIZED (SELECT user_id AS conv, (event_id % 500)::DOUBLE AS ws, (event_id % 500)::DOUBLE + 2 AS we, min(event_type) AS label, max((event_id % 10)::DOUBLE / 20) AS margin FROM events GROUP BY ALL),
hit AS (SELECT wrd.conv, word_id, arg_min(label, ws) AS label FROM wrd JOIN win ON win.conv = wrd.conv AND margin >= 0.1::DOUBLE AND (s + e) / 2 >= ws AND (s + e) / 2 < we GROUP BY ALL),
lab AS MATERIALIZED (SELECT wrd.*, coalesce(label, '?') AS label FROM wrd LEFT JOIN hit USING (conv, word_id))"""
query("window_relabel", "events", lambda e: dialogue.relabelled(*_words(e), 0.1, "?"), f"WITH {_RELABELLED} SELECT conv, word_id, label FROM lab")
query("window_smooth", "events", _smooth, f"""WITH {_RELABELLED}, new AS (SELECT *, CASE WHEN label IS DISTINCT FROM lag(label) OVER w OR lag(word_id) OVER w IS NULL THEN 1 ELSE 0 END AS n FROM lab WINDOW w AS (PARTITION BY conv ORDER BY s, word_id)),
run AS (SELECT *, sum(n) OVER (PARTITION BY conv ORDER BY s, word_id) AS run FROM new), per AS (SELECT conv, run, arg_max(e, (s, word_id)) - min(s) >= 1 OR run = 1 AS stays, any_value(label) AS label FROM run GROUP BY conv, run),
kep AS (SELECT r.conv, r.run, (SELECT arg_max(p.label, p.run) FROM per p WHERE p.conv = r.conv AND p.run <= r.run AND p.stays) AS label FROM per r)
SELECT run.conv, word_id, kep.label FROM run JOIN kep USING (conv, run)""")
query("label_margin", "events", lambda e: dialogue.best_label(e.groupBy((F.col("user_id") % 50).alias("segment"), F.col("event_type").alias("label")).agg(F.round(F.avg("value"), 6).alias("score"))), "WITH a AS (SELECT user_id % 50 AS segment, event_type AS label, round(avg(value), 6) AS score FROM events GROUP BY ALL), b AS (SELECT *, row_number() OVER w AS p, lead(score) OVER w AS n FROM a WINDOW w AS (PARTITION BY segment ORDER BY score DESC, label)) SELECT segment, label, score, CASE WHEN n IS NULL THEN 1.0 ELSE round(score - n, 6) END AS margin FROM b WHERE p = 1")

_vectors = lambda e: e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
_V = "vec AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_TOP = f"{_V}, sco AS (SELECT q.id AS q_id, c.id, list_inner_product(q.v, c.v) AS score FROM vec q, vec c WHERE q.id < 5), top AS (SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, id) AS INTEGER) AS place FROM sco QUALIFY place <= 8)"
_top = lambda e: similar.top_k(_vectors(e).filter("id < 5").select(F.col("id").alias("q_id"), F.col("v").alias("q")), _vectors(e), 8)
query("topk_search", "embeddings", _top, f"WITH {_TOP} SELECT * FROM top")
_PAIRS = f"{_V}, sco AS (SELECT a.id AS a, b.id AS b, list_inner_product(a.v, b.v) AS c FROM vec a JOIN vec b ON a.id <> b.id), rnk AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS p FROM sco WHERE c >= 0.3), cos AS (SELECT least(a, b) AS id_a, greatest(a, b) AS id_b, max(c) AS cosine FROM rnk WHERE p <= 8 GROUP BY ALL)"
query("cosine_candidates", "embeddings", lambda e: similar.cosine_pairs(_vectors(e), 8, 0.3), f"WITH {_PAIRS} SELECT * FROM cos")
query("cosine_histogram", "embeddings", lambda e: similar.histogram(similar.cosine_pairs(_vectors(e), 8, 0.3), "cosine", 0.3, 0.05, 8), f"WITH {_PAIRS} SELECT CAST(least(floor((cosine - 0.3::DOUBLE) / 0.05::DOUBLE), 7) AS INTEGER) AS bin, count(*) AS n FROM cos GROUP BY ALL")
query("cohesion", "embeddings", lambda e: similar.cohesion(e.select(F.col("label").alias("cluster"), F.col("vec_id").alias("id"), F.col("embedding").alias("v"))), f"WITH {_V} SELECT a.label AS cluster, count(DISTINCT a.id) AS n, CASE WHEN count(DISTINCT a.id) = 1 THEN 1.0 ELSE round(avg(list_inner_product(a.v, b.v)) FILTER (a.id <> b.id), 6) END AS cohesion FROM vec a JOIN vec b ON a.label IS NOT DISTINCT FROM b.label GROUP BY a.label")
query("centroids", "embeddings", lambda e: similar.centroids(e.select(F.col("label").alias("cluster"), F.col("embedding").alias("v"))), f"WITH {_V}, u AS (SELECT label AS cluster, unnest(range(len(v))) AS d, unnest(v) AS x FROM vec), m AS (SELECT cluster, CAST(d AS INTEGER) AS d, avg(x) AS x FROM u GROUP BY ALL), n AS (SELECT cluster, sqrt(sum(x * x)) AS l FROM m GROUP BY cluster) SELECT cluster, d, round(x / l, 6) AS x FROM m JOIN n USING (cluster)")
query("cluster_number", "embeddings", lambda e: similar.renumbered(e.select(F.col("label").alias("cluster"))), "SELECT label AS cluster, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, label) AS INTEGER) AS number FROM embeddings GROUP BY label")
_sets = lambda p: p.groupBy("p_name").agg(F.min("p_type").alias("p_type")).select(F.col("p_name").alias("id"), t.theme_tokens(F.col("p_name"), F.col("p_type")).alias("tokens"))
_SETS = "tok AS (SELECT p_name AS id, list_distinct(list_filter(string_split_regex(lower(p_name || ' ' || min(p_type)), '[^a-z0-9]+'), lambda w: w <> '')) AS s FROM part GROUP BY p_name), jac AS (SELECT a.id AS id_a, b.id AS id_b, round(len(list_intersect(a.s, b.s))::DOUBLE / len(list_distinct(list_concat(a.s, b.s))), 6) AS jaccard FROM tok a JOIN tok b ON a.id < b.id)"
query("jaccard_candidates", "part", lambda p: similar.jaccard_pairs(_sets(p), 0.3), f"WITH {_SETS} SELECT * FROM jac WHERE jaccard >= 0.3")
query("bands", "embeddings", lambda e: similar.cosine_pairs(_vectors(e), 8, 0.3).select(similar.band(F.col("cosine") * 2, F.lit(None).cast("double")).alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("n")), f"WITH {_PAIRS} SELECT CASE WHEN cosine * 2 >= 0.92::DOUBLE THEN 'auto' WHEN cosine * 2 >= 0.8::DOUBLE THEN 'judge' ELSE 'drop' END AS band, count(*) AS n FROM cos GROUP BY ALL")
