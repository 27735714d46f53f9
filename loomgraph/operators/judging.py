"""What goes to a model and comes back: requests, schemas, cache keys, batches, replies; speakers, words and points."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import chunk_message
from ..functions.schema import EDGE_RULES, NODE_TYPES, ROLES
from ..functions.text import reply_json

REPLY = "nodes array<struct<id: string, type: string, name: string>>, edges array<struct<source_id: string, target_id: string, type: string, role: string>>"


def tool_schema() -> dict:
    """The JSON schema of an extraction: flat nodes and edges of the graph's types."""
    text = {"type": "string"}
    node = {"type": "object", "required": ["id", "type", "name"], "properties": {"id": text, "type": {"enum": NODE_TYPES}, "name": text}}
    edge = {"type": "object", "required": ["source_id", "target_id", "type"], "properties": {"source_id": text, "target_id": text, "type": {"enum": list(EDGE_RULES)}, "role": {"enum": [*ROLES, None]}}}
    return {"type": "object", "required": ["nodes", "edges"], "properties": {"nodes": {"type": "array", "items": node}, "edges": {"type": "array", "items": edge}}}


def requests(chunks: DataFrame, model: str, system: str, most: int) -> DataFrame:
    """(chunk_id, body): one request for each chunk (chunk_id, text)."""
    message = F.struct(F.lit("user").alias("role"), chunk_message(F.col("chunk_id"), F.col("text")).alias("content"))
    body = F.struct(F.lit(model).alias("model"), F.lit(most).alias("max_tokens"), F.lit(system).alias("system"), F.array(message).alias("messages"))
    return chunks.select("chunk_id", F.to_json(body).alias("body"))


def chat_messages(system: str, history: Column, question: Column) -> Column:
    """The messages of a turn: the system's, the history's (structs of role and content), the question."""
    one = lambda role, content: F.array(F.struct(F.lit(role).alias("role"), content.alias("content")))
    return F.concat(one("system", F.lit(system)), F.coalesce(history, F.slice(one("user", question), 1, 0)), one("user", question))


def pair_key(a: Column, b: Column, *rest: Column, ordered: bool = False) -> Column:
    """The key of a judged pair in a cache: the same both ways round, unless the order matters."""
    pair = F.concat_ws("->", a, b) if ordered else F.concat_ws("|", F.least(a, b), F.greatest(a, b))
    return F.sha1(F.concat_ws("|", pair, *rest))


def cluster_key(clusters: DataFrame, *rest: str) -> DataFrame:
    """(cluster, key): the key of a cluster's sorted members (cluster, id)."""
    grouped = clusters.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_set(F.col("id").cast("string"))), ",").alias("ids"))
    return grouped.select("cluster", F.sha1(F.concat_ws("|", "ids", *map(F.lit, rest))).alias("key"))


def collected(selection: DataFrame, results: DataFrame) -> DataFrame:
    """(place, chunk_id, status, reply): the results (chunk_id, type, reply) of a batch in the order of its selection
    (place, chunk_id); the last of several by reply, a chunk without one is missing."""
    last = results.groupBy("chunk_id").agg(F.max(F.struct("type", "reply")).alias("x"))
    return selection.join(last, "chunk_id", "left").select("place", "chunk_id", F.coalesce("x.type", F.lit("missing")).alias("status"), "x.reply")


def reply_status(reply: Column) -> Column:
    """ok, no_tool_use for a reply without an object, validation_error for one that is no extraction."""
    body = reply_json(reply)
    parsed = F.from_json(body, REPLY)
    return F.when(body.isNull(), "no_tool_use").when(parsed["nodes"].isNull() | parsed["edges"].isNull(), "validation_error").otherwise("ok")


def normalised(flat: Column) -> Column:
    """nodes and edges of a reply whose lists may be JSON in a string; null if either is no list."""
    kinds = {"nodes": "array<struct<id: string, type: string, name: string>>", "edges": "array<struct<source_id: string, target_id: string, type: string, role: string>>"}
    read = lambda c: F.from_json(F.get_json_object(flat, f"$.{c}"), kinds[c])
    return F.when(read("nodes").isNotNull() & read("edges").isNotNull(), F.struct(read("nodes").alias("nodes"), read("edges").alias("edges")))


def incoherent(rows: DataFrame) -> DataFrame:
    """(id, problem) of resolved nodes or edges (id, n_provenances, merge_method, n_merged, review_needed, review_reason)."""
    c = F.col
    problem = (
        F.when(F.coalesce(c("n_provenances"), F.lit(0)) < 1, "no provenance").when(~c("merge_method").isin("none", "exact", "synonym_llm", "manual") | c("merge_method").isNull(), "unknown method")
        .when((c("merge_method") == "none") & (c("n_merged") > 1), "merged without a method").when(c("review_needed") & (F.coalesce(F.trim("review_reason"), F.lit("")) == ""), "review without a reason")
    )
    return rows.select("id", problem.alias("problem")).filter("problem IS NOT NULL")


def global_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, type, name): nodes by their first occurrence (id, type, name, pos); ends that are no node are Unknown."""
    first = nodes.groupBy("id").agg(F.min_by(F.struct("type", "name"), F.struct("pos", "type", "name")).alias("x")).select("id", "x.type", "x.name")
    ends = edges.select(F.explode(F.array("source_id", "target_id")).alias("id")).distinct().join(first, "id", "left_anti")
    return first.unionByName(ends.select("id", F.lit("Unknown").alias("type"), F.col("id").alias("name")))


def reassigned(segments: DataFrame, margin: float = 0.10, shortest: float = 0.7) -> DataFrame:
    """Segments (seg, start, end, label, best, lead) with the best label where it is far enough ahead and the segment long enough."""
    moves = (F.col("lead") >= margin) & (F.col("end") - F.col("start") >= shortest) & F.col("best").isNotNull() & ~F.col("best").eqNullSafe(F.col("label"))
    moves = F.coalesce(moves, F.lit(False))
    return segments.select("seg", F.when(moves, F.col("best")).otherwise(F.col("label")).alias("label"), moves.alias("moved"))


def profiles(samples: DataFrame) -> DataFrame:
    """(label, d, x): the mean vector of each label's samples (label, v), of length 1."""
    from .similar import centroids

    return centroids(samples.select(F.col("label").alias("cluster"), "v")).withColumnRenamed("cluster", "label")


def audio_slice(samples: Column, rate: int, start: Column, end: Column) -> Column:
    """The samples from start to end seconds, as far as there are any."""
    first, last = F.greatest(F.floor(start * rate), F.lit(0)), F.least(F.floor(end * rate), F.size(samples))
    return F.when(last > first, F.slice(samples, (first + 1).cast("int"), (last - first).cast("int"))).otherwise(F.slice(samples, 1, 0))


def with_speaker(words: Column, label: Column) -> Column:
    """Words (structs of w and speaker) with a segment's label where they have a speaker."""
    return F.transform(words, lambda w: F.struct(w["w"].alias("w"), F.when(w["speaker"].isNotNull(), label).alias("speaker")))


def ingest_command(source: Column, target: Column, rate: int = 16_000) -> Column:
    """The arguments that turn a file into sound of one channel."""
    return F.array(F.lit("ffmpeg"), F.lit("-y"), F.lit("-i"), source, F.lit("-ac"), F.lit("1"), F.lit("-ar"), F.lit(str(rate)), target)


def recap(dialogue: Column, summary: Column) -> Column:
    """A recap under the source that the first line of a dialogue names."""
    return F.concat(F.lit("# "), F.regexp_extract(dialogue, r"^#?\s*([^\n]*)", 1), F.lit("\n\n"), F.trim(summary))


def visual_lines(words: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """(page, line_no, text, x0) from words (page, top, x0, text): in order of (top, x0), a word joins the line while its
    top is within the tolerance of the mean of the line's; words of a line stand by x0. A page is one group, as the mean
    moves with every word; a page holds a bounded number of words."""

    def run(page: pd.DataFrame) -> pd.DataFrame:
        lines: list[list[tuple]] = []
        for w in page.sort_values(["top", "x0", "text"]).itertuples(index=False):
            if lines and abs(w.top - sum(x[0] for x in lines[-1]) / len(lines[-1])) <= tolerance:
                lines[-1].append((w.top, w.x0, w.text))
            else:
                lines.append([(w.top, w.x0, w.text)])
        key = page["page"].iloc[0]
        rows = [(key, i, " ".join(t for _, _, t in sorted(line, key=lambda x: (x[1], x[2]))), min(x for _, x, _ in line)) for i, line in enumerate(lines)]
        return pd.DataFrame(rows, columns=["page", "line_no", "text", "x0"])

    return words.groupBy("page").applyInPandas(run, "page long, line_no int, text string, x0 double")


def top_cosines(pairs: DataFrame, shares: dict[str, float]) -> DataFrame:
    """One row: quantiles of the best cosine that each id of the pairs (id_a, id_b, cosine) has."""
    from .order import quantiles

    best = pairs.select(F.explode(F.array("id_a", "id_b")).alias("id"), "cosine").groupBy("id").agg(F.max("cosine").alias("cosine")).withColumn("all", F.lit("all"))
    return quantiles(best, "all", "cosine", shares).select("n", *[F.round(c, 6).alias(c) for c in shares])


def lloyd(points: DataFrame, pixels: DataFrame, rounds: int) -> DataFrame:
    """Points (id, x, y) after so many rounds in which each moves to the weighted mean of the pixels (x, y, w) that are
    nearest to it, of equals the smaller id; a point without any stays."""
    from ..functions.staging import stage
    from .similar import nearest

    seen = pixels.select(F.monotonically_increasing_id().alias("id"), "x", "y", "w")
    seen = stage(seen, "pixels")
    for _ in range(rounds):
        # the nearest point has the largest 2 p q - |q|^2
        near = nearest(seen.select("id", F.array("x", "y", F.lit(1.0)).alias("v")), points.select("id", F.array(2 * F.col("x"), 2 * F.col("y"), -(F.col("x") * F.col("x") + F.col("y") * F.col("y"))).alias("v")), 1)
        held = near.select(F.col("q_id").alias("p"), F.col("id").alias("at")).join(seen.withColumnRenamed("id", "p"), "p")
        means = held.groupBy(F.col("at").alias("id")).agg((F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("nx"), (F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("ny"))
        points = stage(points.join(means, "id", "left").select("id", F.coalesce("nx", "x").alias("x"), F.coalesce("ny", "y").alias("y")), "points")
    return points


def token_count(text: Column) -> Column:
    """Words and signs, where no tokenizer is at hand."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]")), F.lit(0))
