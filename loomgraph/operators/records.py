"""Records: provenances, samples, run logs, comparisons, selections and layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import one_line
from .order import numbered

#: The keys of a run's metadata.
RUN_KEYS = "source created_at stage_version schema_version prompt_version model params mode started_at finished_at n_chunks_requested total_chunks_processed".split()


def run_metadata(log: DataFrame) -> DataFrame:
    """The columns of a run's log that are its metadata, those that are there."""
    return log.select(*[c for c in RUN_KEYS if c in log.columns])


def provenance(chunk_id: Column, model: str, stamp: str, confidence: Column, span: Column, version: str = "1") -> Column:
    """A provenance: where a record comes from, by which model and when; nobody has validated it yet."""
    return F.struct(chunk_id.alias("chunk_id"), F.lit(model).alias("model"), F.lit(stamp).alias("timestamp"), F.lit(version).alias("schema_version"), confidence.alias("confidence"), span.alias("evidence_span"), F.lit(False).alias("human_validated"))


def slim(provenances: Column) -> Column:
    """Of each provenance only confidence and span."""
    return F.transform(provenances, lambda p: F.struct(p["confidence"].alias("confidence"), p["evidence_span"].alias("evidence_span")))


def flat_edges(edges: DataFrame, at: str = "provenance") -> DataFrame:
    """Edges with the fields of their nested provenance as columns."""
    return edges.select(*[c for c in edges.columns if c != at], f"{at}.confidence", f"{at}.evidence_span")


def envelope(runs: DataFrame, requested: DataFrame, source: str, version: str) -> DataFrame:
    """One row on a run of chunks (chunk_id, seconds, tokens_in, tokens_out, status): metadata and totals."""
    counts = runs.agg(
        F.count(F.lit(1)).alias("total_chunks_processed"), F.count_if(F.col("status") == "ok").alias("n_ok"), F.count_if(F.col("status") != "ok").alias("n_error"),
        F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out"), F.round(F.coalesce(F.sum("seconds"), F.lit(0.0)), 3).alias("seconds"),
    )
    wanted = requested.agg(F.count_distinct("chunk_id").alias("n_chunks_requested"))
    return counts.crossJoin(F.broadcast(wanted)).withColumn("source", F.lit(source)).withColumn("stage_version", F.lit(version))  # one row each


def selected(chunks: DataFrame, explicit: list[str] | None = None, gold: DataFrame | None = None, everything: bool = False) -> DataFrame:
    """(chunk_id, place) to work on: an explicit list in its order, else all in order of their ids, else the gold ones."""
    if explicit:
        wanted = chunks.sparkSession.createDataFrame(list(enumerate(explicit, 1)), "place int, chunk_id string")
        return wanted.join(chunks.select("chunk_id").distinct(), "chunk_id", "left_semi").select("chunk_id", "place")
    found = chunks if everything or gold is None else chunks.join(gold.select("chunk_id").distinct(), "chunk_id", "left_semi")
    return found.select("chunk_id").distinct().select("chunk_id", F.lit(None).cast("int").alias("place"))


def unready(decisions: DataFrame, nodes: DataFrame) -> DataFrame:
    """What forbids resolving: decisions (ids joined by commas, canonical_id) without a canonical id, and losers that no node has."""
    open_ = decisions.filter("canonical_id IS NULL").select(F.lit("open decision").alias("problem"), F.col("ids").alias("what"))
    losers = decisions.filter("canonical_id IS NOT NULL").select(F.explode(F.split("ids", ",")).alias("id"), "canonical_id").filter("id <> canonical_id")
    missing = losers.join(nodes.select("id").distinct(), "id", "left_anti").select(F.lit("unknown loser").alias("problem"), F.col("id").alias("what"))
    return open_.unionByName(missing)


def node_samples(nodes: DataFrame, k_chunks: int = 5, k: int = 3, limit: int = 100) -> DataFrame:
    """(id, type, name, n_provenances, chunks, spans) of nodes: their first chunks and the first provenances in order of reading."""
    order = Window.partitionBy("id", "type").orderBy("pos", "confidence", "name")
    first = nodes.withColumn("place", F.row_number().over(order))
    grouped = first.groupBy("id", "type").agg(
        F.max(F.when(F.col("place") == 1, F.col("name"))).alias("name"), F.count(F.lit(1)).alias("n_provenances"), F.slice(F.array_sort(F.collect_set("chunk_id")), 1, k_chunks).alias("chunks"),
        F.array_sort(F.collect_list(F.when(F.col("place") <= k, F.struct("place", F.substring(F.coalesce("name", F.lit("")), 1, limit).alias("span"))))).alias("spans"),
    )
    return grouped.select("id", "type", "name", "n_provenances", F.array_join("chunks", ",").alias("chunks"), F.array_join(F.transform("spans", lambda x: x["span"]), "|").alias("spans"))


def action_counts(decisions: DataFrame, actions: list[str]) -> DataFrame:
    """One row: how many decisions took each action."""
    return decisions.agg(*[F.count_if(F.col("action") == a).alias(a.replace("-", "_")) for a in actions])


def theme_dump(themes: DataFrame, limit: int = 200) -> DataFrame:
    """(id, name, description, place) of themes, descriptions cut, in order of the lower-case name."""
    order = Window.partitionBy(F.lower(F.substring("name", 1, 1))).orderBy(F.lower("name"), "id")
    return themes.select("id", "name", one_line(F.col("description"), limit).alias("description"), F.row_number().over(order).alias("place"))


def type_breakdown(nodes: DataFrame, schema: list[str]) -> DataFrame:
    """(type, n, ids, in_schema): the different ids of each type, sorted."""
    grouped = nodes.select("type", "id").distinct().groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"))
    return grouped.withColumn("in_schema", F.col("type").isin(schema))


def compact_comparison(gold: DataFrame, model: DataFrame) -> DataFrame:
    """(chunk_id, type, pair): how many rows (chunk_id, type) of a type gold and model have, types without any left out."""
    count = lambda df, n: df.groupBy("chunk_id", "type").agg(F.count(F.lit(1)).alias(n))
    both = count(gold, "g").join(count(model, "m"), ["chunk_id", "type"], "full")
    return both.select("chunk_id", "type", F.concat(F.lit("["), F.coalesce("g", F.lit(0)).cast("string"), F.lit(", "), F.coalesce("m", F.lit(0)).cast("string"), F.lit("]")).alias("pair"))


def few_shots(examples: DataFrame, chunks: DataFrame) -> DataFrame:
    """Examples (path, reply) with the text of the chunk (chunk_id, text) that their file is named after; others go."""
    named = examples.withColumn("chunk_id", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", ""))
    return named.join(chunks.select("chunk_id", "text"), "chunk_id").select("chunk_id", "text", "reply")


def speaker_targets(scores: DataFrame, order: DataFrame, labels: list[str]) -> DataFrame:
    """(conv, raw, label) for raw speakers (conv, raw, first) from their cosines with enrolled labels (conv, raw, label, cosine).

    Enrolled labels, in the order of `labels`, each take the most similar speaker that is left, of equals the first to
    appear; the other speakers take the free labels in order of appearance, then S and a number. Labels are few, so a
    step for each of them is a fixed number of joins.
    """
    left, done = order.select("conv", "raw", "first"), None
    used = scores.select("conv", "label").distinct()
    for label in labels:
        mine = scores.filter(F.col("label") == label).join(left, ["conv", "raw"])
        best = mine.groupBy("conv").agg(F.max_by("raw", F.struct("cosine", -F.col("first"))).alias("raw")).withColumn("label", F.lit(label))
        done = best if done is None else done.unionByName(best)
        left = left.join(best.select("conv", "raw"), ["conv", "raw"], "left_anti")
    free = order.select("conv").distinct().withColumn("label", F.explode(F.array(*map(F.lit, labels)))).join(used, ["conv", "label"], "left_anti")
    rank = F.lit(0)
    for i, label in enumerate(labels):
        rank = F.when(F.col("label") == label, i).otherwise(rank)
    free = free.withColumn("place", F.row_number().over(Window.partitionBy("conv").orderBy(rank)))
    taken = done.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    rest = left.withColumn("place", F.row_number().over(Window.partitionBy("conv").orderBy("first", "raw"))).join(free, ["conv", "place"], "left").join(taken, "conv", "left")
    named = rest.select("conv", "raw", F.coalesce("label", F.concat(F.lit("S"), (F.coalesce("n", F.lit(0)) + F.col("place")).cast("string"))).alias("label"))
    return done.select("conv", "raw", "label").unionByName(named)


def placed_on_points(nodes: DataFrame, points: DataFrame, fixed: DataFrame, skip: list[str]) -> DataFrame:
    """(id, x, y, fixed): eras (id, x, y) stand where they are told; of the other nodes (id, pos, type), skipped ones left
    out, the first in order of pos takes the first point (i, x, y), and so on while there are points.

    Places come from one range partitioning of either side, so that no task holds all rows.
    """
    eligible = nodes.filter(~F.col("id").isin(skip) & (F.col("type") != "Era")).join(fixed.select("id"), "id", "left_anti")
    pairs = numbered(eligible, "pos", "id").join(numbered(points, "i").select("place", "x", "y"), "place")
    return pairs.select("id", "x", "y", F.lit(True).alias("fixed")).unionByName(fixed.select("id", "x", "y", F.lit(True).alias("fixed")))


def on_maps(nodes: DataFrame, maps: DataFrame) -> DataFrame:
    """(map, topic, id): the maps (map, topic, ids) that list each node."""
    return maps.select("map", "topic", F.explode("ids").alias("id")).distinct().join(nodes.select("id").distinct(), "id", "left_semi").select("map", "topic", "id")
