"""Quality metrics of a graph and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import NODE_TYPES
from ..functions.text import percent
from .order import quantiles


def type_counts(nodes: DataFrame) -> DataFrame:
    """Distinct nodes by type, with zero for types that don't occur."""
    counts = nodes.groupBy("type").agg(F.count_distinct("id").alias("n"))
    every = nodes.sparkSession.createDataFrame([(t,) for t in NODE_TYPES], "type string")
    return every.join(counts, "type", "full").select("type", F.coalesce("n", F.lit(0)).alias("n"), F.col("type").isin(NODE_TYPES).alias("in_schema"))


def confidence_stats(nodes: DataFrame) -> DataFrame:
    """Confidences of all occurrences by type."""
    under = lambda x: F.count_if(F.col("confidence") < x)
    shares = {"p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}
    q = quantiles(nodes, "type", "confidence", shares).select("type", *[F.round(c, 6).alias(c) for c in shares])
    rest = nodes.groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean"), F.min("confidence").alias("least"), F.max("confidence").alias("most"),
        under(0.5).alias("below_50"), under(0.7).alias("below_70"), under(0.9).alias("below_90"),
    )
    return rest.join(q, "type", "left")


def event_quality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: how many Events have a place, a time, an era, a person, a theme."""
    kinds = nodes.groupBy("id").agg(F.min("type").alias("target_type")).withColumnRenamed("id", "target_id")
    out = edges.join(kinds, "target_id", "left").groupBy(F.col("source_id").alias("id")).agg(
        F.bool_or(F.col("type") == "LOCATED_AT").alias("place"), F.bool_or(F.col("type") == "DURING").alias("time"), F.bool_or((F.col("type") == "DURING") & (F.col("target_type") == "Era")).alias("era"),
        F.bool_or(F.col("type") == "INVOLVES").alias("person"), F.bool_or((F.col("type") == "EMBODIES") & (F.col("target_type") == "Theme")).alias("theme"),
    )
    events = nodes.filter("type = 'Event'").select("id").distinct().join(out, "id", "left")
    return events.agg(F.count(F.lit(1)).alias("n_events"), *[percent(F.count_if(F.coalesce(c, F.lit(False))), F.count(F.lit(1))).alias(f"pct_{c}") for c in ("place", "time", "era", "person", "theme")])


def temporal_backbone(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Phases with their events, and whether one of their own edges places them in an Era."""
    inside = edges.filter("type = 'DURING'").groupBy(F.col("target_id").alias("id")).agg(F.count_distinct("source_id").alias("n_events"))
    placed = edges.filter("type = 'OCCURS_IN'").groupBy(F.col("source_id").alias("id")).agg(F.count_distinct("target_id").alias("n_eras"))
    return nodes.filter("type = 'Phase'").select("id").distinct().join(inside, "id", "left").join(placed, "id", "left").select("id", F.coalesce("n_events", F.lit(0)).alias("n_events"), (F.coalesce("n_eras", F.lit(0)) > 0).alias("anchored"))


def involves_roles(edges: DataFrame) -> DataFrame:
    """One row: the roles of INVOLVES edges in percent; null if there are none."""
    e = edges.filter("type = 'INVOLVES'")
    share = lambda r: percent(F.count_if(F.col("role") == r), F.count(F.lit(1)))
    return e.agg(F.count(F.lit(1)).alias("n"), *[share(r).alias(f"pct_{r}") for r in ("protagonist", "participant", "mentioned")])


def narrative(edges: DataFrame) -> DataFrame:
    """One row: CAUSED and FOLLOWS edges and their ratio, infinite without FOLLOWS."""
    caused, follows = F.count_if(F.col("type") == "CAUSED"), F.count_if(F.col("type") == "FOLLOWS")
    return edges.agg(caused.alias("n_caused"), follows.alias("n_follows"), F.count_if(F.col("type") == "ECHOES").alias("n_echoes")).withColumn("ratio", F.when(F.col("n_follows") == 0, F.lit(float("inf"))).otherwise(F.round(F.col("n_caused") / F.col("n_follows"), 6)))


def theme_rank(edges: DataFrame, k: int = 20) -> DataFrame:
    """Themes by incoming EMBODIES."""
    return edges.filter("type = 'EMBODIES'").groupBy(F.col("target_id").alias("id")).agg(F.count(F.lit(1)).alias("n_in"), F.count_distinct("source_id").alias("n_sources")).orderBy(F.desc("n_in"), "id").limit(k)


def per_chunk(nodes: DataFrame, kind: str) -> DataFrame:
    """How many chunks have each number of nodes of a type, zero included."""
    counts = nodes.groupBy("chunk_id").agg(F.count_if(F.col("type") == kind).alias("n_nodes"))
    return counts.groupBy("n_nodes").agg(F.count(F.lit(1)).alias("n_chunks"))


def person_duplicates(nodes: DataFrame, norm: Column) -> DataFrame:
    return nodes.filter("type = 'Person'").select("id", norm.alias("norm")).distinct().groupBy("norm").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).filter("n > 1")


def phase_order(nodes: DataFrame, edges: DataFrame, ordinal: Column) -> DataFrame:
    """Phases of each era by the mean ordinal of their chunks, each with the next one; the last OCCURS_IN decides the era."""
    era = edges.filter("type = 'OCCURS_IN'").groupBy(F.col("source_id").alias("id")).agg(F.max_by("target_id", "pos").alias("era"))
    mean = nodes.filter("type = 'Phase'").groupBy("id").agg(F.round(F.coalesce(F.avg(ordinal), F.lit(float("inf"))), 4).alias("mean"))
    line = Window.partitionBy("era").orderBy("mean", "id")
    return mean.join(era, "id").withColumn("place", F.row_number().over(line)).withColumn("next_id", F.lead("id").over(line))


#: Thresholds as (check, metric, passes from or to, stops below or above, whether more is better).
THRESHOLDS = [
    ("caused_follows_ratio", "ratio", 0.6, 0.4, True),
    ("pct_event_with_during", "pct_time", 70.0, 50.0, True),
    ("pct_event_with_era", "pct_era", 60.0, 40.0, True),
    ("pct_phase_occurs_in_era", "pct_anchored", 80.0, 50.0, True),
    ("themes_per_chunk", "themes_per_chunk", 1.0, 1.4, False),
    ("top_theme_embodies_in", "top_theme", 10.0, 6.0, True),
]


def status(value: Column, good: Column, stop: Column, more: Column) -> Column:
    """n/a without a value; stop before pass; else fail."""
    stops, passes = F.when(more, value < stop).otherwise(value > stop), F.when(more, value >= good).otherwise(value <= good)
    return F.when(value.isNull(), "n/a").when(stops, "stop").when(passes, "pass").otherwise("fail")


def protagonist_status(value: Column) -> Column:
    return F.when(value.isNull(), "n/a").when((value > 85) | (value < 25), "stop").when(value.between(40, 65), "pass").otherwise("fail")


def measured(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of all metrics that checks look at."""
    anchored = temporal_backbone(nodes, edges).agg(percent(F.count_if("anchored"), F.count(F.lit(1))).alias("pct_anchored"))
    themes = nodes.agg(F.round(F.count_distinct(F.when(F.col("type") == "Theme", F.col("id"))) / F.count_distinct("chunk_id"), 6).alias("themes_per_chunk"), F.count_distinct("chunk_id").alias("n_chunks"))
    top = theme_rank(edges, 1).agg(F.max("n_in").cast("double").alias("top_theme"))
    roles = involves_roles(edges).select("pct_protagonist")
    row = event_quality(nodes, edges)
    for other in (narrative(edges), anchored, themes, top, roles):  # one row each
        row = row.crossJoin(F.broadcast(other))
    return row


def checks(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(check, value, status) of every threshold."""
    row = measured(nodes, edges)
    listed = [F.struct(F.lit(c).alias("check"), F.col(m).cast("double").alias("value"), status(F.col(m), F.lit(g), F.lit(s), F.lit(more)).alias("status")) for c, m, g, s, more in THRESHOLDS]
    listed.append(F.struct(F.lit("pct_protagonist_on_involves").alias("check"), F.col("pct_protagonist").alias("value"), protagonist_status(F.col("pct_protagonist")).alias("status")))
    listed.append(F.struct(F.lit("graph_loaded").alias("check"), F.col("n_chunks").cast("double").alias("value"), F.when(F.col("n_chunks") > 0, "pass").otherwise("stop").alias("status")))
    return row.select(F.explode(F.array(*listed)).alias("c")).select("c.*")


def verdict(found: DataFrame) -> DataFrame:
    """stop from three stops on, ok from six passes without a stop, else mixed."""
    return found.agg(F.count_if(F.col("status") == "stop").alias("n_stop"), F.count_if(F.col("status") == "pass").alias("n_pass"), F.count_if(F.col("status") == "fail").alias("n_fail")).withColumn(
        "verdict", F.when(F.col("n_stop") >= 3, "stop").when((F.col("n_pass") >= 6) & (F.col("n_stop") == 0), "ok").otherwise("mixed")
    )
