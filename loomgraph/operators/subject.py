"""The subject of a narrative, its phases and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import drop, stage
from ..functions.text import ordinal, percent
from .graph import components


def resolved_subject(nodes: DataFrame, hint: str) -> DataFrame:
    """One row (subject_id, detection, ambiguous): an id marked is_subject, else the hint if a node has it, else a Person
    with a birth year; of several the smallest, and all of them in ambiguous. Null without any."""
    flagged, born = F.collect_set(F.when(F.col("is_subject"), F.col("id"))), F.collect_set(F.when((F.col("type") == "Person") & F.col("birth_year").isNotNull(), F.col("id")))
    row = nodes.filter(F.coalesce(F.col("is_subject"), F.lit(False)) | (F.col("id") == hint) | F.col("birth_year").isNotNull()).agg(F.array_sort(flagged).alias("f"), F.count_if(F.col("id") == hint).alias("h"), F.array_sort(born).alias("b"))
    how = F.when(F.size("f") > 0, "is_subject").when(F.col("h") > 0, "hint_id").when(F.size("b") > 0, "birth_year")
    found = F.when(F.size("f") > 0, F.col("f")).when(F.col("h") > 0, F.array(F.lit(hint))).otherwise(F.col("b"))
    return row.select(F.get(found, F.lit(0)).alias("subject_id"), how.alias("detection"), F.when(F.size(found) > 1, F.array_join(found, ",")).otherwise("").alias("ambiguous"))


def checked(nodes: DataFrame, edges: DataFrame, subject: str) -> DataFrame:
    """One row: whether exactly one Person has the subject's id, and how often the subject is the protagonist of an INVOLVES edge."""
    own = edges.filter((F.col("type") == "INVOLVES") & ((F.col("source_id") == subject) | (F.col("target_id") == subject)))
    row = own.agg(F.count(F.lit(1)).alias("n_involves"), percent(F.count_if(F.col("role") == "protagonist"), F.count(F.lit(1))).alias("pct_protagonist"))
    there = nodes.filter((F.col("type") == "Person") & (F.col("id") == subject)).agg(F.count_distinct("id").alias("n_nodes"))
    return there.crossJoin(F.broadcast(row)).select(F.lit(subject).alias("subject_id"), "n_nodes", (F.col("n_nodes") == 1).alias("exactly_one"), "n_involves", "pct_protagonist")  # one row each


def wrong_type(nodes: DataFrame, subjects: list[str]) -> DataFrame:
    """Subjects that occur as something other than a Person."""
    return nodes.filter(F.col("id").isin(subjects) & (F.col("type") != "Person")).groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))


def event_chunks(nodes: DataFrame) -> DataFrame:
    """(id, ordinals, first) of every Event: the sorted different ordinals of its chunks; chunks without a number count for nothing."""
    places = nodes.filter("type = 'Event'").select("id", ordinal(F.col("chunk_id")).alias("o")).distinct()
    return places.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_set("o")), lambda x: x.cast("string")), ",").alias("ordinals"), F.min("o").alias("first"))


def phase_events(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Phases with how many Events they hold; isolated ones hold two at most."""
    kinds = nodes.groupBy("id").agg(F.min("type").alias("t")).filter("t = 'Event'").select(F.col("id").alias("source_id"))
    held = edges.filter("type = 'DURING'").join(kinds, "source_id", "left_semi").groupBy(F.col("target_id").alias("id")).agg(F.count_distinct("source_id").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return nodes.filter("type = 'Phase'").select("id").distinct().join(held, "id", "left").select("id", n.alias("n_events"), (n <= 2).alias("isolated"))


def levels(edges: DataFrame) -> DataFrame:
    """(id, level) of every end of an edge (source, target): the longest path that leads to it; null on and behind a cycle.

    Each round takes the nodes that no edge reaches any more, so there are as many rounds as the longest path has nodes.
    """
    left = stage(edges.filter("source <> target").select("source", "target").distinct(), "levels-left")
    ids = edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    open_, found, level = stage(ids, "levels-open"), [], 0
    while True:
        free = stage(open_.join(left.select(F.col("target").alias("id")).distinct(), "id", "left_anti").withColumn("level", F.lit(level)), "levels-free")
        if free.isEmpty():
            break
        found.append(free)
        rest = stage(open_.join(free, "id", "left_anti"), "levels-open")
        fewer = stage(left.join(free.select(F.col("id").alias("source")), "source", "left_anti"), "levels-left")
        drop(open_, left)
        open_, left, level = rest, fewer, level + 1
    out = open_.withColumn("level", F.lit(None).cast("int"))
    for f in found:
        out = out.unionByName(f)
    return out


def chains(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(chain, id, place, n): each weakly connected group of edges (source, target) in topological order, a group with a
    cycle by id; nodes (id) without an edge are in none."""
    known = edges.join(nodes.select(F.col("id").alias("source")), "source", "left_semi").join(nodes.select(F.col("id").alias("target")), "target", "left_semi")
    roots = components(known, "source", "target").withColumnRenamed("node", "id")
    placed = roots.join(levels(known), "id")
    group = Window.partitionBy("root")
    cyclic = F.max(F.col("level").isNull().cast("int")).over(group)
    order = group.orderBy(F.when(F.col("cyclic") == 1, 0).otherwise(F.col("level")), "id")
    return placed.withColumn("cyclic", cyclic).withColumn("place", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(group)).select(F.col("root").alias("chain"), "id", "place", "n")
