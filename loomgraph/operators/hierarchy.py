"""Hierarchies of themes and edges from judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def united(edges: DataFrame) -> DataFrame:
    """One edge per (source, target) from several origins: the highest confidence, all origins; no self pairs."""
    return edges.filter("source <> target").groupBy("source", "target").agg(F.max("confidence").alias("confidence"), F.array_join(F.array_sort(F.collect_set("origin")), "+").alias("origins"))


def built(edges: DataFrame, themes: DataFrame) -> DataFrame:
    """What becomes of each target of a hierarchy: a theme that exists is promoted, a missing one is made and goes to review."""
    heads = edges.groupBy(F.col("target").alias("id")).agg(F.count(F.lit(1)).alias("n_under"))
    known = themes.select("id", F.lit(True).alias("there")).distinct()
    return heads.join(known, "id", "left").select("id", "n_under", F.when(F.col("there"), "promoted").otherwise("made").alias("action"), F.when(F.col("there"), 1.0).otherwise(0.7).alias("confidence"), F.col("there").isNull().alias("review_needed"))


def placed_once(claims: DataFrame) -> DataFrame:
    """Each member (cluster, id, part, pos) exactly once: as a cap before a member before unattached, the first claim of equals.

    Caps without any member are members of none and go to unattached.
    """
    rank = F.when(F.col("part") == "cap", 0).when(F.col("part") == "member", 1).otherwise(2)
    best = Window.partitionBy("cluster", "id").orderBy(rank, "pos", "cap_id")
    once = claims.withColumn("place", F.row_number().over(best)).filter("place = 1")
    used = once.filter("part = 'member'").select("cluster", F.col("cap_id").alias("id"), F.lit(True).alias("used")).distinct()
    out = once.join(used, ["cluster", "id"], "left")
    return out.select("cluster", "id", F.when((F.col("part") == "cap") & F.col("used").isNull(), "unattached").otherwise(F.col("part")).alias("part"), F.when(F.col("part") == "member", F.col("cap_id")).alias("cap_id"))


def materialised(judged: DataFrame, known: DataFrame, least: float = 0.6) -> DataFrame:
    """What becomes of judged pairs (a, b, verdict, direction, confidence): none, low confidence, duplicate or added.

    Direction `ba` turns the edge around; known edges have source and target.
    """
    turned = F.col("direction") == "ba"
    rows = judged.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("source"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("target"), "verdict", "confidence")
    there = known.select("source", "target", F.lit(True).alias("there")).distinct()
    action = F.when(~F.col("verdict"), "none").when(F.col("confidence") < least, "low confidence").when(F.col("there"), "duplicate").otherwise("added")
    return rows.join(there, ["source", "target"], "left").select("source", "target", "confidence", action.alias("action"))


def unjudged(pairs: DataFrame, cache: DataFrame) -> DataFrame:
    """Pairs that the cache doesn't have, whichever way round."""
    key = lambda df: df.withColumn("key", F.sha1(F.concat_ws("|", F.least("a", "b").cast("string"), F.greatest("a", "b").cast("string"))))
    return key(pairs).join(key(cache).select("key"), "key", "left_anti")


def ordered_judgments(judged: DataFrame, k: int) -> DataFrame:
    """The k most certain judgments (a, b, verdict, confidence) of each verdict, with the verdict's count."""
    counts = judged.groupBy("verdict").agg(F.count(F.lit(1)).alias("n_verdict"))
    best = Window.partitionBy("verdict").orderBy(F.desc("confidence"), "a", "b")
    top = judged.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
    return top.join(counts, "verdict").select("a", "b", "verdict", "confidence", "n_verdict", "place")


def record(edges: DataFrame, themes: DataFrame) -> DataFrame:
    """One row on a hierarchy: its edges, those of both origins, heads that are themes already and heads that are made."""
    counts = edges.agg(F.count(F.lit(1)).alias("n_edges"), F.count_if(F.contains("origins", F.lit("+"))).alias("n_both"))
    heads = built(edges, themes).agg(F.count_if(F.col("action") == "promoted").alias("n_promoted"), F.count_if(F.col("action") == "made").alias("n_made"))
    return counts.crossJoin(F.broadcast(heads))  # one row each
