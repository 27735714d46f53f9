"""Dialogue turns from segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words that mark a follow-up question, and how many words a short one has.
FOLLOW_UP = ["davvero", "vero", "perché", "perche", "come mai", "e tu", "ti piace", "ti piaceva", "dimmi di più", "di più", "ancora", " anche ", " lui ", " lei ", " questo ", " questa "]
SHORT = 5


def speakers(segments: DataFrame, labels: list[str]) -> DataFrame:
    """(conv, speaker, label) by first appearance; S<n> when labels run out. A null speaker has none."""
    first = segments.filter("speaker IS NOT NULL").groupBy("conv", "speaker").agg(F.min("pos").alias("first"))
    place = F.row_number().over(Window.partitionBy("conv").orderBy("first"))
    named = F.coalesce(F.get(F.array(*map(F.lit, labels)), place - 1), F.concat(F.lit("S"), place.cast("string")))
    return first.select("conv", "speaker", named.alias("label"))


def turns(segments: DataFrame, names: DataFrame) -> DataFrame:
    """Neighbouring segments (conv, pos, speaker, text) of one label as one turn; blank ones are skipped, unknown speakers are ?."""
    said = segments.withColumn("text", F.trim("text")).filter("text <> ''").join(names, ["conv", "speaker"], "left").withColumn("label", F.coalesce("label", F.lit("?")))
    order = Window.partitionBy("conv").orderBy("pos")
    new = F.coalesce(F.lag("label").over(order) != F.col("label"), F.lit(True)).cast("int")
    numbered = said.withColumn("new", new).withColumn("turn", F.sum("new").over(order))
    return numbered.groupBy("conv", "turn").agg(
        F.first("label").alias("label"), F.min("pos").alias("start"), F.max("pos").alias("end"), F.count(F.lit(1)).alias("parts"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("text"),
    )


def is_follow_up(question: Column, has_history: Column) -> Column:
    padded = F.concat(F.lit(" "), F.lower(question), F.lit(" "))
    hint = F.lit(False)
    for h in FOLLOW_UP:
        hint = hint | F.contains(padded, F.lit(h))
    return has_history & (hint | (F.size(F.filter(F.split(F.trim(question), r"\s+"), lambda w: w != "")) <= SHORT))


def expanded(conversations: DataFrame) -> DataFrame:
    """Questions of users; a follow-up gets the user's question before it in front."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    asked = conversations.filter("role = 'user'").withColumn("before", F.lag("text").over(order))
    follow = is_follow_up(F.col("text"), F.col("before").isNotNull())
    return asked.select("conv_id", "turn", follow.alias("follow_up"), F.when(follow, F.concat(F.trim("before"), F.lit(" — "), F.trim("text"))).otherwise(F.col("text")).alias("query"))


def relabelled(words: DataFrame, windows: DataFrame, margin: float, fallback: str | None = None) -> DataFrame:
    """The label of the first window (speaker, w_start, w_end, label, margin) that holds a word's middle with enough margin; else fallback.

    Windows are hopped over whole seconds, so a word meets only those of its second.
    """
    middle = (F.col("start") + F.col("end")) / 2
    w = words.withColumn("second", F.floor(middle)).withColumn("mid", middle)
    spread = windows.filter(F.col("margin") >= margin).withColumn("second", F.explode(F.sequence(F.floor("w_start"), F.floor("w_end"))))
    joined = w.join(spread, ["conv", "second"], "left").withColumn("ok", (F.col("mid") >= F.col("w_start")) & (F.col("mid") < F.col("w_end")))
    label = F.min_by(F.when(F.col("ok"), F.col("label")), F.when(F.col("ok"), F.col("w_start")))
    return joined.groupBy("conv", "word_id").agg(F.coalesce(label, F.lit(fallback).cast("string")).alias("label"))


def smoothed(words: DataFrame, shortest: float) -> DataFrame:
    """Words (conv, word_id, start, end, label) in which a run of one label that lasts less than `shortest` takes the label before it; the first run stays."""
    order = Window.partitionBy("conv").orderBy("start", "word_id")
    new = F.lag("word_id").over(order).isNull() | ~F.col("label").eqNullSafe(F.lag("label").over(order))
    runs = words.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(order))
    whole = Window.partitionBy("conv", "run").orderBy("start", "word_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stays = (F.last("end").over(whole) - F.first("start").over(whole) >= shortest) | (F.col("run") == 1)
    kept = F.last(F.when(F.col("stays"), F.struct("label")), ignorenulls=True).over(order)
    return runs.withColumn("stays", stays).withColumn("label", kept["label"]).select("conv", "word_id", "label")


def best_label(scores: DataFrame) -> DataFrame:
    """(segment, label, score, margin): the best label and how far it is ahead; 1 without a second one."""
    order = Window.partitionBy("segment").orderBy(F.desc("score"), "label")
    return scores.withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("score").over(order)).filter("place = 1").select("segment", "label", "score", F.when(F.col("next").isNull(), 1.0).otherwise(F.round(F.col("score") - F.col("next"), 6)).alias("margin"))
