"""Lines, paragraphs, parts and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse
from .order import running
from .resolve import order_statistics


def lines(docs: DataFrame) -> DataFrame:
    """(page, line_no from 0, text) of every document."""
    return docs.filter("text IS NOT NULL").select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n")).alias("line_no", "text"))


def recurring_edges(docs: DataFrame, share: float = 0.3) -> DataFrame:
    """First and last lines that stand on more than a share of the pages, after collapsing white space."""
    split = docs.filter("text IS NOT NULL").select("doc_id", F.split("text", "\n").alias("l"))
    ends = split.select(F.explode(F.array(F.struct(F.lit("header").alias("edge"), collapse(F.element_at("l", 1)).alias("norm")), F.struct(F.lit("footer").alias("edge"), collapse(F.element_at("l", -1)).alias("norm")))).alias("e")).select("e.*")
    counts = ends.filter("norm <> ''").groupBy("edge", "norm").agg(F.count(F.lit(1)).alias("n"))
    pages = split.agg(F.count(F.lit(1)).alias("pages"))
    return counts.join(F.broadcast(pages), F.col("n") >= F.floor(F.col("pages") * share) + 1).select("edge", "norm", "n")


def without_edges(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Lines (page, line_no, text) without the runs of recurring lines at either end of a page."""
    marked = rows.withColumn("norm", collapse(F.col("text")))
    for edge in ("header", "footer"):
        marked = marked.join(found.filter(F.col("edge") == edge).select("norm", F.lit(True).alias(edge)), "norm", "left")
    page = Window.partitionBy("page")
    first = F.min(F.when(F.col("header").isNull(), F.col("line_no"))).over(page)
    last = F.max(F.when(F.col("footer").isNull(), F.col("line_no"))).over(page)
    return marked.withColumn("first", first).withColumn("last", last).filter("line_no BETWEEN first AND last").select("page", "line_no", "text")


def paragraphs(rows: DataFrame, min_tokens: int) -> DataFrame:
    """Each line that isn't blank is a paragraph, with offsets into its page and its number of words."""
    before = Window.partitionBy("page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)))
    kept = placed.withColumn("text", F.trim("text")).filter("text <> ''")
    order = Window.partitionBy("page").orderBy("line_no")
    return kept.select("page", (F.row_number().over(order) - 1).alias("i"), "start", (F.col("start") + F.length("text")).alias("stop"), F.size(F.split("text", r"\s+")).alias("tokens"), "text").withColumn("small", F.col("tokens") < min_tokens)


def chunk_starts(found: DataFrame) -> DataFrame:
    """Marks the paragraphs that begin a chunk.

    A small paragraph takes the next one of its page; so a paragraph is taken if an odd number of small ones stands
    directly before it. A last small one that isn't taken goes back to the chunk before, unless it is alone.
    """
    order = Window.partitionBy("page").orderBy("i")
    runs = found.withColumn("last_big", F.max(F.when(~F.col("small"), F.col("i"))).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    runs = runs.withColumn("run", F.col("i") - F.coalesce("last_big", F.lit(-1)) - 1).withColumn("final", F.lead("i").over(order).isNull())
    taken = F.col("run") % 2 == 1
    return runs.withColumn("opens", ~(taken | (F.col("final") & F.col("small") & (F.col("i") > 0))))


def chunks(found: DataFrame) -> DataFrame:
    """(page, chunk, first and last paragraph, tokens, n, merged) of every chunk, numbered in its page from 1."""
    order = Window.partitionBy("page").orderBy("i")
    numbered = chunk_starts(found).withColumn("chunk", F.sum(F.col("opens").cast("int")).over(order))
    return numbered.groupBy("page", "chunk").agg(F.min("i").alias("first"), F.max("i").alias("last"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"), F.min("start").alias("char_start"), F.max("stop").alias("char_end")).withColumn("merged", F.col("n") > 1)


def chunk_ids(found: DataFrame) -> DataFrame:
    """Chunks with the name ch_0001 and on, numbered over all pages: the chunks of earlier pages plus the place in the page."""
    per_page = found.groupBy("page").agg(F.max("chunk").alias("k"))
    before = running(per_page, ["page"], "k").select("page", (F.col("upto") - F.col("k")).alias("before"))
    return found.join(before, "page").select(F.concat(F.lit("ch_"), F.lpad((F.col("before") + F.col("chunk")).cast("string"), 6, "0")).alias("chunk_id"), "page", "chunk", "tokens", "merged")


def token_stats(found: DataFrame) -> DataFrame:
    """Least, most, mean, median and nearest-rank 95th value of the chunks' tokens."""
    n = F.col("n")
    places = order_statistics(found, "tokens", {"least": F.lit(0), "low": F.floor((n - 1) / 2), "high": F.floor(n / 2), "p95": F.ceil(n * 95 / 100) - 1})
    mean = found.agg(F.round(F.avg("tokens"), 6).alias("mean"))
    return places.crossJoin(F.broadcast(mean)).select("least", "max", "mean", ((F.col("low") + F.col("high")) / 2).alias("median"), "p95")  # one row each


def assigned(rows: DataFrame, parts: DataFrame, at: Column) -> DataFrame:
    """Range join: the part (number, lo, hi) whose half-open range holds the place; parts are few and travel whole."""
    return rows.join(F.broadcast(parts), (at >= F.col("lo")) & (at < F.col("hi")), "left")


def blank_runs(rows: DataFrame, least: int = 3) -> DataFrame:
    """Runs of blank lines of at least the given length."""
    order = Window.partitionBy("page").orderBy("line_no")
    blank = rows.withColumn("blank", F.trim("text") == "").withColumn("island", F.col("line_no") - F.sum(F.col("blank").cast("int")).over(order))
    return blank.filter("blank").groupBy("page", "island").agg(F.min("line_no").alias("first"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("page", "first", "n")


def rule_fold(docs: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Regex rules (id, pattern, replacement) in order, each on what the one before left; matches are counted by rule."""
    text, counts = F.col("text"), []
    for name, pattern, replacement in rules:
        counts.append(F.regexp_count(text, F.lit(pattern)).alias(f"n_{name}"))
        text = F.regexp_replace(text, pattern, replacement)
    return docs.select("doc_id", *counts, text.alias("clean"))
