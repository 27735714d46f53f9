"""Pages: indents, paragraphs over lines, parts under titles, lists of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse
from .resolve import order_statistics


def indented(rows: DataFrame, beyond: float = 5.0, least: int = 3) -> DataFrame:
    """Lines (page, line_no, text, x0) with whether they begin further right than the median of their page's lines that
    aren't blank; a page of fewer such lines takes the median of all. Null x0 is no indent."""
    full = rows.filter((F.trim("text") != "") & F.col("x0").isNotNull())
    n = F.col("n")
    whole = order_statistics(full, "x0", {"low": F.floor((n - 1) / 2), "high": F.floor(n / 2)}).select(((F.col("low") + F.col("high")) / 2).alias("of_all"))
    own = full.groupBy("page").agg(F.median("x0").alias("of_page"), F.count(F.lit(1)).alias("lines"))
    joined = rows.join(own, "page", "left").join(F.broadcast(whole))  # one row
    median = F.when(F.col("lines") >= least, F.col("of_page")).otherwise(F.col("of_all"))
    return joined.select("page", "line_no", "text", F.coalesce(F.col("x0") > median + beyond, F.lit(False)).alias("indented"))


def reconstructed(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """Paragraphs (page, para, text, first, n) from lines (page, line_no, text, indented): one begins after a blank line,
    at an indented line, and at and after a title (column title), which stands alone; lines are joined by one blank."""
    marked = rows.withColumn("flat", collapse(F.col("text"))).join(titles.select(F.col("title").alias("flat"), F.lit(True).alias("is_title")).distinct(), "flat", "left")
    order = Window.partitionBy("page").orderBy("line_no")
    before = lambda c: F.lag(c).over(order)
    opens = F.coalesce(before(F.col("flat")) == "", F.lit(True)) | F.col("is_title").isNotNull() | before(F.col("is_title")).isNotNull() | F.col("indented")
    lines = marked.withColumn("opens", opens).filter("flat <> ''").withColumn("para", F.sum(F.col("opens").cast("int")).over(order))
    grouped = lines.groupBy("page", "para").agg(F.array_sort(F.collect_list(F.struct("line_no", "flat"))).alias("x"))
    return grouped.select("page", "para", F.array_join(F.transform("x", lambda x: x["flat"]), " ").alias("text"), F.col("x")[0]["line_no"].alias("first"), F.size("x").alias("n"))


def blocks(docs: DataFrame) -> DataFrame:
    """(page, i, start, stop, text) of the blocks between empty lines of each raw text (page, raw)."""
    cut = docs.select("page", F.posexplode(F.split("raw", "\n\n")).alias("i", "text"))
    before = Window.partitionBy("page").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("start", F.coalesce(F.sum(F.length("text") + 2).over(before), F.lit(0)).cast("long"))
    return placed.select("page", "i", "start", (F.col("start") + F.length("text")).alias("stop"), "text")


def part_structure(docs: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parts, status) of raw texts (page, raw) by titles (number from 1, title) that must stand as blocks, once each and in order.

    status has a row for each page: missing, duplicate, out of order or ok. parts has a row for each title of an ok
    page, with the places of the title and of its body, which has no line feeds or blanks at its ends.
    """
    n = titles.count()  # titles are few
    hits = blocks(docs).withColumn("title", F.regexp_replace("text", r"^\s+|\s+$", "")).join(F.broadcast(titles), "title")
    per = hits.groupBy("page", "number").agg(F.count(F.lit(1)).alias("times"), F.min("start").alias("start"), F.min("stop").alias("stop"))
    order = Window.partitionBy("page").orderBy("number")
    per = per.withColumn("next", F.lead("start").over(order))
    status = docs.select("page").join(per.groupBy("page").agg(F.count(F.lit(1)).alias("k"), F.max("times").alias("most"), F.max((F.col("next") < F.col("start")).cast("int")).alias("back")), "page", "left")
    status = status.select("page", F.when(F.coalesce("k", F.lit(0)) < n, "missing").when(F.col("most") > 1, "duplicate").when(F.col("back") == 1, "out of order").otherwise("ok").alias("status"))
    found = per.join(status.filter("status = 'ok'").select("page"), "page").join(docs, "page").join(F.broadcast(titles), "number")
    until = F.coalesce("next", F.length("raw").cast("long"))
    body = F.expr("substring(raw, CAST(stop + 1 AS INT), CAST(coalesce(next, length(raw)) - stop AS INT))")
    lead = F.length(F.regexp_extract(body, r"^[\n ]*", 0))
    tail = F.length(F.regexp_extract(body, r"[\n ]*$", 0))
    return found.select("page", "number", "title", "start", "stop", (F.col("stop") + lead).alias("body_start"), F.greatest(F.col("stop") + lead, until - tail).alias("body_end")), status


def title_pages(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """(title, page, status) for every title from lines (page, text): the page if exactly one line is the title, else missing or repeated."""
    found = rows.select("page", F.trim("text").alias("title")).join(titles.select("title").distinct(), "title").groupBy("title").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("page"))
    return titles.select("title").distinct().join(found, "title", "left").select("title", F.when(F.col("n") == 1, F.col("page")).alias("page"), F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").otherwise("ok").alias("status"))


def without_titles(paragraphs: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, titles) of paragraphs (page, start, stop, text): titles are those that stand where a part's title (page,
    start, stop, title) does, or whose trimmed text is one of their page's titles."""
    spans = parts.select("page", "start", "stop", F.lit(True).alias("by_span")).distinct()
    texts = parts.select("page", F.col("title").alias("trimmed"), F.lit(True).alias("by_text")).distinct()
    marked = paragraphs.withColumn("trimmed", F.regexp_replace("text", r"^\s+|\s+$", "")).join(spans, ["page", "start", "stop"], "left").join(texts, ["page", "trimmed"], "left")
    hit = F.col("by_span").isNotNull() | F.col("by_text").isNotNull()
    columns = ["page", "start", "stop", "text"]
    return marked.filter(~hit).select(*columns), marked.filter(hit).select(*columns)


def compact_lists(pages: DataFrame, most: int = 20) -> DataFrame:
    """(grp, pages) from (grp, page): all pages, or from `most` on the runs of neighbours as a-b."""
    order = Window.partitionBy("grp").orderBy("page")
    runs = pages.distinct().withColumn("island", F.col("page") - F.row_number().over(order)).groupBy("grp", "island").agg(F.min("page").alias("a"), F.max("page").alias("b"))
    listed = runs.groupBy("grp").agg(F.sum(F.col("b") - F.col("a") + 1).alias("n"), F.array_sort(F.collect_list(F.struct("a", "b"))).alias("x"))
    text = lambda c: c.cast("string")
    ranges = F.transform("x", lambda r: F.when(r["a"] == r["b"], text(r["a"])).otherwise(F.concat(text(r["a"]), F.lit("-"), text(r["b"]))))
    single = F.flatten(F.transform("x", lambda r: F.transform(F.sequence(r["a"], r["b"]), text)))
    return listed.select("grp", F.array_join(F.when(F.col("n") <= most, single).otherwise(ranges), ", ").alias("pages"))


def hyphen_residue(rows: DataFrame) -> DataFrame:
    """Lines (page, line_no, text) that end in a single hyphen or dash after a letter or digit, if the next line of the
    page doesn't begin with a small letter; with the first 80 characters of both."""
    order = Window.partitionBy("page").orderBy("line_no")
    told = rows.withColumn("next", F.lead("text").over(order)).withColumn("bare", F.regexp_replace("text", r"[ \t]+$", ""))
    hit = F.rlike("bare", F.lit(r"[\p{L}\p{N}][-–—]$")) & ~F.rlike("next", F.lit(r"^[ \t]*\p{Ll}"))
    return told.filter(F.col("next").isNotNull() & hit).select("page", "line_no", F.substring(F.concat("text", F.lit("\n"), "next"), 1, 80).alias("context"))


def joined_pages(rows: DataFrame, separator: str) -> DataFrame:
    """One text for each book (book, page, text): its pages in order."""
    return rows.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), separator).alias("text"))
