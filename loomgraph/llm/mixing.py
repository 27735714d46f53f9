"""Mixing sources to target weights by systematic sampling, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import column, stage, unpacked, whole_row, word_count

#: Expected copies are counted in units of 2**-24, so that positions are whole numbers.
UNIT_BITS = 24
#: monotonically_increasing_id() puts the partition above these bits.
ROW_BITS = 33


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """Adds rank, target and source_size to one row per source (columns source, n, words).

    Sources weigh `weights`, repeating, in code point order, null last, and share `share` times all words. A target
    stops at `limit` times its source's words; the excess is reshared by weight until no target is above. In order of
    words per weight the sources that stop come first, so the level that the others reach is found in one pass.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    weighed = weighed.withColumn("cap", F.lit(float(limit)) * F.col("words")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(float(share)) * F.sum("words").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = weighed.withColumn("level", level)
    reached = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank"))).over(everything)
    return levelled.withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("weight") * reached, F.col("cap")))).select(
        "source", "words", "target"
    )


def sampling_plan(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: Sequence[str] = (),
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    limit: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """How many copies of each document the mix takes.

    Every document of a source is expected target / source words times. Documents of a source stand in the order of
    (size, key); the prefix sum of their expected copies starts at one random offset per source, and a document is
    emitted once for each whole number that its interval crosses. As the order is by size, every stretch of sizes is
    taken alike, and the words taken differ from the target by about one document.

    The order comes from one range partitioning on (source, size, key): a hot source fills many partitions. Ranks are
    the row's place in its partition plus the counts of the source in earlier partitions.

    Returns key, source, size, source_size, target, copies, taken and `carry` as the struct `row`. Null text has size
    0; null source is a source of its own, the last; repeated rows are separate documents; documents of equal key and
    size may swap copies; an empty table gives an empty result.
    """
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("key").asc_nulls_last()]
    rows = docs.select(
        column(key).alias("key"), column(source).alias("source"), word_count(column(text)).alias("size"), *whole_row(carry)
    )
    placed = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "mixing")
    placed = placed.withColumn("part", F.shiftright("at", ROW_BITS))
    parts = placed.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"), F.sum("size").alias("words"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("words").alias("words")), weights, share, limit)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("source", "part", "first_at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skipped"))
    expected = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words") * F.lit(1 << UNIT_BITS))).otherwise(F.lit(0)).cast("long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    offset = F.conv(F.substring(F.md5(name), 1, UNIT_BITS // 4), 16, 10).cast("long")
    t = targets.select(F.col("source").alias("t_source"), F.col("words").alias("source_size"), "target", expected.alias("step"), offset.alias("offset"))
    starts = starts.join(t, F.col("source").eqNullSafe(F.col("t_source")), "left").select(
        F.col("source").alias("p_source"), F.col("part").alias("p_part"), "first_at", "skipped", "source_size", "target", "step", "offset"
    )
    joined = placed.join(starts, (F.col("part") == F.col("p_part")) & F.col("source").eqNullSafe(F.col("p_source")), "left")
    place = F.col("skipped") + F.col("at") - F.col("first_at")
    copies = F.shiftright((place + 1) * F.col("step") + F.col("offset"), UNIT_BITS) - F.shiftright(place * F.col("step") + F.col("offset"), UNIT_BITS)
    return joined.select("key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *(["row"] if carry else []))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of docs, each as often as sampling_plan() takes it; same columns, same options."""
    plan = sampling_plan(docs, carry=docs.columns, **options)
    return plan.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*unpacked(docs.columns))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    plan = sampling_plan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return plan.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM d GROUP BY source
), w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rank - 1) % 3 + 1] AS weight, 2.0::DOUBLE * words AS cap FROM s
), l AS (
  SELECT *, cap / weight AS ratio,
    (1.5::DOUBLE * (SELECT sum(words)::DOUBLE FROM w)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((SELECT sum(weight) FROM w)
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w
), r AS (SELECT level AS reached FROM l WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
t AS (
  SELECT source, words, least(cap, coalesce(weight * (SELECT reached FROM r), cap)) AS target,
    ('0x' || substr(md5('17:' || coalesce('s' || source, 'n')), 1, 6))::BIGINT AS off
  FROM l
), p AS (
  SELECT d.*, t.words, t.target, t.off,
    CASE WHEN t.words > 0 THEN floor(t.target / t.words * 16777216)::BIGINT ELSE 0 END AS step,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (SELECT *, ((k * step + off) >> 24) - (((k - 1) * step + off) >> 24) AS copies FROM p)
SELECT doc_id, size, words AS source_size, target, copies * size AS taken, copies FROM c
"""
