"""Places, running sums and quantiles of whole tables, from one range partitioning: no task holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage


def running(rows: DataFrame, by: list[str], amount: str) -> DataFrame:
    """rows with `upto`: the sum of the column amount over all rows up to this one in the order of `by`, equals in any order.

    Rows are dealt by ranges and written; the sums of the partitions before a row's own, one number a partition, are
    added to the sum within it. Nulls come first; an empty table stays empty.
    """
    dealt = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "running")
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_part").agg(F.sum(amount).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumn("_own", F.sum(amount).over(within)).join(F.broadcast(sums), "_part").withColumn("upto", F.col("_before") + F.col("_own")).drop("_part", "_at", "_own", "_before")


def numbered(rows: DataFrame, *by: str) -> DataFrame:
    """rows with `place` from 1 in the order of the columns."""
    return running(rows.withColumn("_one", F.lit(1)), [*by], "_one").withColumnRenamed("upto", "place").drop("_one")


def quantiles(rows: DataFrame, by: str, value: str, wanted: dict[str, float]) -> DataFrame:
    """(by, n, and a column for each wanted share): linearly interpolated quantiles of each group; null values don't count.

    They come from the counts of distinct values, in one order for all groups.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    told = running(counts, ["g", "v"], "c")
    whole = told.groupBy(F.col("g").alias("h")).agg(F.min(F.col("upto") - F.col("c")).alias("start"), F.sum("c").alias("n"))
    joined = told.join(whole, F.col("g").eqNullSafe(F.col("h"))).withColumn("place", F.col("upto") - F.col("start"))
    at = lambda q: F.lit(float(q)) * (F.col("n") - 1)
    low, high = (lambda q: F.min(F.when(F.col("place") > F.floor(at(q)), F.col("v")))), (lambda q: F.min(F.when(F.col("place") > F.ceil(at(q)), F.col("v"))))
    found = joined.groupBy("g", "n").agg(*[low(q).alias(f"_l_{c}") for c, q in wanted.items()], *[high(q).alias(f"_h_{c}") for c, q in wanted.items()])
    share = lambda q: at(q) - F.floor(at(q))
    return found.select(F.col("g").alias(by), "n", *[(F.col(f"_l_{c}") + share(q) * (F.col(f"_h_{c}") - F.col(f"_l_{c}"))).alias(c) for c, q in wanted.items()])
