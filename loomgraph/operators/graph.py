"""Graph operators: degrees, hubs, components, cycles, one-hop expansion, chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import TYPE_RANK
from ..functions.staging import drop, stage
from .order import quantiles


def simple_pairs(edges: DataFrame) -> DataFrame:
    """Unordered pairs of joined nodes, once each; parallel edges collapse."""
    return edges.select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).distinct()


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Simple degree of every node (id, type); a self loop counts twice."""
    ends = simple_pairs(edges).select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return nodes.select("id", "type").join(ends, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def degree_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Degrees by type; quantiles are interpolated."""
    found = stage(degrees(nodes, edges), "degrees")
    q = quantiles(found, "type", "degree", {"median": 0.5, "p90": 0.9, "p99": 0.99}).select("type", *[F.round(c, 4).alias(c) for c in ("median", "p90", "p99")])
    rest = found.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.min("degree").alias("least"), F.max("degree").alias("most"), F.count_if(F.col("degree") <= 1).alias("n_leaves"))
    return rest.join(q, "type").select("type", "n", "least", "most", "median", "p90", "p99", "n_leaves")


def hubs(nodes: DataFrame, edges: DataFrame, k: int = 10) -> DataFrame:
    """The k nodes of each type with the highest degree."""
    best = Window.partitionBy("type").orderBy(F.desc("degree"), "id")
    return degrees(nodes, edges).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a pair of two nodes; the root is the smallest node that paths reach.

    Alternating stars: each round links the larger neighbours of every node to its smallest one, then the smaller ones;
    the rounds grow with the logarithm of the nodes, not with the longest path. Pairs of a node with itself and pairs
    with a null count for nothing. The smallest neighbours are written before they are joined, so that the rows of a
    star's centre come to the join in an exchange that Spark may split. Only two sums come to the driver.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    held = stage(pairs.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "components")
    sums = F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.lit(0)).alias("s")
    before = held.agg(*sums).first()
    while before["n"]:
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        best = stage(large.groupBy("u").agg(F.min("v").alias("m")), "best")
        links = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        small = large.join(best, "u").select(links.alias("x")).select("x.u", "x.v")
        last, held = held, stage(small.filter("u > v").distinct(), "components")
        drop(last, least, best)
        after = held.agg(*sums).first()
        if after == before:
            break
        before = after
    return held.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(held.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def component_sizes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """How many components have each size; a node without an edge is one of its own."""
    found = components(simple_pairs(edges))
    ids = nodes.select(F.col("id").alias("node")).distinct().join(found, "node", "left")
    return ids.groupBy(F.coalesce("root", "node").alias("root")).agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n"))


def one_hop(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges that leave or reach the seeds (column id), in walking direction; `reversed` marks those walked backwards."""
    forward = edges.select("source", "target", "type", "role", F.lit(False).alias("reversed"))
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "type", "role", F.lit(True).alias("reversed"))
    return forward.unionByName(back).join(seeds.select(F.col("id").alias("source")).distinct(), "source", "left_semi").distinct()


def type_rank(kind: Column) -> Column:
    out = F.lit(9)
    for i, t in enumerate(TYPE_RANK):
        out = F.when(kind == t, i).otherwise(out)
    return out


def trimmed(seeds: DataFrame, neighbours: DataFrame, nodes: DataFrame, most: int, hub: int = 20) -> DataFrame:
    """Seeds first, then neighbours, up to `most` nodes: no hubs before hubs, then by type and id."""
    ids = seeds.select("id", F.lit(0).alias("ring")).unionByName(neighbours.select("id", F.lit(1).alias("ring"))).groupBy("id").agg(F.min("ring").alias("ring"))
    known = ids.join(nodes.groupBy("id").agg(F.min("type").alias("type"), F.sum("n_provenances").alias("n")), "id")
    ordered = known.orderBy("ring", (F.col("n") >= hub).cast("int"), type_rank(F.col("type")), "id").limit(most)
    return ordered.select("id", "type", "ring")


def peel(edges: DataFrame) -> DataFrame:
    """The edges that are left when nodes without incoming edges go, again and again: none if there is no cycle.

    Edges behind a cycle stay as well.
    """
    left = stage(edges.filter("source <> target"), "peel")
    n = left.count()
    while n:
        last, left = left, stage(left.join(left.select(F.col("target").alias("source")).distinct(), "source", "left_semi"), "peel")
        drop(last)
        m = left.count()
        if m == n:
            break
        n = m
    return left


def break_cycles(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) of edges (source, target, confidence, pos): of what peel() leaves, the least certain goes, the
    first read of equals, until nothing is left.

    Parts of the rest that no edge joins don't touch each other, so each round takes the least certain edge of every
    such part, and peels only what was left. Only whether edges are left comes to the driver.
    """
    columns, gone = edges.columns, []
    left = peel(edges)
    while not left.isEmpty():
        parts = components(left, "source", "target").select(F.col("node").alias("source"), "root")
        worst = left.join(parts, "source").groupBy("root").agg(F.min_by(F.struct(*columns), F.struct("confidence", "pos", "source", "target")).alias("x")).select("x.*")
        gone.append(stage(worst, "cycle-edges"))
        left = peel(left.exceptAll(gone[-1]))
    removed = reduce(DataFrame.unionByName, gone) if gone else edges.limit(0)
    return edges.exceptAll(removed), removed


def caps(edges: DataFrame) -> DataFrame:
    """What role each end of a hierarchy has: cap (only a target), intermediate (both) or leaf (only a source)."""
    ends = edges.select(F.col("source").alias("id"), F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(edges.select(F.col("target").alias("id"), F.lit(0).alias("s"), F.lit(1).alias("t")))
    return ends.groupBy("id").agg(F.when(F.max("s") == 0, "cap").when(F.max("t") == 1, "intermediate").otherwise("leaf").alias("part"), F.sum("t").alias("n_under"))


def reciprocal(edges: DataFrame, kind: str) -> DataFrame:
    """Pairs joined both ways by edges of one type."""
    e = edges.filter(F.col("type") == kind).select("source", "target").distinct()
    return e.join(e.select(F.col("target").alias("source"), F.col("source").alias("target")), ["source", "target"]).filter("source < target")


def same_clusters(judgments: DataFrame, freq: DataFrame, apply_from: float = 0.97) -> DataFrame:
    """Components of pairs (a, b, verdict, confidence) judged the same.

    The confidence of a cluster is that of its least certain pair; a pair inside that was judged a refinement makes it
    a conflict; from `apply_from` on it is applied, below it goes to review. The canonical id has the highest freq.
    """
    same = judgments.filter("verdict = 'same'")
    roots = stage(components(same), "clusters")
    inside = judgments.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").filter("ra = rb")
    marks = inside.groupBy(F.col("ra").alias("root")).agg(F.min(F.when(F.col("verdict") == "same", F.col("confidence"))).alias("confidence"), F.max((F.col("verdict") == "refinement").cast("int")).alias("conflict"))
    members = roots.join(freq, roots["node"] == freq["id"]).groupBy("root").agg(F.array_join(F.array_sort(F.collect_list("node")), ",").alias("members"), F.count(F.lit(1)).alias("n"), F.min_by("node", F.struct(-F.col("freq"), "node")).alias("canonical_id"))
    return members.join(marks, "root").filter("n > 1").select("canonical_id", "members", F.round("confidence", 6).alias("confidence"), F.when(F.col("conflict") == 1, "conflict").when(F.col("confidence") >= apply_from, "applied").otherwise("review").alias("status"))
