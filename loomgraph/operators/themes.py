"""Themes: merges of judged clusters, caps and orphans of a hierarchy, and the checks on judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def canonical_map(clusters: DataFrame) -> DataFrame:
    """(loser, canonical_id) of the applied clusters (canonical_id, members joined by commas, status)."""
    members = clusters.filter("status = 'applied'").select(F.col("canonical_id").cast("string").alias("canonical_id"), F.explode(F.split("members", ",")).alias("loser"))
    return members.filter("loser <> canonical_id").select("loser", "canonical_id")


def promoted(clusters: DataFrame, edited: DataFrame) -> DataFrame:
    """Clusters after a manual edit (members, canonical_id, applied): a cluster in review of exactly these members is
    applied, with the edited canonical id if that is a member; edits of other clusters count for nothing."""
    e = edited.filter("applied").select("members", F.col("canonical_id").cast("string").alias("chosen")).filter(F.array_contains(F.split("members", ","), F.col("chosen"))).dropDuplicates(["members"])
    joined = clusters.withColumn("canonical_id", F.col("canonical_id").cast("string")).join(e, "members", "left")
    taken = (F.col("status") == "review") & F.col("chosen").isNotNull()
    return joined.select(F.when(taken, F.col("chosen")).otherwise(F.col("canonical_id")).alias("canonical_id"), "members", "confidence", F.when(taken, "applied").otherwise(F.col("status")).alias("status"))


def merged_nodes(nodes: DataFrame, merges: DataFrame) -> DataFrame:
    """Nodes (id, name, aliases, chunk_ids) after the merges: a loser's names and chunks go to its canonical node.

    aliases are all aliases and the names that differ from the canonical one; merged_from are the ids of a merged node.
    Sets come out sorted, joined by commas. A canonical id without a node takes no losers' name.
    """
    rows = nodes.join(merges.withColumnRenamed("loser", "id"), "id", "left").withColumn("final", F.coalesce("canonical_id", "id"))
    own = F.col("id") == F.col("final")
    grouped = rows.groupBy("final").agg(
        F.max(F.when(own, F.col("name"))).alias("name"), F.collect_set("name").alias("names"), F.array_distinct(F.flatten(F.collect_list("aliases"))).alias("aliases"),
        F.array_sort(F.collect_set("id")).alias("ids"), F.size(F.array_distinct(F.flatten(F.collect_list("chunk_ids")))).alias("n_provenances"),
    )
    told = F.array_sort(F.array_distinct(F.concat("aliases", F.filter("names", lambda n: ~n.eqNullSafe(F.col("name"))))))
    return grouped.select(F.col("final").alias("id"), "name", F.array_join(told, ",").alias("aliases"), F.when(F.size("ids") > 1, F.array_join("ids", ",")).otherwise("").alias("merged_from"), "n_provenances")


def merged_edges(edges: DataFrame, merges: DataFrame) -> DataFrame:
    """Edges (source, target, type, role, review_needed) with remapped ends, self loops gone, one for each (source, type, target, role)."""
    s, t = (merges.select(F.col("loser").alias(c), F.col("canonical_id").alias(f"new_{c}")) for c in ("source", "target"))
    moved = edges.join(s, "source", "left").join(t, "target", "left").select(F.coalesce("new_source", "source").alias("source"), F.coalesce("new_target", "target").alias("target"), "type", "role", "review_needed")
    return moved.filter("source <> target").groupBy("source", "target", "type", "role").agg(F.count(F.lit(1)).alias("n"), F.bool_or("review_needed").alias("review_needed"))


def remapped_refinements(refinements: DataFrame, merges: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Refinements (specific, general, confidence, pos) on the merged ids: those in conflicts (specific, general) and
    self pairs go, the first read of equals stays."""
    s, g = (merges.select(F.col("loser").alias(c), F.col("canonical_id").alias(f"new_{c}")) for c in ("specific", "general"))
    left = refinements.join(conflicts.select("specific", "general").distinct(), ["specific", "general"], "left_anti").join(s, "specific", "left").join(g, "general", "left")
    new_s, new_g = F.coalesce("new_specific", "specific"), F.coalesce("new_general", "general")
    moved = left.select(new_s.alias("s"), new_g.alias("g"), "confidence", ((new_s != F.col("specific")) | (new_g != F.col("general"))).alias("remapped"), "pos").filter("s <> g")
    first = moved.groupBy("s", "g").agg(F.min_by(F.struct("confidence", "remapped"), "pos").alias("x"))
    return first.select(F.col("s").alias("specific"), F.col("g").alias("general"), "x.confidence", "x.remapped")


def cap_universe(judged: DataFrame, seeds: DataFrame, names: DataFrame, examples: int = 6) -> DataFrame:
    """Caps that were judged (cap_id, label, member, pos) or are heads of seed edges (specific, general, pos), once each.

    The name is the theme's, else the label, else the id; examples are the names of the first different members, judged
    ones first. judged rows without a member only name a cap.
    """
    told = judged.select("cap_id", "label", "member", F.lit(0).alias("origin"), "pos").unionByName(seeds.select(F.col("general").alias("cap_id"), F.lit(None).cast("string").alias("label"), F.col("specific").alias("member"), F.lit(1).alias("origin"), "pos"))
    first = told.filter("member IS NOT NULL").groupBy("cap_id", "member").agg(F.min(F.struct("origin", "pos")).alias("at"))
    best = Window.partitionBy("cap_id").orderBy("at", "member")
    shown = first.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= examples).join(names.select(F.col("id").alias("member"), F.col("name").alias("shown")), "member", "left")
    shown = shown.groupBy("cap_id").agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("shown", "member").alias("shown")))).alias("x")).select("cap_id", F.array_join(F.transform("x", lambda x: x["shown"]), ", ").alias("examples"))
    caps = told.groupBy("cap_id").agg(F.min_by("label", F.when(F.col("label").isNotNull(), F.struct("origin", "pos", "label"))).alias("label"), F.bool_or(F.col("origin") == 1).alias("is_seed"))
    named = caps.join(names.select(F.col("id").alias("cap_id"), F.col("name").alias("known")), "cap_id", "left").join(shown, "cap_id", "left")
    return named.select("cap_id", F.coalesce("known", "label", "cap_id").alias("name"), "is_seed", F.col("known").isNull().alias("is_new"), F.coalesce("examples", F.lit("")).alias("examples"))


def orphans(unattached: DataFrame, clusters: DataFrame, caps: DataFrame, names: DataFrame) -> DataFrame:
    """Ids that no cap holds: unattached ones (id), then members of clusters (cluster, id) of one; the first origin counts, caps go."""
    alone = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).filter("n = 1").select("id", F.lit("singleton").alias("origin"))
    both = unattached.select("id", F.lit("unattached").alias("origin")).unionByName(alone).groupBy("id").agg(F.max("origin").alias("origin"))
    kept = both.join(caps.select(F.col("cap_id").alias("id")).distinct(), "id", "left_anti").join(names.select("id", "name"), "id", "left")
    return kept.select("id", F.coalesce("name", "id").alias("name"), "origin")


def described(clusters: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Members (cluster, id) of clusters of at least so many, with name and description; an id without a text keeps its id as the name."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= least)
    return clusters.join(sizes, "cluster").join(texts.select("id", "name", "description"), "id", "left").select("cluster", "size", "id", F.coalesce("name", "id").alias("name"), "description", F.col("name").isNull().alias("unknown"))


def injected(clusters: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seed edges (specific, general, confidence) with both ends in one cluster (cluster, id)."""
    s, g = clusters.select("cluster", F.col("id").alias("specific")), clusters.select("cluster", F.col("id").alias("general"))
    return seeds.join(s, "specific").join(g, ["cluster", "general"]).select("cluster", "specific", "general", "confidence")


def checked_judgments(replies: DataFrame) -> DataFrame:
    """Replies (a, b, verdict, general_id): an unknown verdict is an error, a refinement whose general id is neither goes to review."""
    known = F.col("verdict").isin("same", "refinement", "distinct")
    alien = (F.col("verdict") == "refinement") & ~F.coalesce((F.col("general_id") == F.col("a")) | (F.col("general_id") == F.col("b")), F.lit(False))
    return replies.select("a", "b", F.when(known, F.col("verdict")).otherwise("error").alias("verdict"), F.when(alien, F.lit(None)).otherwise(F.col("general_id")).alias("general_id"), F.coalesce(~known | alien, F.lit(True)).alias("review"))


def partition_warnings(clusters: DataFrame, claims: DataFrame) -> DataFrame:
    """One row for each cluster: how many caps beyond two, ids that are no members, ids claimed twice, members without a claim.

    clusters are (cluster, id), claims (cluster, id, part).
    """
    per = claims.groupBy("cluster", "id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("part") == "cap").alias("caps"))
    both = clusters.select("cluster", "id", F.lit(True).alias("member")).distinct().join(per, ["cluster", "id"], "full")
    return both.groupBy("cluster").agg(
        F.greatest(F.sum(F.coalesce("caps", F.lit(0))) - 2, F.lit(0)).alias("caps_beyond_two"), F.count_if(F.col("member").isNull()).alias("aliens"), F.count_if(F.col("n") > 1).alias("claimed_twice"), F.count_if(F.col("n").isNull()).alias("unclaimed"),
    )


def checked_orphans(decisions: DataFrame) -> DataFrame:
    """Decisions (orphan, action, cap_id, shortlist): a cap outside the shortlist makes the orphan stand alone."""
    outside = (F.col("action") == "specializes") & ~F.coalesce(F.array_contains("shortlist", F.col("cap_id")), F.lit(False))
    return decisions.select("orphan", F.when(outside, "standalone").otherwise(F.col("action")).alias("action"), F.when(outside | (F.col("action") != "specializes"), F.lit(None)).otherwise(F.col("cap_id")).alias("cap_id"))


def attachments(decisions: DataFrame, k: int = 12) -> DataFrame:
    """The caps with the most orphans."""
    held = decisions.filter("action = 'specializes'").groupBy("cap_id").agg(F.count(F.lit(1)).alias("n"))
    return held.orderBy(F.desc("n"), "cap_id").limit(k)


def size_buckets(clusters: DataFrame) -> DataFrame:
    """How many clusters have 1, 2-3, 4-6, 7-12 and 13 or more members."""
    n = F.col("n")
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(F.when(n == 1, "1").when(n <= 3, "2-3").when(n <= 6, "4-6").when(n <= 12, "7-12").otherwise("13+").alias("bucket")).agg(F.count(F.lit(1)).alias("n_clusters"))
