"""Scans and sinks of documents, graphs, rule tables and indexes in a folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.staging import shared_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def _sorted(value: Column, kind) -> Column:
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_sorted(value.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        return F.transform(value, lambda x: _sorted(x, kind.elementType))
    return value


def sorted_keys(df: DataFrame) -> DataFrame:
    """The same rows with the keys of every object in order of their names."""
    return df.select(*[_sorted(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def write_json(df: DataFrame, path: str, sort_keys: bool = False) -> None:
    """One object a line, keys in order of their names or of the columns; null fields are left out."""
    (sorted_keys(df) if sort_keys else df).write.mode("overwrite").json(path)


def write_atomic(df: DataFrame, path: str) -> None:
    """Parquet that appears at path all at once: written beside it, then renamed; what was there goes."""
    spark, beside = df.sparkSession, f"{path}.{uuid.uuid4().hex}.tmp"
    df.write.parquet(beside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(hadoop.Path(path), True)
    if not files.rename(hadoop.Path(beside), hadoop.Path(path)):
        raise OSError(f"{beside} could not be renamed")


def write_graph(nodes: DataFrame, edges: DataFrame, log: DataFrame, path: str) -> None:
    """A graph as a folder: nodes and edges as Parquet, its log as JSON."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")
    write_json(log, f"{path}/log", sort_keys=True)


def read_graph(spark: SparkSession, path: str, nodes: str, edges: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of write_graph() under declared schemas."""
    return spark.read.schema(nodes).parquet(f"{path}/nodes"), spark.read.schema(edges).parquet(f"{path}/edges")


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON under a declared schema; a missing path and malformed lines give no rows."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_envelopes(spark: SparkSession, path: str | list[str], one: str) -> DataFrame:
    """Extractions of files that hold one each, or several under `extractions`; one is the schema of an extraction."""
    kind = StructType.fromDDL(one)
    both = spark.read.schema(StructType([*kind.fields, StructField("extractions", ArrayType(kind))])).json(path)
    names = [c for c in both.columns if c != "extractions"]
    return both.select(F.explode(F.coalesce("extractions", F.array(F.struct(*names)))).alias("x")).select("x.*")


def with_metadata(extractions: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """Extractions (run, header, ...) with the metadata of their run: from the log (run and the keys), else from their own header."""
    told = log.select("run", *[F.col(k).alias(f"_{k}") for k in keys])
    return extractions.join(told, "run", "left").select(*[c for c in extractions.columns if c != "header"], *[F.coalesce(f"_{k}", F.col("header").getField(k)).alias(k) for k in keys])


def rule_table(lines: DataFrame) -> DataFrame:
    """(id, pattern, replacement, enabled, problem) from the lines (no, line) of a rule file: a rule begins with a dash,
    its fields are `key: value`. Rules are few. problem names a missing field, an id that repeats or an empty pattern."""
    from pyspark.sql import Window

    field = lambda i: F.regexp_extract("line", r"^\s*-?\s*(\w+):\s*(?:'(.*)'|\"(.*)\"|(.*?))\s*$", i)
    cut = lines.withColumn("rule", F.sum(F.rlike("line", F.lit(r"^\s*- ")).cast("int")).over(Window.orderBy("no"))).filter("rule > 0")
    pairs = cut.select("rule", field(1).alias("key"), F.concat(field(2), field(3), field(4)).alias("value")).filter("key <> ''")
    rules = pairs.groupBy("rule").pivot("key", ["id", "pattern", "replacement", "enabled"]).agg(F.first("value"))
    times = F.count(F.lit(1)).over(Window.partitionBy("id"))
    problem = F.when(F.col("id").isNull() | F.col("pattern").isNull() | F.col("replacement").isNull() | F.col("enabled").isNull(), "missing field").when(times > 1, "repeated id").when((F.col("pattern") == "") & (F.col("enabled") == "true"), "empty pattern")
    return rules.select("id", "pattern", "replacement", (F.col("enabled") == "true").alias("enabled"), problem.alias("problem"))


def themes(graph: DataFrame) -> DataFrame:
    """(id, name, freq) of the Theme nodes (id, type, name, provenances) of a graph."""
    return graph.filter("type = 'Theme'").select("id", "name", F.size("provenances").alias("freq"))


def adjacency(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges (source, target, type) in both directions, without those that lack a node."""
    ids = nodes.select("id").distinct()
    whole = edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    return whole.select("source", "target", "type", F.lit(False).alias("reversed")).unionByName(whole.select(F.col("target").alias("source"), F.col("source").alias("target"), "type", F.lit(True).alias("reversed")))


def write_index(vectors: DataFrame, path: str, model: str) -> None:
    """An index of chunks (chunk_id, part, text, v): unit vectors in single precision, and a manifest of one row with the
    model, the number of chunks and a digest of their ids and texts. A chunk without a vector is an error."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.transform("v", lambda x: (x / norm).cast("float"))
    kept = vectors.select("chunk_id", "part", "text", F.when(F.col("v").isNull(), F.raise_error(F.lit("a chunk without a vector"))).otherwise(unit).alias("v"))
    kept.write.mode("overwrite").parquet(f"{path}/chunks")
    write_json(manifest(vectors, model), f"{path}/manifest", sort_keys=True)


def manifest(chunks: DataFrame, model: str) -> DataFrame:
    """One row (model, n, digest): the digest is a sum over all chunks, in any order."""
    part = F.pmod(F.xxhash64("chunk_id", "text"), F.lit(1 << 40))
    return chunks.agg(F.count(F.lit(1)).alias("n"), F.sum(part).cast("string").alias("digest")).withColumn("model", F.lit(model))


def stale(index: DataFrame, now: DataFrame) -> DataFrame:
    """One row: whether the manifest of an index differs from that of the chunks as they are."""
    old = index.select("model", F.col("n").alias("n_indexed"), F.col("digest").alias("was"))
    return old.join(F.broadcast(now.select("n", "digest"))).select("model", "n_indexed", "n", (~F.col("was").eqNullSafe(F.col("digest"))).alias("stale"))  # one row each


def files_of(spark: SparkSession, path: str, suffixes: list[str]) -> DataFrame:
    """(name, suffix) of the files under a path whose suffix is one of these, whatever its case."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(name.alias("name"))
    return listed.withColumn("suffix", F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1))).filter(F.col("suffix").isin([s.lower().lstrip(".") for s in suffixes]))


def upsert_statement(kind: Column) -> Column:
    """The statement that inserts or updates a node of a type in a property graph."""
    return F.concat(F.lit("MERGE (n:Node {id: $id}) SET n:"), kind, F.lit(", n += $props"))


def html_table(rows: DataFrame, group: str, title: str) -> DataFrame:
    """(group, html): a page for each value of `group` with a table of its rows, in order of their cells; cells are escaped."""
    names = [c for c in rows.columns if c != group]
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    line = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), safe(c), F.lit("</td>")) for c in names], F.lit("</tr>"))
    head = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{title}</title></head><body><h1>{title}</h1><table><tr>" + "".join(f"<th>{c}</th>" for c in names) + "</tr>"
    return rows.groupBy(group).agg(F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list(line)), ""), F.lit("</table></body></html>")).alias("html"))
