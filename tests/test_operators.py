import itertools

import numpy as np
import pandas as pd
from loomgraph.functions import text as t
from loomgraph.operators import cluster, graph, segment
from loomgraph.sources import documents
from loomgraph.streaming import windows
from pyspark.sql import functions as F


def average_linkage(vectors: np.ndarray, most: float) -> np.ndarray:
    """Labels of the rows (the smallest index of the cluster): the nearest two clusters merge while the mean cosine
    distance of their members is at most `most`; of equals the first pair."""
    n = len(vectors)
    distance = 1 - vectors @ vectors.T
    np.fill_diagonal(distance, np.inf)
    size, label, alive = np.ones(n), np.arange(n), np.ones(n, bool)
    while alive.sum() > 1:
        i, j = divmod(int(np.argmin(distance)), n)
        if distance[i, j] > most:
            break
        i, j = min(i, j), max(i, j)
        merged = (size[i] * distance[i] + size[j] * distance[j]) / (size[i] + size[j])
        size[i] += size[j]
        distance[i], distance[:, i] = merged, merged
        distance[i, i] = np.inf
        distance[j], distance[:, j] = np.inf, np.inf
        alive[j] = False
        label[label == j] = i
    return label


def greedy_echoes(pairs: pd.DataFrame, quota: int) -> pd.DataFrame:
    """Events in order take up to `quota` new partners, the most similar first; a pair that is there counts for nobody."""
    near: dict[int, list[tuple[float, int]]] = {}
    for a, b, c in zip(pairs["a"], pairs["b"], pairs["cosine"], strict=True):
        near.setdefault(a, []).append((-c, b))
        near.setdefault(b, []).append((-c, a))
    found: dict[tuple[int, int], float] = {}
    for event in sorted(near):
        new = 0
        for c, other in sorted(near[event]):
            key = (min(event, other), max(event, other))
            if key not in found and new < quota:
                found[key] = -c
                new += 1
    return pd.DataFrame([(a, b, c) for (a, b), c in found.items()], columns=["a", "b", "cosine"])


def unit(n, d, seed):
    v = np.random.default_rng(seed).normal(size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_clusters_equal_one_group(spark):
    v = unit(40, 4, 1)
    got = {r.id: r.cluster for r in cluster.clusters(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>"), 0.3).collect()}
    assert got == dict(enumerate(average_linkage(v, 0.3).tolist()))


def test_echoes_equal_one_group(spark):
    v, order = unit(40, 4, 2), [i // 2 if i % 7 else None for i in range(40)]
    got = cluster.echoes(spark.createDataFrame([(i, x.tolist(), o) for i, (x, o) in enumerate(zip(v, order, strict=True))], "id long, v array<double>, ord long"), 0.5, 3, 2).collect()
    pairs = [(a, b, float(v[a] @ v[b])) for a, b in itertools.combinations(range(40), 2) if v[a] @ v[b] >= 0.5 and (order[a] is None or order[b] is None or abs(order[a] - order[b]) >= 3)]
    want = greedy_echoes(pd.DataFrame(pairs, columns=["a", "b", "cosine"]), 2)
    assert {(r.a, r.b) for r in got} == set(zip(want["a"], want["b"], strict=True)) and len(want)


def test_cycles(spark):
    rows = [("a", "b", 0.9, 1), ("b", "c", 0.5, 2), ("c", "a", 0.7, 3), ("c", "d", 0.1, 4), ("x", "y", 0.2, 5)]
    kept, gone = graph.break_cycles(spark.createDataFrame(rows, "source string, target string, confidence double, pos long"))
    # an edge behind the cycle has sources too, so the least certain one that is left goes first
    assert [(r.source, r.target) for r in gone.orderBy("pos").collect()] == [("b", "c"), ("c", "d")] and kept.count() == 3


def test_components_of_a_chain(spark):
    got = {r.node: r.root for r in graph.components(spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51)], "a long, b long")).collect()}
    assert got == dict.fromkeys(range(31), 0) | {50: 50, 51: 50}


def test_chunks_equal_a_fold(spark):
    import random

    r = random.Random(1)
    pages = [[r.random() < 0.6 for _ in range(r.randrange(1, 9))] for _ in range(60)]
    rows = [(p, i, i * 10, i * 10 + 5, 1, small) for p, page in enumerate(pages) for i, small in enumerate(page)]
    got = segment.chunks(spark.createDataFrame(rows, "page int, i int, start int, stop int, tokens int, small boolean")).collect()
    want = []
    for p, page in enumerate(pages):
        chunks, i = [], 0
        while i < len(page):
            if page[i] and i + 1 < len(page):
                chunks.append((i, i + 1))
                i += 2
            elif page[i] and chunks:
                chunks[-1] = (chunks[-1][0], i)
                i += 1
            else:
                chunks.append((i, i))
                i += 1
        want += [(p, n + 1, a, b) for n, (a, b) in enumerate(chunks)]
    assert sorted((x.page, x.chunk, x.first, x.last) for x in got) == want


def test_text_scalars(spark):
    row = spark.createDataFrame([("oﬃce co-\nop end--\nx 3x 12 a!!! aB c", 3725.4)], "s string, n double").select(
        t.normalise_characters(F.col("s")).alias("clean"), t.dehyphenate(F.col("s")).alias("joined"), t.broken_words(F.col("s")).alias("n"), t.digit_words(F.col("s")).alias("mixed"),
        t.repeated_signs(F.col("s")).alias("signs"), t.isolated_capitals(F.col("s")).alias("caps"), t.clock(F.col("n")).alias("clock"), t.duration(F.col("n")).alias("took"),
        t.strip_thinking(F.lit("a <think>x</think> b <think> open")).alias("said"), t.slug(F.lit("Città è — qui")).alias("slug"), t.truncate(F.lit("abc  def ghi"), 8).alias("short"),
    ).first()
    assert row.clean.startswith("office") and "coop end--\nx" in row.joined and row.n == 1 and (row.mixed, row.signs, row.caps) == (1, 1, 1)
    assert (row.clock, row.took, row.said, row.slug, row.short) == ("1:02:05", "1h 02m 05s", "a  b", "citta_e_qui", "abc def…")


def test_documents(spark, tmp_path):
    nodes = spark.createDataFrame([("c1", "a", "Event", "A", 0.5, 1), ("c1", "b", "Theme", "B", 0.6, 2), ("c2", "a", "Event", "A", 0.7, 3)], "chunk_id string, id string, type string, name string, confidence double, pos long")
    edges = spark.createDataFrame([("c1", "a", "b", "EMBODIES", None, 0.5, 4)], "chunk_id string, source_id string, target_id string, type string, role string, confidence double, pos long")
    documents.write_extractions(documents.extractions(nodes, edges), f"{tmp_path}/x")
    (tmp_path / "x" / "bad.json").write_text("{nope\n")
    back = documents.read_extractions(spark, f"{tmp_path}/x").cache()
    assert back.filter("_corrupt_record IS NOT NULL").count() == 1
    assert documents.node_occurrences(back).select(*nodes.columns).exceptAll(nodes).isEmpty() and documents.node_occurrences(back).count() == 3
    assert documents.edge_occurrences(back).count() == 1
    (tmp_path / "p.csv").write_text("x,y\n1,2\n\nbad,3\n4,5\n")
    assert sorted(map(tuple, documents.read_points(spark, f"{tmp_path}/p.csv").collect())) == [(1.0, 2.0), (4.0, 5.0)]
    (tmp_path / "t.txt").write_text("one\ntwo")
    assert documents.read_whole_text(spark, f"{tmp_path}/t.txt").first()["text"] == "one\ntwo"
    assert documents.newest(spark, f"{tmp_path}/t.txt").first()["path"].endswith("t.txt") and len(documents.hashes(spark, f"{tmp_path}/t.txt").first()["sha256"]) == 64
    documents.write_table_text(nodes, f"{tmp_path}/tsv")
    assert spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/tsv").count() == 3


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "event_type", "value")
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    q = windows.counts(stream).writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(str, spark.table("counted").collect())) == sorted(map(str, windows.counts(events).collect()))
