"""What large tables need: no broadcast of tables that grow, bounded tasks, and the same results in small blocks."""

import random
from functools import reduce

import numpy as np
from loomgraph.functions import staging
from loomgraph.operators import cluster, health, resolve, retrieve, similar
from loomgraph.plans import catalog, health_queries, retrieval_queries
from loomgraph.sources import adapter
from loomgraph.sources.adapter import nodes
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_tables_that_grow_are_not_broadcast(spark, monkeypatch):
    works = nodes(spark, SF).filter("type = 'Work' AND id LIKE 'pt_%'")
    assert "BroadcastHashJoin" not in plan(works) and "SortMergeJoin" in plan(works)
    monkeypatch.setattr(staging, "SMALL", 0)
    held = staging.stage(spark.range(100), "small-files")
    assert "SortMergeJoin" in plan(spark.range(10**9).join(held, "id"))


def test_provenances_are_not_collected(spark):
    assert "collect_list" not in plan(catalog.QUERIES["slim_provenance"](spark, SF))


def test_grounding_equals_brute_force(spark):
    r = random.Random(3)
    at = {(f"n{r.randrange(12)}", f"c{r.randrange(9)}") for _ in range(40)} | {("hub", f"c{i}") for i in range(9)}
    ends = {(r.choice(["hub", "none", *[f"n{i}" for i in range(12)]]), r.choice(["hub", "none", *[f"n{i}" for i in range(12)]])) for _ in range(60)}
    places = lambda x: {c for i, c in at if i == x}
    want = {(s, t): (min(places(s) & places(t) or places(s) or places(t) or {"UNKNOWN"}), bool(places(s) & places(t))) for s, t in ends}
    got = retrieve.grounding(spark.createDataFrame(sorted(ends), "source string, target string"), spark.createDataFrame(sorted(at), "id string, chunk_id string")).collect()
    assert {(x.source, x.target): (x.chunk_id, x.together) for x in got} == want and len(got) == len(want)


def test_nearest_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", 4)
    monkeypatch.setattr(similar, "RUN", 2)
    v = np.random.default_rng(1).normal(size=(50, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    products = v @ v.T
    np.fill_diagonal(products, -np.inf)
    got = similar.nearest(df, df, 3, others_only=True).collect()
    assert {(x.q_id, x.id) for x in got} == {(i, int(j)) for i in range(50) for j in np.argsort(-products[i])[:3]} and len(got) == 150
    assert similar.nearest(df, df, None, 0.5, others_only=True).count() == int((products >= 0.5).sum())


def test_names_stand_for_occurrences(spark):
    n = nodes(spark, SF)
    for f in (resolve.merge_decisions, resolve.split_map, resolve.type_collisions):
        assert sorted(map(str, f(n).collect())) == sorted(map(str, f(resolve.names(n)).collect()))


def test_line_items_meet_parts_once(spark):
    for made, sql in ((adapter.nodes, adapter.NODES), (adapter.edges, adapter.EDGES)):
        once, want = made(spark, SF), adapter.occurrences(spark, SF, sql)
        assert plan(once).count("part.parquet") == 1 and once.dtypes == want.dtypes
        assert once.exceptAll(want).isEmpty() and want.exceptAll(once).isEmpty()


def test_occurrences_are_not_written(spark, monkeypatch):
    written = []
    for module in (resolve, health, health_queries):
        monkeypatch.setattr(module, "stage", lambda df, name: written.append(name) or staging.stage(df, name))
    catalog.QUERIES["resolved_queue"](spark, SF)
    assert "typed" in written and not {"occurrences", "edges"} & {*written}
    catalog.QUERIES["resolved_checks"](spark, SF)
    assert "edges" in written and "occurrences" not in written


def test_typed_edges_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resolve, "MOST", 7)
    r = random.Random(5)
    some = lambda *of: r.choice([None, *of])
    at = [(some("c1", "c2", "c3"), some(1, 2, 3), some("a", "b", "hub"), some("Event", "Work")) for _ in range(60)]
    edges = [(some("c1", "c2", "c4"), some("a", "b", "x"), some("a", "hub"), "T", i) for i in range(80)]
    low = lambda x: (x is not None, x or 0)
    def kind(chunk, id_):
        there = sorted(((low(p), (t is not None, t or ""), t) for c, p, i, t in at if c == chunk and i == id_), key=lambda x: x[:2])
        return there[0][2] if there and chunk is not None and id_ is not None else None
    got = resolve.typed_edges(spark.createDataFrame(at, "chunk_id string, pos long, id string, type string"), spark.createDataFrame(edges, "chunk_id string, source_id string, target_id string, type string, n int"), 60)
    assert "Join" not in plan(got)
    assert sorted(got.collect(), key=lambda x: x.n) == [(*e, kind(e[0], e[1]), kind(e[0], e[2])) for e in edges]


def test_ends_of_edges_are_counted(spark):
    nodes_ = spark.createDataFrame([("a", "Event"), ("b", "Era"), ("b", "Theme"), (None, "Event")], "id string, type string")
    edges_ = spark.createDataFrame([("a", "b"), ("a", "x"), (None, "x"), ("y", "y")], "source string, target string")
    assert health._dangling(nodes_, edges_).first()["n_dangling"] == 5
    assert health._dangling(nodes_, edges_.limit(0)).first()["n_dangling"] == 0


def test_a_task_gives_the_best_of_all_its_vectors(spark, monkeypatch):
    r = np.random.default_rng(4)
    v = np.round(r.normal(size=(90, 5)), 1)
    v[40:60], v[60], v[61] = v[3], v[3] * 1e35, v[5] * 1e-30  # ties, what single precision can't hold
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame([*rows, (90, None), (91, [float("nan")] * 5), (3, (-v[3]).tolist())], "id long, v array<double>").repartition(3)
    given = [*rows, (3, (-v[3]).tolist())]
    score = lambda x, y: reduce(lambda s, ab: s + ab[0] * ab[1], zip(x, y, strict=True), 0.0)
    monkeypatch.setattr(similar, "BLOCK", 4)
    for run in (2, 100):
        monkeypatch.setattr(similar, "RUN", run)
        found = similar.nearest(spark.createDataFrame(rows, "id long, v array<double>"), df, 3, 0.5, others_only=True)
        near = {i: [(score(x, w), j) for j, w in given if j != i and score(x, w) >= 0.5] for i, x in rows}
        want = {(i, j, s) for i, of in near.items() for s, j in sorted(of, key=lambda y: (-y[0], y[1]))[:3]}
        assert {(x.q_id, x.id, x.score) for x in found.collect()} == want
        pairs = {}
        for i, x in given:
            for j, y in given:
                if i < j and score(x, y) >= 0.5:
                    pairs[i, j] = max(score(x, y), pairs.get((i, j), 0.5))
        assert {(x.id_a, x.id_b): x.cosine for x in similar.cosine_pairs(df, None, 0.5).collect()} == pairs
        if run == 100:  # of one task no more than the best leave
            assert similar._found(df, df, 3, 0.5, True, False).count() <= 3 * len(given)


def test_echoes_look_no_further_than_others_took(spark, monkeypatch):
    v = np.random.default_rng(9).normal(size=(40, 3)) + 1.5  # near each other, so that many take the same
    v /= np.linalg.norm(v, axis=1)[:, None]
    events = spark.createDataFrame([(i, x.tolist(), i) for i, x in enumerate(v)], "id long, v array<double>, ord long")
    score = lambda i, j: reduce(lambda s, ab: s + ab[0] * ab[1], zip(v[i], v[j], strict=True), 0.0)
    took = set()
    for i in range(40):
        partners = sorted((-score(i, j), j) for j in range(40) if abs(i - j) >= 3 and score(i, j) >= 0.5 and (j, i) not in took)
        took |= {(i, j) for _, j in partners[:2]}
    read, real = [], cluster.stage
    monkeypatch.setattr(cluster, "stage", lambda df, name: read.append((name, real(df, name))) or read[-1][1])
    for first in (2, 32):
        monkeypatch.setattr(cluster, "FIRST", first)
        got = cluster.echoes(events, 0.5, 3, 2).select("a", "b").collect()
        assert {tuple(x) for x in got} == {(min(p), max(p)) for p in took}
    assert [df.groupBy("event").count().agg({"count": "max"}).first()[0] for name, df in read if name == "echo-first"] == [2, 32]


def test_what_cells_give_is_put_in_order_by_tasks_of_bounded_size(spark, monkeypatch):
    v = np.random.default_rng(6).normal(size=(90, 4))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(2)
    monkeypatch.setattr(similar, "BLOCK", 5)
    monkeypatch.setattr(similar, "RUN", 2)
    monkeypatch.setattr(similar, "ORDERED", 200, raising=False)
    dealt = similar._found(df, df, 3, None, True, False).withColumn("task", F.spark_partition_id())
    assert dealt.count() == 90 * 9 * 3
    assert dealt.groupBy("task").count().agg(F.max("count")).first()[0] <= 5 * 200
    assert dealt.groupBy("q_id").agg(F.count_distinct("task").alias("n")).agg(F.max("n")).first()[0] == 1
    found = {(x.q_id, x.id) for x in similar.nearest(df, df, 3, others_only=True).collect()}
    near = v @ v.T - 1e9 * np.eye(90)
    assert found == {(i, j) for i in range(90) for j in np.argsort(-near[i])[:3].tolist()}


def test_pairs_of_all_vectors_are_judged_once(spark, monkeypatch):
    for name in ("edge_materialise", "unjudged_pairs"):
        calls, judge = [], retrieval_queries._judgments
        with monkeypatch.context() as m:
            m.setattr(retrieval_queries, "_judgments", lambda e, calls=calls, judge=judge: calls.append(1) or judge(e))
            catalog.QUERIES[name](spark, SF)
        assert len(calls) == 1


def test_blocks_are_sent_to_the_grid_by_tasks_of_bounded_size(spark, monkeypatch):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(40)], "id long, v array<double>").repartition(2)
    dealt = lambda: similar._found(df, df, 3, None, True, False)._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")
    monkeypatch.setattr(similar, "BLOCK", 5)
    monkeypatch.setattr(similar, "RUN", 2)
    whole = dealt()
    monkeypatch.setattr(similar, "SENT", 8, raising=False)
    assert dealt() == whole + 2
    found = similar.nearest(df, df, 1, others_only=True).collect()
    assert {(x.q_id, x.id) for x in found} == {(i, 39 if i < 39 else 38) for i in range(1, 40)} | {(0, 1)}  # all are as near to 0
