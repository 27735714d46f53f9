import numpy as np
from loomgraph.llm import neighbours
from pyspark.sql import functions as F


def dot(x, y):
    total = 0.0
    for p, q in zip(x, y, strict=True):
        total += p * q
    return total


def brute(rows, k):
    ok = [(i, v) for i, v in rows if v and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (q, x) in enumerate(ok):
        if q % 3 == 0:
            scored = sorted((-dot(x, y), c) for b, (c, y) in enumerate(ok) if b != a and len(x) == len(y))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATES", 7)
    monkeypatch.setattr(neighbours, "QUERIES", 5)
    monkeypatch.setattr(neighbours, "RUN", 2)
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=6)]) for i in range(60)]
    rows += [(100 + i, [1.0, 0.5, 0.0, 0.0, 0.25, 0.0]) for i in range(40)]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6), (207, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (210, [1.0, 2.0]), (213, [1e-300] * 6), (3, [9.0] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as row", "2 as block", "3 as dim").repartition(3)
    got = neighbours.search(vectors, F.col("vec_id") % 3 == 0, k=5).collect()
    assert sorted(tuple(x) for x in got) == brute(rows, 5)
    assert neighbours.search(vectors.limit(0), F.col("vec_id") % 3 == 0).count() == 0


def test_error_bound_holds():
    r = np.random.default_rng(4)
    a, b = r.normal(size=(50, 1500)) * 10.0 ** r.integers(-3, 3, (50, 1)), r.normal(size=(40, 1500))
    near, off = neighbours.Quantised.of(a).products(neighbours.Quantised.of(b))
    assert (np.abs(near - a @ b.T) <= off).all()
