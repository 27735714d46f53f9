import random

import numpy as np
import pytest
from loomgraph.llm import near
from loomgraph.operators.graph import components


def brute(rows):
    sets = [frozenset(near.shingles(t or "").tolist()) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(keys, default=None), len(linked[i]), len(seen)))
    return sorted(out, key=str)


def corpus(seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    fresh = lambda k: [r.choice(vocabulary) for _ in range(k)]
    passage, texts = fresh(60), []
    for _ in range(60):
        texts.append(fresh(r.randrange(20, 200)) + passage * r.randrange(2))
    for base in (fresh(150), fresh(40), fresh(400)):
        for _ in range(25):
            t = list(base)
            for _ in range(r.randrange(0, max(2, len(t) // 40))):
                t[r.randrange(len(t))] = "new" + str(r.randrange(10**9))
            texts.append(t)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, rows[i * 7][1]) for i in range(10)] + [(1100, rows[3][1].upper().replace(" ", ", ")), (1101, None), (1102, ""), (1103, "!!"), (1104, "two words"), (1105, "Two... words"), (1106, "two word"), (1107, " ".join(fresh(30_000)))]
    return rows + [(0, rows[0][1]), (None, rows[0][1]), (None, None)]


@pytest.mark.parametrize("small", [False, True])
def test_join_equals_brute_force(spark, monkeypatch, small):
    if small:  # large buckets and groups of many blocks; the workers see this through the pickled functions only
        monkeypatch.setattr(near, "GROUP", 7)
        monkeypatch.setattr(near, "BUCKET", 12)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as rep", "2 as root", "3 as sign", "'x' as row").repartition(3)
    got = near.join(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in got), key=str) == brute(rows)
    # a class has one first; documents without words are each their own
    firsts = sum(r.first for r in got)
    kept = near.keep_firsts(docs)
    assert kept.columns == docs.columns and kept.count() == firsts
    assert firsts == len({r.class_id for r in got if r.class_size > 1}) + sum(r.class_size == 1 for r in got)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    assert near.join(docs.limit(0)).count() == 0
    assert [tuple(r) for r in near.join(docs).collect()] == [(1, 1, 0, 1, True)]


def test_paths_meet():
    """Of pairs at the least similarity, nearly all share a path in some run, and unlike ones hardly any."""
    r = np.random.default_rng(5)
    met = unlike = 0
    for _ in range(200):
        s = near.mix(r.integers(0, 2**63, 220).astype(np.uint64))
        x, y, z = np.sort(s[:200]), np.sort(np.concatenate([s[:178], s[200:]])), np.sort(np.concatenate([s[:20], near.mix(r.integers(0, 2**63, 180).astype(np.uint64))]))
        p, q, u = (near.extend(near.SEEDS, t, near.DEPTH) for t in (x, y, z))
        met += len(np.intersect1d(p, q)) > 0
        unlike += len(np.intersect1d(p, u)) > 0
    assert met >= 199 and unlike < 20


def test_split_buckets_keep_pairs():
    """Pairs at the least similarity whose common buckets are all split, twice: nearly all still share a small bucket."""
    r = np.random.default_rng(9)
    places = np.arange(near.SKETCH, dtype=np.uint64) << np.uint64(32)
    seeds = lambda bucket: near.mix(np.uint64(bucket) + np.arange(1, near.BOOST + 1, dtype=np.uint64))
    kept = 0
    for _ in range(150):
        n = int(r.integers(45, 400))
        s = near.mix(r.integers(0, 2**63, n + round(n / 9)).astype(np.uint64))
        x, y = np.sort(s[:n]), np.sort(s[round(n / 9) :])
        p, q = (near.extend(near.SEEDS, t, near.DEPTH) for t in (x, y))
        tx, ty = (near.mix(near.sketch(t).astype(np.uint64) | places) for t in (x, y))
        split = lambda bucket: np.intersect1d(near.extend(seeds(bucket), tx, near.DEEPER), near.extend(seeds(bucket), ty, near.DEEPER))  # noqa: B023, E731
        kept += any(len(split(c)) for b in np.intersect1d(p, q) for c in split(b))
    assert kept >= 149 and near.lost_when_split() < 2e-4


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200), (300, 301), (301, 302), (302, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == dict.fromkeys(range(41), 0) | {100: 100, 101: 100, 300: 300, 301: 300, 302: 300}
