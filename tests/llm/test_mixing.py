import hashlib
import math
import random

import pytest
from loomgraph.llm import mixing


def size(text):
    return len([w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w])


def brute(rows, weights=(5, 2, 1), share=1.5, limit=2.0, seed=17):
    """(key, source) -> multiset of (size, copies), and targets by source."""
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    words = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    target, open_, left = {}, list(sources), share * sum(words.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > limit * words[s]]
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            target[s] = limit * words[s]
            left -= target[s]
            open_.remove(s)
    out = []
    for s in sources:
        own = sorted(((size(t), k is None, k or 0) for k, t, x in rows if x == s))
        step = math.floor(target[s] / words[s] * 2**24) if words[s] else 0
        offset = int(hashlib.md5(f"{seed}:{'n' if s is None else 's' + s}".encode()).hexdigest()[:6], 16)
        for i, (n, no_key, k) in enumerate(own):
            out.append((None if no_key else k, s, n, ((i + 1) * step + offset >> 24) - (i * step + offset >> 24)))
    return sorted(out, key=str), target, words


def corpus():
    r = random.Random(6)
    rows = [(i, " ".join("w" * r.randrange(1, 5) for _ in range(r.randrange(0, 60))), r.choice(["a", "b", "b", "b", "c", "Z", "é", None])) for i in range(400)]
    return rows + [(1, None, "a"), (2, "", "a"), (3, " \t\r\n ", None), (None, "no key here", "b"), (7, "same row", "c"), (7, "same row", "c"), (900, "x " * 30_000, "b"), (901, None, "only nulls"), (902, "tie one", "a"), (903, "tie two", "a")]


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,)])
def test_plan_equals_brute_force(spark, weights):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 as size", "2 as target", "3 as `a.b`", "4 as row", "5 as part").repartition(5)
    got = mixing.sampling_plan(docs, weights=weights).collect()
    want, target, words = brute(rows, weights)
    assert sorted(((r.key, r.source, r["size"], r.copies) for r in got), key=str) == want
    for s, t in target.items():
        own = [r for r in got if r.source == s]
        assert all(math.isclose(r.target, t, rel_tol=1e-9) and r.source_size == words[s] and r.taken <= 2 * r["size"] for r in own)
        assert t <= 2 * words[s] and abs(sum(r.taken for r in own) - t) <= 2 * max(r["size"] for r in own)
    assert any(math.isclose(t, 2 * words[s]) for s, t in target.items() if words[s])  # some source stops
    mixed = mixing.mix(docs, weights=weights)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    again = mixing.sampling_plan(docs.repartition(3), weights=weights).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_empty_and_single(spark):
    docs = spark.createDataFrame([(1, "one two", "a")], "doc_id bigint, text string, source string")
    assert mixing.sampling_plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    [r] = mixing.sampling_plan(docs).collect()
    assert r.target == 3.0 and r.copies in (1, 2)
