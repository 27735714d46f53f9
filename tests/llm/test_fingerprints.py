import hashlib
import random

import xxhash
from loomgraph.llm import fingerprints as fp


def hashes(t):
    return fp.PrefixHashes(fp.code_points(t))


def test_spans_and_extensions():
    r = random.Random(1)
    for _ in range(60):
        a = "".join(r.choice("ab🙂") for _ in range(r.randrange(0, 80)))
        b = a[: r.randrange(0, len(a) + 1)] + "".join(r.choice("abc") for _ in range(20))
        x, y = hashes(a), hashes(b)
        want = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))  # noqa: B905
        assert fp.common_extension(x, 0, y, 0) == want
        i, j, n = r.randrange(len(a) + 1), r.randrange(len(b) + 1), r.randrange(6)
        assert fp.equal_spans(x, i, y, j, n) == (i + n <= len(a) and j + n <= len(b) and a[i : i + n] == b[j : j + n])


def brute_sketch(t):
    h = hashes(t)
    n = min(fp.SPAN, len(t))
    found = {}
    for i in range(len(t) - n + 1) if t else []:
        v = h.span(i, n)
        m = (v ^ v >> 31) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
        found[m ^ m >> 29] = t[i : i + n]
    assert len(set(found.values())) == len(found)
    return sorted(found)[: fp.KEPT]


def signed(t):
    v = xxhash.xxh64_intdigest(t.encode(), 42)
    return v - (1 << 64) if v >> 63 else v


def test_query_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fp, "STRETCH", 500)
    r = random.Random(2)
    rows = [(i * 7 % 101, "".join(r.choice("abcdé🙂 ") for _ in range(r.choice([0, 1, 2, 3, 10, 50, 300])))) for i in range(40)]
    rows += [(500, None), (501, ""), (502, "ab" * 2000), (503, "ab" * 2000), (None, "null key"), (503, "zz tie")] + [(600, "one key and text")] * 12 + [(601, f"one key {i}") for i in range(9)] + [(None, "null key")] * 10
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as stretch", "2 as key", "3 as guest").repartition(3)
    got = fp.fingerprint(docs).collect()
    hashed = docs.selectExpr("doc_id AS key", "xxhash64(coalesce(text, '')) AS h", "monotonically_increasing_id() AS salt", "CAST(length(coalesce(text, '')) + 64 AS BIGINT) AS size")
    cuts = fp.stretches(hashed)
    assert len(cuts) > 12 and sum(k == 600 for k, _, _ in cuts) > 1  # also within equal rows
    order = sorted(((k, t or "") for k, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0), signed(x[1])))
    want = []
    for i, (k, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        e = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        want.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(f"{v:016x}" for v in brute_sketch(t)), "".join(f"{v:016x}" for v in brute_sketch(e))))
    assert sorted((tuple(x)[:5] for x in got), key=str) == sorted(want, key=str)
    by = {x.doc_id: x for x in got}
    assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in got)
    long = [x for x in got if x.n_chars == 300]
    assert long and all(x.near_edited > 0.3 > x.near_next for x in long)
    assert by[502].fingerprint == next(x for x in got if x.doc_id == 503 and x.n_chars == 4000).fingerprint
    assert fp.fingerprint(docs.limit(0)).count() == 0
