import math
import random
from collections import Counter, defaultdict

import numpy as np
from loomgraph.llm import quality as q


def brute(train, text):
    """Interpolated modified Kneser-Ney by dictionaries of symbol tuples."""
    pad = lambda t: [q.START] * (q.ORDER - 1) + q.symbols(t).tolist() + [q.END]
    counts = {q.ORDER: Counter()}
    for t in train:
        s = pad(t)
        counts[q.ORDER].update(tuple(s[i : i + q.ORDER]) for i in range(len(s) - q.ORDER + 1))
    for n in range(q.ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut, total, spare = {}, defaultdict(float), defaultdict(float)
    for n, c in counts.items():
        k = Counter(c.values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0.0
        cut[n] = [min(j, max(0.0, j - (j + 1) * y * k[j + 1] / k[j])) if k[j] else 0.5 for j in (1, 2, 3)]
        for g, v in c.items():
            total[g[:-1]] += v
            spare[g[:-1]] += cut[n][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        low, v = p(g[1:]), counts[len(g)][g]
        if g[:-1] not in total:
            return low
        return ((v - cut[len(g)][min(v, 3) - 1] if v else 0) + spare[g[:-1]] * low) / total[g[:-1]]

    s = pad(text)
    found = [-math.log(p(tuple(s[i : i + q.ORDER]))) for i in range(len(s) - q.ORDER + 1)]
    return math.exp(sum(found) / len(found))


def corpus():
    r = random.Random(1)
    words = ["thing", "other", "with", "and", "the", "über", "漢字", "🙂x"]
    good = [(i, " ".join(r.choice(words) for _ in range(r.randrange(3, 40))), "en" if i % 2 else None) for i in range(60)]
    bad = [(100, "XQZ!! ZZZ!! QQQ!!", "en"), (101, "and and and and and and and and", "en"), (102, "Ω" * 50, "de")]
    return good + bad + [(200, None, "en"), (201, "", "en"), (202, " \n ", "en"), (203, "the thing " * 30_000, "en"), (None, "the other thing", "en"), (5, "the other thing", "en")]


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(q, "BLOCK", 30_000)  # code points: some twenty blocks
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 as block", "2 as gram", "3 as key", "4 as trusted").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(100, 0, 0), (4, 0, 0), (200, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    ids = {i for i in range(0, 60, 2)} - {4} | {200}
    train = [t for k, t, _ in rows if k in ids and t]
    got = q.score(docs, q.trusted(labels), carry=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.trusted == (r.doc_id in ids and bool((r.row.text or "").strip()))
        if not (r.row.text or "").strip():
            assert r.perplexity is None and not r.keep
        elif len(r.row.text) < 1000:
            assert np.isclose(r.perplexity, brute(train, r.row.text), rtol=1e-9)
    assert not any(r.keep for r in got if r.doc_id in (100, 101, 102)) and sum(r.keep for r in got) > 40
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)


def test_shuffled_ids_and_no_trusted(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], "doc_id bigint, quality int, toxic int")
    want = sorted(map(str, q.score(docs, q.trusted(labels)).collect()))
    monkeypatch.setattr(q, "SENT", 3)
    assert sorted(map(str, q.score(docs, q.trusted(labels)).collect())) == want
    none = q.score(docs, q.trusted(labels.limit(0))).collect()
    assert all(r.perplexity is None and r.threshold is None for r in none) and sum(r.keep for r in none) == len(corpus()) - 3
    assert q.score(docs.limit(0), q.trusted(labels)).count() == 0


def test_limits_are_held_out_and_outliers_do_not_move_them(spark):
    """One odd trusted document opens no gate, neither in a language of its own threshold nor as the only one of a rare language."""
    r = random.Random(2)
    words = ["thing", "other", "with", "and", "the", "house", "green", "water"]
    page = lambda: " ".join(r.choice(words) for _ in range(60))
    odd = lambda seed: " ".join(f"q{random.Random(seed + i).randrange(10**6)}z" for i in range(40))
    rows = [(i, page(), "de") for i in range(150)] + [(150, odd(0), "de"), (151, odd(100), "xx"), (152, page(), "xx")]
    rows += [(i, page(), "de" if i % 2 else "xx") for i in range(200, 300)] + [(i, odd(1000 * i), "de" if i % 2 else "xx") for i in range(300, 310)] + [(310, odd(0), "de"), (311, odd(100), "xx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(153)], "doc_id bigint, quality int, toxic int")
    got = q.score(docs, q.trusted(labels)).collect()
    assert not [x.doc_id for x in got if x.keep and (x.doc_id in (150, 151) or x.doc_id >= 300)]
    assert sum(x.keep for x in got if 200 <= x.doc_id < 300) >= 97 and sum(x.keep for x in got if x.doc_id < 150) >= 145
    assert len({x.threshold for x in got}) == 2


def test_shuffles_of_training_are_freed_before_the_corpus_is_scored(spark, monkeypatch):
    """Held-out texts are shuffled to be scored; these shuffles are freed once their scores are staged and nothing else is to be."""
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], "doc_id bigint, quality int, toxic int")
    done, stage, free = [], q.stage, q.free_shuffles
    monkeypatch.setattr(q, "stage", lambda df, name: done.append(name) or stage(df, name))
    monkeypatch.setattr(q, "free_shuffles", lambda s: done.append("freed") or free(s))
    q.score(docs, q.trusted(labels))
    assert done[-1] == "freed" and "quality-held-out" in done
