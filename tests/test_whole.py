"""Whole jobs against brute force."""

from loomgraph.operators import dialogue, graph, metrics, resolve
from loomgraph.plans import catalog
from loomgraph.sources.adapter import edges, nodes
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_near_names_of_any_length_and_aliases(spark):
    rows = [("A", "1", "Al", ["Bob"]), ("A", "2", "Albert", []), ("A", "3", "bob", ["AL"]), ("A", "4", "Cy", ["Zed", "Zed", ""]), ("A", "5", "Zed", None), ("B", "6", "Zed", ["Cy"]), ("A", "7", "C", [])]
    df = spark.createDataFrame(rows, "type string, id string, name string, aliases array<string>")
    got = sorted((r.id_a, r.id_b, r.reason) for r in resolve.near_duplicates(df).collect())
    assert got == [("1", "2", "prefix"), ("1", "3", "alias"), ("5", "4", "alias"), ("7", "4", "prefix")]
    assert len(resolve.near_duplicates(df.drop("aliases")).collect()) == 2


def test_dup_near(spark):
    names = {(r.type, r.id, " ".join(r.name.split()).lower()) for r in nodes(spark, SF).select("type", "id", "name").distinct().collect()}
    ends = {}
    for t, i, n in names:
        ends.setdefault((t, n), []).append(i)
    want = {(i, j) for t, j, n in names for k in range(1, len(n)) for i in ends.get((t, n[:k]), []) if i != j}
    assert {(r.id_a, r.id_b) for r in catalog.QUERIES["dup_near"](spark, SF).select("id_a", "id_b").distinct().collect()} == want


def test_components_of_the_whole_graph(spark):
    n, e = nodes(spark, SF), edges(spark, SF)
    up = {r.id: r.id for r in resolve.resolved_nodes(n).select("id").collect()}

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for r in resolve.resolved_edges(n, e).select("source", "target").collect():
        up[root(r.source)] = root(r.target)
    size = {}
    for x in list(up):
        size[root(x)] = size.get(root(x), 0) + 1
    want = {s: list(size.values()).count(s) for s in size.values()}
    assert {r["size"]: r["n"] for r in catalog.QUERIES["components"](spark, SF).collect()} == want


def test_fallback_and_smoothing(spark):
    """As the reference's loop, over random windows and words."""
    import random

    r = random.Random(5)
    words = [(c, i, i * 0.5, i * 0.5 + 0.4) for c in range(3) for i in range(60)]
    windows = [(c, float(w), w + 2.0, r.choice("ab"), r.choice([0.0, 0.3])) for c in range(3) for w in range(0, 30) if r.random() < 0.6]
    w = spark.createDataFrame(words, "conv int, word_id int, start double, end double")
    v = spark.createDataFrame(windows, "conv int, w_start double, w_end double, label string, margin double")
    got = {(x.conv, x.word_id): x.label for x in dialogue.smoothed(dialogue.relabelled(w, v, 0.1, "?").join(w, ["conv", "word_id"]), 1.0).collect()}
    for c in range(3):
        own = [x for x in words if x[0] == c]
        labels = [next((l for k, a, b, l, m in windows if k == c and m >= 0.1 and a <= (s + e) / 2 < b), "?") for _, _, s, e in own]
        i = 0
        while i < len(labels):
            j = i
            while j < len(labels) and labels[j] == labels[i]:
                j += 1
            if own[j - 1][3] - own[i][2] < 1.0 and i > 0:
                labels[i:j] = [labels[i - 1]] * (j - i)
            i = j
        assert [got[c, x[1]] for x in own] == labels
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert catalog.QUERIES["window_smooth"](spark, SF).filter("label IS NOT NULL").count() == events.count()


def test_person_duplicates_by_whole_names(spark):
    rows = [("Person", f"c{i}", f"Customer#{i:09}") for i in range(8, 13)] + [("Person", "x", "CUSTOMER#000000010"), ("Person", "c8", "Customer#000000008"), ("Work", "y", "Customer#000000009")]
    n = spark.createDataFrame(rows, "type string, id string, name string")
    from loomgraph.functions.text import name_norm

    assert [(r.norm, r.n, r["first"]) for r in metrics.person_duplicates(n, name_norm(F.col("name"))).collect()] == [("customer#000000010", 2, "c10")]
    people = {(r.id, " ".join(r.name.split()).lower()) for r in nodes(spark, SF).filter("type = 'Person'").collect()}
    want = {k for k in {x[1] for x in people} if sum(x[1] == k for x in people) > 1}
    assert {r.norm for r in catalog.QUERIES["person_duplicates"](spark, SF).collect()} == want


def test_gaps_of_all_places(spark):
    at = {}
    for r in nodes(spark, SF).filter("type IN ('Place', 'Theme')").select("id", "type", "chunk_id").distinct().collect():
        at.setdefault((r.type, r.id), []).append(int("".join(c for c in r.chunk_id if c.isdigit())))
    want = {(a, b): min(abs(x - y) for x in at["Theme", a] for y in at["Place", b]) for k, a in at if k == "Theme" and a.startswith("th_") for m, b in at if m == "Place"}
    got = catalog.QUERIES["chunk_gap"](spark, SF).collect()
    assert {(r.a, r.b): r.gap for r in got} == want and len({b for _, b in want}) > 2
