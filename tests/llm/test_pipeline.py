import random

import pytest

pytest.importorskip("corpus_pipeline")


def test_stages(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(4)
    words = ["thing", "other", "with", "and", "the", "that", "house", "water", "green", "over"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, text(r.randrange(20, 60)), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s0") for i in range(5)] + [(200, "XQ!! ZZ!! QX!! " * 5, "en", "s1"), (201, None, None, None), (202, rows[7][1] + " mail jo.doe@mail.example.com", "en", "s2")]
    docs = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(docs, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    after = {}
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        assert name not in after
        out = function(spark, read, str(tmp_path))
        if i < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{i}.parquet")
        read = spark.read.parquet(f"{tmp_path}/{i}.parquet")
        after[name] = read.collect()
    kept, single, private, mix, ids = after.values()
    assert not {200, 201} & {x.doc_id for x in kept} and len(kept) >= 60
    assert not {100, 101, 102, 103, 104} & {x.doc_id for x in single} and len(single) >= 58
    assert {x.doc_id for x in private} == {x.doc_id for x in single} and not any("jo.doe" in x.text for x in private)
    assert all(x.n_chars == len(x.text) for x in private)
    by = {x.doc_id: x for x in private}
    assert all(x.text == by[x.doc_id].text for x in mix) and len(ids) == len(mix) and all(x.n_tokens == len(x.ids) for x in ids)
    assert sorted((x.doc_id, x.n_tokens) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted((x.doc_id, x.n_tokens) for x in ids)


def test_empty_table_and_odd_columns(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    read = docs.selectExpr("*", "1 as `a.b`", "2 as row", "3 as text_")
    for i, (_, function) in enumerate(corpus_pipeline.STAGES[:4]):
        out = function(spark, read, str(tmp_path))
        assert out.columns == docs.selectExpr("*", "1 as `a.b`", "2 as row", "3 as text_").columns
        out.write.parquet(f"{tmp_path}/{i}.parquet")
        read = spark.read.parquet(f"{tmp_path}/{i}.parquet")
