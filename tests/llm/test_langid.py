import zlib

import numpy as np
from loomgraph.llm import langid
from pyspark.sql import functions as F

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and then the other thing that was there with them",
    "de": "der schnelle braune fuchs springt über den faulen hund und dann die andere sache die dort war mit ihnen",
    "fr": "le rapide renard brun saute par dessus le chien paresseux et puis une autre chose qui était là avec eux",
}


def test_vectors_by_hand():
    space = langid.Space()
    codes, counts = space.ngrams("ab AB")  # " ab ab "
    decoded = {"".join(chr(int(c) >> 21 * i & 0x1FFFFF) for i in (2, 1, 0)): int(n) for c, n in zip(codes, counts, strict=True)}
    assert decoded == {" ab": 2, "ab ": 2, "b a": 1}
    letter = {c: np.random.default_rng([langid.SEED, ord(c)]).integers(0, 2, langid.DIMS, np.int8) * 2 - 1 for c in " ab"}
    want = sum(n * np.roll(letter[g[0]], 2).astype(int) * np.roll(letter[g[1]], 1) * letter[g[2]] for g, n in decoded.items())
    assert (space.bundle(codes, counts) == want).all()
    assert space.ngrams("12 34!")[0].size == 0 and space.ngrams("")[0].size == 0


def test_query(spark, tmp_path):
    rows = [(i, " ".join(np.random.default_rng(i).permutation(SAMPLES[g].split()).tolist()), g, "s") for i, g in enumerate(["en", "de", "fr"] * 20)]
    rows += [(900, None, "en", "s"), (901, "", "de", "s"), (902, "123 ..", "fr", "s"), (903, SAMPLES["en"] * 400, None, "s"), (904, SAMPLES["de"], "de", None), (904, SAMPLES["de"], "de", None), (None, SAMPLES["fr"], "fr", "s")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = langid.op3_language(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, _, g, _ in rows[:60]:
        assert by[i].lang_pred == g and 0 < by[i].score <= 1 and by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902))
    assert by[903].lang_pred == "en" and by[904].lang_pred == "de" and by[None].lang_pred == "fr" and not by[None].held_out


def test_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "text", "x", "y")], "doc_id bigint, text string, _key string, score string")
    assert [tuple(r) for r in langid.predict(docs, {}).collect()] == [(1, "und", 0.0)]
    assert langid.predict(docs.limit(0), {}).count() == 0
    assert langid.learn(docs.withColumn("lang", F.lit("en")).limit(0)) == {}
