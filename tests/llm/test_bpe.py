import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from loomgraph.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    r = random.Random(5)
    letters = ["a", "B", "é", "漢", "1", "'", "'s", "'re", " ", "  ", "\n", "\t", "!", "...", " ", "🙂", "ß", "\x1c", "\x85", "the", "<|endoftext|>"]
    out = ["", " ", "a" * 700, " " * 300 + "x", "it's we're 'r", "x" + "\n" * 200 + "y"]
    return out + ["".join(r.choice(letters) for _ in range(r.randrange(1, 400))) for _ in range(120)]


def test_pieces_and_merges_as_the_library():
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for t in texts():
        ids = codec.encode(codec.pieces(t))
        assert ids == LIBRARY.encode_ordinary(t), repr(t)
        assert codec.decode(ids) == t.encode()


def test_stitching_equals_one_scan():
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for t in texts():
        for chunk, overlap in ((7, 6), (30, 12), (64, 32)):
            cuts = [(s, x := t[s : s + chunk + overlap], bpe.lengths_of(codec.pieces(x))) for s in range(0, max(1, len(t) - overlap), chunk)]
            assert bpe.stitch(cuts, codec.pieces) == codec.pieces(t), (t, chunk)


def test_operator(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(900, None), (900, None), (None, "null key")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as row", "2 as key", "3 as ids")
    got = bpe.encode(docs.repartition(3), ranks_path=PATH, pattern=public_tokenizers.PATTERN, chunk=50, overlap=16).collect()
    want = sorted((k is None, k or 0, LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for k, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids, bytes(r.decoded)) for r in got) == want
    for r in got:
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()
    assert bpe.encode(docs.limit(0), ranks_path=PATH, pattern=public_tokenizers.PATTERN).count() == 0
