"""Byte-level BPE: overlapping chunks are pre-tokenised, stitched where their boundaries agree, and encoded piece by piece."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import tidy

#: Code points of a chunk without its overlap, and of the overlap with the next chunk.
CHUNK, OVERLAP = 32_768, 1_024
#: A match this close to the end of a chunk could change if more text followed.
MARGIN = 4
#: Pieces whose ids a worker remembers; it forgets all when full. Texts that are worked on at once.
CACHE_PIECES, SLICE = 50_000, 256


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: on each line a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes pieces of text by ranks, and decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        library = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.merge, self.pattern, self.known = library._encode_single_piece, regex.compile(pattern), {}
        self.token = {i: t for t, i in ranks.items()}

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode(self, pieces: list[str]) -> list[int]:
        known, ids = self.known, []
        for p in pieces:
            got = known.get(p)
            if got is None:
                if len(known) >= CACHE_PIECES:
                    known.clear()
                got = known[p] = self.merge(p)
            ids += got
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def lengths_of(pieces: list[str]) -> list[int]:
    return [len(p) for p in pieces]


#: The codec of a worker, which goes on to other tasks.
_codecs: dict[str, Codec] = {}


def codec_of(name: str, shared: Broadcast) -> Codec:
    """The codec from broadcast ranks and pattern, made once in a worker; a function of the module, as it keeps it there."""
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(*shared.value)
    return _codecs[name]


def stitch(chunks: list[tuple[int, str, list[int]]], pieces: Callable[[str], list[str]]) -> list[str]:
    """The pieces of a text from (start, text, lengths of its pieces) of its overlapping chunks, in order.

    A chunk that begins inside a piece may start with wrong pieces, but the pattern looks only forward: from the first
    boundary that it shares with the chunk before, its pieces are right. Where two chunks share none (a piece longer
    than the overlap), the earlier one is continued over the later one's text.
    """
    done: list[str] = []
    start, text, lengths = chunks[0]

    def take(n: int) -> None:
        at = 0
        for length in lengths[:n]:
            done.append(text[at : at + length])
            at += length

    for later_start, later, following in chunks[1:]:
        ends = start + np.cumsum(lengths, dtype=np.int64)
        sure = ends[ends <= start + len(text) - MARGIN]
        begins = later_start + np.cumsum([0, *following], dtype=np.int64)[:-1]
        shared = np.intersect1d(sure, begins)
        if shared.size:
            at = int(shared[0])
            take(int(np.searchsorted(ends, at)) + 1)
            text, lengths, start = later[at - later_start :], following[int(np.searchsorted(begins, at)) :], at
        else:
            at = int(sure[-1]) if sure.size else start
            take(sure.size)
            start, text = at, text[at - start :] + later[start + len(text) - later_start :]
            lengths = lengths_of(pieces(text))
    take(len(lengths))
    return done


def _digests(codec: Codec, pieces: list[str]) -> tuple[bytes, bytes]:
    ids = codec.encode(pieces)
    return np.array(ids, "<u4").tobytes(), codec.decode(ids)


def encode(docs: DataFrame, *, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, keep_ids: bool = True, keep_bytes: bool = True) -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    A text of one chunk is encoded where it is read, and nothing of it is shuffled. A longer text is cut into chunks
    that overlap, one row each: they are pre-tokenised by one task each, and the boundaries of their pieces travel
    with them to the task that stitches and encodes the text. Ids never travel. docs is read once for either kind.

    Returns key, n_tokens, ids_sha256, decoded_sha256, and on request ids (array of int) and decoded (binary). Null
    text counts as empty: no ids. A text may be as long as a row can be. Repeated rows stay separate rows, whatever
    their keys; columns of other names don't matter; an empty table gives an empty result. The rank file is read on
    the driver and travels as a broadcast of fixed size (the vocabulary's).
    """
    if overlap <= MARGIN or chunk < 1:
        raise ValueError("chunks need a positive length and an overlap above the margin")
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    last = F.greatest(F.lit(0), F.ceil((F.length("text") - overlap) / F.lit(chunk)) - 1).cast("int")
    result = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * keep_ids + [("decoded", pa.binary())] * keep_bytes
    types = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids + ", decoded binary" * keep_bytes
    name = f"{ranks_path} {pattern}"

    def codec() -> Codec:
        return codec_of(name, shared)

    def told(keys: pa.Array, found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        columns = {"n_tokens": [len(i) // 4 for i, _ in found], "ids_sha256": [hashlib.sha256(i).hexdigest() for i, _ in found], "decoded_sha256": [hashlib.sha256(d).hexdigest() for _, d in found]}
        if keep_ids:
            columns["ids"] = [np.frombuffer(i, "<u4").astype(np.int32) for i, _ in found]
        if keep_bytes:
            columns["decoded"] = [d for _, d in found]
        return pa.RecordBatch.from_pydict({"key": keys} | {n: pa.array(columns[n], t) for n, t in result})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec()
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                yield told(part["key"], [_digests(c, c.pieces(t)) for t in part["text"].to_pylist()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec()
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                lengths = pa.array([lengths_of(c.pieces(t)) for t in part["piece"].to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lengths], names=[*part.schema.names, "lengths"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec()
        for b in batches:
            for at in range(b.num_rows):
                chunks = b["chunks"][at].as_py()
                pieces = stitch([(x["no"] * chunk, x["piece"], x["lengths"]) for x in chunks], c.pieces)
                yield told(b["key"].slice(at, 1), [_digests(c, pieces)])

    kind = docs.schema[key].dataType.simpleString()
    short = rows.filter(last == 0).mapInArrow(tidy(whole), f"key {kind}, {types}")
    long_ = rows.filter(last > 0).withColumn("row", F.monotonically_increasing_id())
    long_ = long_.select("row", "key", F.explode(F.sequence(F.lit(0), last)).alias("no"), "text").select("row", "key", "no", F.substring("text", F.col("no") * chunk + 1, F.lit(chunk + overlap)).alias("piece"))
    seen = long_.repartition("row", "no").mapInArrow(tidy(cut), f"row bigint, key {kind}, no int, piece string, lengths array<int>")
    packed = seen.groupBy("row").agg(F.first("key").alias("key"), F.array_sort(F.collect_list(F.struct("no", "piece", "lengths"))).alias("chunks"))
    out = short.unionByName(packed.select("key", "chunks").mapInArrow(tidy(joined), f"key {kind}, {types}"))
    return out.select(F.col("key").alias(key), *[n for n, _ in result])


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, ranks_path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN, keep_ids=False, keep_bytes=False)
