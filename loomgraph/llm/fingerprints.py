"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import column, drop, stage

#: Two primes below 2**31 and a base for each.
PRIMES, BASES = (2_147_483_647, 2_147_483_629), (911_382_323, 972_663_749)
#: Code points of a span, and spans that a fingerprint keeps.
SPAN, KEPT = 16, 64
#: Code points of a stretch of documents, and stretches at most: beyond 1.6 TB they grow longer, as documents stream through them.
STRETCH, MOST = 8_000_000, 200_000

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _grown(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each prime, the powers of its base and of the base's inverse up to n."""
    if not _powers or len(_powers[0][0]) <= n:
        size, fresh = max(1 << 16, 1 << int(n).bit_length()), []
        for p, base in zip(PRIMES, BASES, strict=True):
            both = []
            for b in (base, pow(base, -1, p)):
                out, have, step = np.ones(size, np.uint64), 1, b
                while have < size:  # the second half is the first times b ** have
                    more = min(have, size - have)
                    out[have : have + more] = out[:more] * np.uint64(step) % np.uint64(p)
                    have, step = have + more, step * step % p
                both.append(out)
            fresh.append(tuple(both))
        _powers[:] = fresh
    return _powers


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """Prefix sums of code point * base ** place, modulo two primes: the hash of any span in constant time."""

    def __init__(self, points: np.ndarray):
        self.n, self.sums = len(points), []
        for p, (up, _) in zip(PRIMES, _grown(self.n + 1), strict=True):
            terms = (points.astype(np.uint64) + np.uint64(1)) * up[: self.n] % np.uint64(p)
            # fewer than 2**32 terms below 2**31 each fit in 64 bits
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % np.uint64(p)]))

    def spans(self, starts: np.ndarray, length: int) -> np.ndarray:
        """The 62-bit hashes of the spans that begin at starts; equal for equal spans wherever they stand."""
        halves = []
        for p, (_, down), sums in zip(PRIMES, _grown(self.n + 1), self.sums, strict=True):
            halves.append((sums[starts + length] + np.uint64(p) - sums[starts]) % np.uint64(p) * down[starts] % np.uint64(p))
        return halves[0] << np.uint64(31) | halves[1]

    def span(self, start: int, length: int) -> int:
        return int(self.spans(np.array([start]), length)[0])


def equal_spans(a: PrefixHashes, i: int, b: PrefixHashes, j: int, length: int) -> bool:
    return i + length <= a.n and j + length <= b.n and a.span(i, length) == b.span(j, length)


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How many code points a from i and b from j have in common, by binary search."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, middle) == b.span(j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def sketch(hashes: PrefixHashes, span: int = SPAN, kept: int = KEPT) -> np.ndarray:
    """The smallest mixed hashes of the distinct spans; a text shorter than a span is one span, an empty one has none."""
    if not hashes.n:
        return np.zeros(0, np.uint64)
    length = min(span, hashes.n)
    found = hashes.spans(np.arange(hashes.n - length + 1), length)
    mixed = (found ^ found >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    most = 4 * kept
    while most < len(mixed):  # repeated spans may crowd out others
        least = np.unique(np.partition(mixed, most)[:most])
        if len(least) >= kept:
            return least[:kept]
        most *= 4
    return np.unique(mixed)[:kept]


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Share of the smallest span hashes of both texts together that both have: an estimate of their spans' Jaccard."""
    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)[:kept]
    return float(np.isin(both, np.intersect1d(a, b)).sum() / len(both))


def _name(a: np.ndarray) -> str:
    return a.astype(">u8").tobytes().hex()


def _edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    third = len(points) // 3
    return np.concatenate([points[: len(points) - third], following[:third]])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each with the one that follows; the last of a stretch is a guest, there only for the one before."""
    before, out = None, []
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "kept_chars")
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, cols, types, strict=True)})

    for b in batches:
        for stretch, key, text, guest in zip(*(b[n].to_pylist() for n in ("stretch", "key", "text", "guest")), strict=True):
            points = code_points(text)
            hashes = PrefixHashes(points)
            own = sketch(hashes)
            if before and before[0] == stretch:
                _, name, old, old_hashes, old_own = before
                edited = _edited(old, points)
                edited_hashes = PrefixHashes(edited)
                other = sketch(edited_hashes)
                sha = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
                out.append((name, len(old), sha, _name(old_own), _name(other), likeness(old_own, other), likeness(old_own, own), common_extension(old_hashes, 0, edited_hashes, 0)))
            before = None if guest else (stretch, key, points, hashes, own)
            if len(out) >= 1_000:
                yield batch()
    if out:
        yield batch()


def _order(key: str = "key") -> list:
    """The order of documents: descending key, null last; equal keys by a hash of their texts, equal texts in any order."""
    return [F.col(key).isNull(), F.col(key).desc_nulls_last(), F.col("h"), F.col("salt")]


def stretches(rows: DataFrame) -> list[tuple]:
    """The first (key, h, salt) of each stretch of about STRETCH code points, in order, from rows (key, h, salt, size).

    Only those four numbers of a document are sorted, by ranges; sizes are summed within the ranges, and the sums of
    the ranges before are added. One row for each stretch comes to the driver.
    """
    written = stage(rows.repartitionByRange(*_order()).sortWithinPartitions(*_order()).withColumn("at", F.monotonically_increasing_id()), "fingerprint-order")
    dealt = written.withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("part").agg(F.sum("size").alias("n")).select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    long = max(STRETCH, -(-total // MOST))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("own", F.sum("size").over(within)).join(F.broadcast(sums), "part").withColumn("stretch", F.floor((F.col("before") + F.col("own") - F.col("size")) / F.lit(long)))
    firsts = placed.groupBy("stretch").agg(F.min_by(F.struct("key", "h", "salt"), "at").alias("x")).orderBy("stretch").collect()
    drop(written)
    return [(r["x"]["key"], r["x"]["h"], r["x"]["salt"]) for r in firsts]


def fingerprint(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints every whole text and an edited text, in which the next document's beginning replaces the last third.

    Next is by descending key; the first follows the last. The order is cut into stretches of about equal length,
    anywhere, so also within the documents of one key and within equal rows; each stretch is one task, through which
    documents stream, and also gets the first document of the next one as a guest, so that no text travels twice but
    those.

    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and kept_chars (how
    many code points text and edited text have in common at the start). A null text is empty; an empty text has an
    empty fingerprint; null keys come last; equal keys stand in the order of the xxHash64 values of their texts; an only
    document follows itself; other columns don't matter; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(column(key).cast("long").alias("key"), F.coalesce(column(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)))
    firsts = stretches(rows.select("key", "h", "salt", (F.length("text") + 64).cast("long").alias("size")))
    if not firsts:
        return spark.createDataFrame([], f"`{key}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_chars long")
    cuts = spark.sparkContext.broadcast([_rank(*f) for f in firsts[1:]])  # at most MOST

    def place(keys: pd.Series, known: pd.Series, hashes: pd.Series, salts: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(cuts.value, _rank(k if there else None, h, s)) for k, there, h, s in zip(keys.tolist(), known.tolist(), hashes.tolist(), salts.tolist(), strict=True)], dtype="int32")

    placed = rows.withColumn("stretch", F.pandas_udf(place, "int")(F.coalesce("key", F.lit(0)), F.col("key").isNotNull(), "h", "salt"))
    heads = spark.createDataFrame([(k, h, s, (i - 1) % len(firsts)) for i, (k, h, s) in enumerate(firsts)], "h_key long, h_h long, h_salt long, host int")
    here = F.col("key").eqNullSafe(F.col("h_key")) & (F.col("h") == F.col("h_h")) & (F.col("salt") == F.col("h_salt"))
    guests = rows.join(F.broadcast(heads), here).groupBy("host").agg(F.min(F.struct("key", "h", "text")).alias("x")).select(F.col("host").alias("stretch"), "x.key", "x.text", "x.h", F.lit(True).alias("guest"))
    everything = placed.select("stretch", "key", "text", "h", F.lit(False).alias("guest")).unionByName(stage(guests, "fingerprint-guests"))
    ordered = everything.repartitionById(len(firsts), F.col("stretch")).sortWithinPartitions("stretch", "guest", F.col("key").desc_nulls_last(), "h", "text")
    out = ordered.select("stretch", "key", "text", "guest").mapInArrow(_walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_chars long")
    return out.withColumnRenamed("doc_id", key)


def _rank(key: int | None, h: int, salt: int) -> tuple[bool, int, int, int]:
    """The place of a document in the order, for comparison."""
    return (key is None, 0 if key is None else -key, h, salt)


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
