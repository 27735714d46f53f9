"""Nearest neighbours by a block matrix join: int8 products with error bounds, survivors again in double precision."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

#: Vectors in a block of candidates and in a block of queries, and blocks of candidates that meet one copy of a block of queries.
CANDIDATES, QUERIES, RUN = 2_048, 1_024, 8
#: So many products of two int8 values are whole numbers in float32.
EXACT_DIMS = 1_024

BLOCK = "dim int, rows binary, ids binary, vectors binary, codes binary, bounds binary"

BLOCK_COLUMNS = [c.split()[0] for c in BLOCK.split(", ")]


def usable(vector: Column) -> Column:
    """No null, no empty and no zero vector, no null or non-finite component."""
    return F.coalesce(
        vector.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def _pack(most: int):
    """Packs rows (row, id, vector) into blocks of one dimension each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def block(dim: int) -> pa.RecordBatch:
            rows, ids, vectors = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            vectors = vectors.astype(np.float64)
            small = Quantised.of(vectors)
            parts = {"rows": rows, "ids": ids, "vectors": vectors, "codes": small.codes, "bounds": np.stack([small.scale, small.norm, small.off])}
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32())} | {n: pa.array([x.tobytes()], pa.binary()) for n, x in parts.items()})

        for b in batches:
            dims = pa.compute.list_value_length(b["vector"]).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                own = b.filter(pa.array(dims == dim))
                rows, ids = own["row"].to_numpy(), own["id"].to_numpy()
                vectors = pa.compute.list_flatten(own["vector"]).to_numpy().astype(np.float64).reshape(-1, int(dim))
                for at in range(0, len(ids), most):
                    held.setdefault(int(dim), []).append((rows[at : at + most], ids[at : at + most], vectors[at : at + most]))
                    if sum(len(x[1]) for x in held[int(dim)]) >= most:
                        yield block(int(dim))
        for dim in list(held):
            yield block(dim)

    return run


class Quantised:
    """Rows as int8 values times a scale each, with the norms that bound the error of their products."""

    def __init__(self, codes: np.ndarray, scale: np.ndarray, norm: np.ndarray, off: np.ndarray):
        self.codes, self.scale, self.norm, self.off = codes, scale, norm, off

    @classmethod
    def of(cls, vectors: np.ndarray) -> Quantised:
        scale = np.abs(vectors).max(axis=1) / 127
        scale[scale == 0] = np.finfo(np.float64).tiny  # only of vectors below all normal numbers
        codes = np.clip(np.rint(vectors / scale[:, None]), -127, 127)
        near = codes * scale[:, None]
        return cls(codes.astype(np.int8), scale, np.linalg.norm(near, axis=1), np.linalg.norm(vectors - near, axis=1))

    @classmethod
    def read(cls, dim: int, codes: bytes, bounds: bytes) -> Quantised:
        return cls(np.frombuffer(codes, np.int8).reshape(-1, dim), *np.frombuffer(bounds).reshape(3, -1))

    def products(self, other: Quantised) -> tuple[np.ndarray, np.ndarray]:
        """Approximate inner products, and by how much each may be off."""
        whole = np.zeros((len(self.codes), len(other.codes)))
        for at in range(0, self.codes.shape[1], EXACT_DIMS):
            whole += self.codes[:, at : at + EXACT_DIMS].astype(np.float32) @ other.codes[:, at : at + EXACT_DIMS].astype(np.float32).T
        off = np.outer(self.norm, other.off) + np.outer(self.off, other.norm + other.off)
        return whole * np.outer(self.scale, other.scale), off * (1 + 1e-9) + 1e-12 * np.outer(self.norm + self.off, other.norm + other.off)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b in double precision, summed in the order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def _tiles(k: int):
    """Joined blocks to the k nearest of each query within the run of tiles that its block meets here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heaps, queries, small, own, ids = None, [], None, None, None, None

        def result() -> pa.RecordBatch:
            flat = [(int(own[i]), int(ids[i]), -c, s) for i, h in enumerate(heaps) for s, c in h]
            cols = list(zip(*flat, strict=True)) if flat else [(), (), (), ()]
            return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("query_row", "query_id", "vec_id", "score"), cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)})

        for b in batches:
            for r in range(b.num_rows):
                x = {n: b[n][r].as_py() for n in b.schema.names}
                if (x["q_block"], x["salt"]) != at:
                    if at is not None:
                        yield result()
                    at, queries = (x["q_block"], x["salt"]), np.frombuffer(x["q_vectors"]).reshape(-1, x["dim"])
                    small, own, ids = Quantised.read(x["dim"], x["q_codes"], x["q_bounds"]), np.frombuffer(x["q_rows"], np.int64), np.frombuffer(x["q_ids"], np.int64)
                    heaps = [[] for _ in ids]
                vectors, rows, names = np.frombuffer(x["vectors"]).reshape(-1, x["dim"]), np.frombuffer(x["rows"], np.int64), np.frombuffer(x["ids"], np.int64)
                near, off = small.products(Quantised.read(x["dim"], x["codes"], x["bounds"]))
                self_ = own[:, None] == rows[None, :]
                near[self_] = -np.inf
                least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
                if len(rows) >= k:
                    least = np.maximum(least, np.partition(near - off, len(rows) - k, axis=1)[:, len(rows) - k])
                qi, ci = np.nonzero((near + off >= least[:, None]) & ~self_)
                score = exact(queries[qi], vectors[ci])
                order = np.lexsort((names[ci], -score, qi))
                qi, ci, score = qi[order], ci[order], score[order]
                place = np.arange(len(qi)) - np.searchsorted(qi, qi)
                for i, c, s in zip(qi[place < k].tolist(), names[ci[place < k]].tolist(), score[place < k].tolist(), strict=True):
                    if len(heaps[i]) < k:
                        heapq.heappush(heaps[i], (s, -c))
                    else:
                        heapq.heappushpop(heaps[i], (s, -c))
        if at is not None:
            yield result()

    return run


def search(vectors: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """The k candidates with the largest inner product for each query row; exact.

    Rows are packed into blocks with their int8 codes and error bounds; each block of queries meets all blocks of
    candidates of its dimension, in runs of about RUN blocks. In a tile, products of int8 codes give each inner product
    within a proven error; pairs that can still be among the k best are computed again in double precision and go to
    one heap per query. A last ranking merges the runs' heaps.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Unusable vectors and rows of null
    key take no part; a query's own row is no candidate, other rows of equal id are; with fewer than k candidates all
    come. Vectors of different lengths never meet. An empty table gives an empty result.
    """
    rows = vectors.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query")
    )
    rows = stage(rows, "neighbours-rows")
    candidates = stage(rows.select("row", "id", "vector").mapInArrow(_pack(CANDIDATES), BLOCK).withColumn("block", F.monotonically_increasing_id()), "neighbours-candidates")
    queries = stage(rows.filter("is_query").select("row", "id", "vector").mapInArrow(_pack(QUERIES), BLOCK).withColumn("q_block", F.monotonically_increasing_id()), "neighbours-queries")
    spread = max(1, -(-candidates.count() // RUN))
    named = candidates.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(spread))).drop("block")
    asked = queries.select("dim", "q_block", *[F.col(c).alias(f"q_{c}") for c in ("rows", "ids", "vectors", "codes", "bounds")], F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))).alias("salt"))
    # a block of candidates is shuffled once, to the task of its run, where the join puts it beside every block of queries
    tiles = asked.join(named, ["salt", "dim"])
    found = tiles.select("q_block", "salt", *BLOCK_COLUMNS, *[f"q_{c}" for c in BLOCK_COLUMNS if c != "dim"]).mapInArrow(_tiles(k), "query_row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 20 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
