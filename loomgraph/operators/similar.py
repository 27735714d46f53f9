"""Similarity candidates, bands, clusters and retrieval over vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage
from .order import numbered

#: Vectors of a block, and blocks of either side that meet in one task.
BLOCK, RUN = 2_048, 16

#: Copies of blocks that one task sends to cells of the grid.
SENT = 128

#: Rows found by the cells of the grid that one task puts in order.
ORDERED = 1 << 19


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, in the order of the components."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """Blocks (block, dim, ids, vectors) of rows (id, v), of one number of components each; rows without an id, a vector
    or a component take no part."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}

        def block(dim: int) -> pa.RecordBatch:
            whole = pa.Table.from_batches(held.pop(dim))
            vectors = pc.list_flatten(whole["v"].combine_chunks()).to_numpy(zero_copy_only=False).astype(np.float64)
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": pa.array([whole["id"].to_pylist()], pa.list_(whole.schema.field("id").type)), "vectors": pa.array([vectors.tobytes()], pa.binary())})

        for b in batches:
            dims = pc.list_value_length(b["v"]).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                own = b.filter(pa.array(dims == dim))
                for at in range(0, own.num_rows, most):
                    held.setdefault(dim, []).append(own.slice(at, most))
                    if sum(x.num_rows for x in held[dim]) >= most:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    whole = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull())).select("id", F.col("v").cast("array<double>").alias("v"))
    return whole.mapInArrow(run, f"dim int, ids array<{kind}>, vectors binary").withColumn("block", F.monotonically_increasing_id())


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b in double precision, summed in the order of the components, as dot() does."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def nearest(questions: DataFrame, vectors: DataFrame, k: int | None, gate: float | None = None, others_only: bool = False, once: bool = False) -> DataFrame:
    """(q_id, id, score): for each question (id, v) the k vectors (id, v) with the largest inner product, all for no k, of
    at least the gate; ties go to the smaller id. Vectors of other lengths never meet; with others_only no equal ids. With `once`, for all of one table among themselves, pairs
    of different ids come one way round only.

    Both sides are packed into blocks, and dealt to a grid of tasks: RUN blocks of questions meet RUN blocks of vectors,
    one cell of the grid a task, so that no task holds or sorts more, however many there are. A task gives the k best of
    each of its questions among all its vectors; what no longer can be among them is left out block by block. Products
    are of single precision, within a bound of their error; what passes is computed again component by component, so
    that scores are those of dot().

    Each cell of a question's row gives its k best, so these grow with the square of the vectors; they are dealt by
    question to so many tasks that each puts about ORDERED rows in order, however many there are.
    """
    found = _found(questions, vectors, k, gate, others_only, once)
    if k is None:
        return found
    best = Window.partitionBy("q_id").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


def _found(questions: DataFrame, vectors: DataFrame, k: int | None, gate: float | None, others_only: bool, once: bool) -> DataFrame:
    """nearest() of each cell of the grid; for a k dealt by question."""
    kinds = questions.schema["id"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString()
    asked = stage(_packed(questions, BLOCK), "similar-questions")
    told = asked if questions is vectors else stage(_packed(vectors, BLOCK), "similar-vectors")
    (n_asked, n_questions), (n_told, _) = (x.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first() for x in (asked, told))
    across, down = (max(1, -(-n // RUN)) for n in (n_asked, n_told))
    upto = lambda low, high: F.explode(F.sequence(low, high))

    def placed(blocks: DataFrame, n: int, at: str, copies: int) -> DataFrame:
        places = numbered(blocks.select("block"), "block")  # a number for each block
        out, tasks = blocks.join(F.broadcast(places), "block").withColumn(at, (F.col("place") % n).cast("int")), -(-copies // SENT)
        return out.repartitionById(tasks, (F.col("place") % tasks).cast("int")) if tasks > 1 else out

    left = placed(asked, across, "i", n_asked * down).select("i", upto(F.col("i") if once else F.lit(0), F.lit(down - 1)).alias("j"), "dim", F.lit(0).alias("side"), F.col("ids").alias("q_ids"), F.lit(None).cast(f"array<{kinds[1]}>").alias("ids"), "vectors")
    right = placed(told, down, "j", n_told * across).select(upto(F.lit(0), F.col("j") if once else F.lit(across - 1)).alias("i"), "j", "dim", F.lit(1).alias("side"), F.lit(None).cast(f"array<{kinds[0]}>").alias("q_ids"), "ids", "vectors")
    tiles = left.unionByName(right).repartitionById(across * down, F.col("i") * down + F.col("j")).sortWithinPartitions("i", "j", "dim", "side")

    def bounded(q: np.ndarray, v: np.ndarray, q_norms: np.ndarray, v_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Products of all rows and a bound of their error."""
        most = q_norms.max() * v_norms.max()
        if np.isfinite(most) and max(q_norms.max(), v_norms.max(), most) < 1e30:
            return q.astype(np.float32) @ v.astype(np.float32).T, np.float32((q.shape[1] + 8) * 2.0**-22 * most + 1e-36)
        return q @ v.T, 1e-9 * (1 + most) if np.isfinite(most) else 1e-9 * (1 + q_norms[:, None] * v_norms[None, :])

    def product(q_ids: np.ndarray, q: np.ndarray, q_norms: np.ndarray, ids: np.ndarray, v: np.ndarray, v_norms: np.ndarray, least: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the question, id, score) of what has a score of at least the gate, and of the question's least."""
        near, off = bounded(q, v, q_norms, v_norms)
        if others_only:
            near[q_ids[:, None] == ids[None, :]] = -np.inf
        passes = np.isfinite(near) if gate is None else near >= np.asarray(gate - off, near.dtype)
        if least is not None:
            passes &= near >= np.nextafter((least - np.max(off)).astype(near.dtype), near.dtype.type(-np.inf))[:, None] if np.ndim(off) == 0 else near >= least[:, None] - off
        if k is not None and k < len(ids) and np.count_nonzero(passes) > 4 * k * len(q_ids):
            passes &= near + 2 * off >= np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k][:, None]
        qi, vi = np.nonzero(passes)
        score = exact_products(q[qi], v[vi])
        keep = np.ones(len(score), bool) if gate is None else score >= gate
        return qi[keep], ids[vi][keep], score[keep]

    def best_of(qi: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((ids, -score, qi))
        qi, ids, score = qi[order], ids[order], score[order]
        first = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
        return qi[first], ids[first], score[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = [pa.schema([])]

        def told_of(q_ids: np.ndarray, qi: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
            plain = lambda x: x if x.dtype.kind in "iuf" else x.tolist()
            return pa.RecordBatch.from_pydict({"q_id": pa.array(plain(q_ids[qi]), kind[0].field("q_ids").type.value_type), "id": pa.array(plain(ids), kind[0].field("ids").type.value_type), "score": score})

        def done(held: list[list]) -> Iterator[pa.RecordBatch]:
            for q_ids, _, _, best in held:
                if best is not None:
                    yield told_of(q_ids, *best)

        key, held = None, []
        for b in batches:
            kind[0] = b.schema
            for n in range(b.num_rows):
                at = tuple(b[c][n].as_py() for c in ("i", "j", "dim"))
                if at != key:
                    yield from done(held)
                    key, held = at, []
                block = np.frombuffer(b["vectors"][n].as_py()).reshape(-1, at[2])
                norms = np.linalg.norm(block, axis=1)
                if b["side"][n].as_py() == 0:
                    held.append([np.array(b["q_ids"][n].as_py()), block, norms, None])
                    continue
                ids = np.array(b["ids"][n].as_py())
                for own in held:
                    q_ids, q, q_norms, best = own
                    if k is None:
                        found = product(q_ids, q, q_norms, ids, block, norms, None)
                        if once and at[0] == at[1]:  # both ways round in this cell
                            found = tuple(x[q_ids[found[0]] < found[1]] for x in found)
                        yield told_of(q_ids, *found)
                        continue
                    least = np.full(len(q_ids), -np.inf)
                    if best is not None:  # the last of k is the least that still counts
                        full = np.flatnonzero(np.bincount(best[0], minlength=len(q_ids)) == k)
                        least[full] = best[2][np.searchsorted(best[0], full, "right") - 1]
                    found = product(q_ids, q, q_norms, ids, block, norms, least)
                    own[3] = best_of(*(found if best is None else [np.concatenate(x) for x in zip(best, found, strict=True)]))
        yield from done(held)

    found = tiles.mapInArrow(run, f"q_id {kinds[0]}, id {kinds[1]}, score double")
    if k is None:
        return found
    most = n_questions * down * min(k, RUN * BLOCK)  # rows of all cells
    return found.repartition(max(1, -(-most // ORDERED)), "q_id")


def top_k(questions: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The k vectors (id, v) with the largest inner product for each question (q_id, q), with their place from 1."""
    return nearest(questions.select(F.col("q_id").alias("id"), F.col("q").alias("v")), vectors.select("id", "v"), k).select("q_id", "id", "score", "place")


def cosine_pairs(vectors: DataFrame, k: int | None, gate: float) -> DataFrame:
    """Unordered pairs of unit vectors (id, v) in the top k of either side, with a cosine of at least the gate; all such pairs for no k."""
    own = vectors.select("id", "v")
    top = nearest(own, own, k, gate, others_only=True, once=k is None)
    return top.groupBy(F.least("q_id", "id").alias("id_a"), F.greatest("q_id", "id").alias("id_b")).agg(F.max("score").alias("cosine"))


def jaccard_pairs(sets: DataFrame, gate: float) -> DataFrame:
    """Pairs of sets (id, tokens), ids being distinct, with a Jaccard similarity (to six places) of at least the gate.

    Two such sets share one of their rarest tokens: of n tokens the first n - ceil(gate * n) + 1 in order of frequency.
    Only those are joined, so a token that most sets have joins nothing but sets of such tokens alone.
    """
    tokens = sets.select("id", F.size(F.array_distinct("tokens")).alias("n"), F.explode(F.array_distinct("tokens")).alias("t"))
    often = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("id").orderBy("often", "t")
    rare = tokens.join(often, "t").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= F.col("n") - F.ceil(F.lit(gate - 1e-6) * F.col("n")) + 1)
    left, right = rare.select(F.col("id").alias("id_a"), F.col("n").alias("na"), "t"), rare.select(F.col("id").alias("id_b"), F.col("n").alias("nb"), "t")
    # a set can only be like one whose size is within the gate
    near = (F.col("id_a") < F.col("id_b")) & (F.col("na") >= F.col("nb") * (gate - 1e-6)) & (F.col("nb") >= F.col("na") * (gate - 1e-6))
    pairs = left.join(right, "t").filter(near).select("id_a", "id_b").distinct()
    side = lambda c: sets.select(F.col("id").alias(f"id_{c}"), F.array_distinct("tokens").alias(f"t{c}"))
    both = pairs.join(side("a"), "id_a").join(side("b"), "id_b").withColumn("c", F.size(F.array_intersect("ta", "tb")))
    return both.select("id_a", "id_b", F.round(F.col("c") / (F.size("ta") + F.size("tb") - F.col("c")), 6).alias("jaccard")).filter(F.col("jaccard") >= gate)


def channels(dense: DataFrame, lexical: DataFrame) -> DataFrame:
    """Both kinds of candidates, with the channels that found each pair."""
    return dense.join(lexical, ["id_a", "id_b"], "full").withColumn("channels", F.concat_ws("+", F.when(F.col("cosine").isNotNull(), "dense"), F.when(F.col("jaccard").isNotNull(), "lexical")))


def band(cosine: Column, jaccard: Column, auto: float = 0.92, judge: float = 0.80, strong: float = 0.60) -> Column:
    return F.when(cosine >= auto, "auto").when((cosine >= judge) | (jaccard >= strong), "judge").otherwise("drop")


def band_report(pairs: DataFrame, touches_hub: Column) -> DataFrame:
    """Pairs by band: how many, in percent of all, and how many touch a hub."""
    counts = pairs.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count_if(touches_hub).alias("n_hub"))
    whole = counts.agg(F.sum("n").alias("whole"))
    return counts.crossJoin(F.broadcast(whole)).select("band", "n", F.round(100 * F.col("n") / F.col("whole"), 2).alias("pct"), "n_hub")  # one row


def histogram(values: DataFrame, column: str, start: float, width: float, bins: int) -> DataFrame:
    """Counts per bin; the last bin takes what is above."""
    at = F.least(F.floor((F.col(column) - start) / width).cast("int"), F.lit(bins - 1))
    return values.filter(F.col(column) >= start).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def cohesion(members: DataFrame) -> DataFrame:
    """Mean cosine of different members (cluster, id, v) of each cluster, 1 for a single one.

    From the sum of a cluster's unit vectors: its squared length is the sum of all cosines, so no pairs are made.
    """
    parts = members.select("cluster", F.posexplode("v").alias("d", "x")).groupBy("cluster", "d").agg(F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") * F.col("x").cast("double")).alias("q"), F.count(F.lit(1)).alias("n"))
    sums = parts.groupBy("cluster").agg(F.sum(F.col("s") * F.col("s")).alias("whole"), F.sum("q").alias("own"), F.max("n").alias("n"))
    return sums.select("cluster", "n", F.when(F.col("n") == 1, 1.0).otherwise(F.round((F.col("whole") - F.col("own")) / (F.col("n") * (F.col("n") - 1)), 6)).alias("cohesion"))


def centroids(members: DataFrame) -> DataFrame:
    """(cluster, d, x): the mean of each cluster's vectors, of length 1."""
    mean = members.select("cluster", F.posexplode("v").alias("d", "x")).groupBy("cluster", "d").agg(F.avg(F.col("x").cast("double")).alias("x"))
    norms = mean.groupBy("cluster").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return mean.join(norms, "cluster").select("cluster", "d", F.round(F.col("x") / F.col("norm"), 6).alias("x"))


def renumbered(members: DataFrame) -> DataFrame:
    """Clusters numbered from 1 by size, largest first, then by label."""
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return numbered(sizes.withColumn("_less", -F.col("n")), "_less", "cluster").withColumn("number", F.col("place").cast("int")).drop("_less", "place")


def ranked_nodes(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes of the chunks found (q_id, chunk_id, score): their best score and through how many chunks, best first."""
    return found.join(nodes.select("chunk_id", F.col("id").alias("node")).distinct(), "chunk_id").groupBy("q_id", "node").agg(F.max("score").alias("score"), F.count_distinct("chunk_id").alias("n_chunks"))
