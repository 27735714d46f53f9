"""N-gram Jaccard join by chosen paths."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from ..operators.graph import components
from .shared import column, drop, stage, tidy, unpacked, whole_row

#: Words of a shingle, and the similarity from which two documents are linked, as a fraction.
WORDS, SIMILAR = 5, (4, 5)
#: Shared tokens on a path, and the share of pairs at exactly the least similarity that the runs must find.
DEPTH, RECALL = 3, 0.9999
#: Values of a sketch, and the share that must agree for two documents to be compared exactly: four standard deviations below the similarity.
SKETCH, ALIKE = 64, 0.6
#: A bucket above this many sets is split further, by DEEPER more shared tokens and in BOOST samples, for ROUNDS rounds at most.
BUCKET, DEEPER, BOOST, ROUNDS = 4_096, 2, 4, 6
#: Members of a group that one task compares with as many others.
GROUP = 512

C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
TOKEN = re.compile(r"\w+")


def runs(recall: float = RECALL, depth: int = DEPTH) -> int:
    """How many runs reach the recall: a pair at the least similarity shares one chosen token a level in the mean, and
    is lost in a run if its branching dies out before the last level."""
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(lost - 1)
    return math.ceil(math.log(1 - recall) / math.log(lost))


def lost_when_split(of_round: float = 0.0) -> float:
    """The chance that a pair at the least similarity meets in no small bucket if all its common buckets are large.

    A pair is lost in a bucket if each of BOOST samples loses it, at once or in the rounds to come; the chance grows
    to a fixed point. Its common buckets number one a run in the mean and are lost one by one.
    """
    for _ in range(ROUNDS):
        one = of_round
        for _ in range(DEEPER):
            one = math.exp(one - 1)
        of_round = one**BOOST
    for _ in range(DEPTH):
        of_round = math.exp(of_round - 1)
    return of_round**RUNS


RUNS = runs()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * C2
    return x ^ x >> np.uint64(29)


def shingles(text: str) -> np.ndarray:
    """The sorted distinct hashes of all runs of WORDS words, in lower case without punctuation.

    A text of fewer words has one shingle, all of them; a text without words has none.
    """
    words = TOKEN.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < WORDS:
        hashes = np.concatenate([hashes, np.full(WORDS - len(words), len(words), np.uint64)])
    out = hashes[: len(hashes) - WORDS + 1].copy()
    for i in range(1, WORDS):
        out = out * C1 + hashes[i : len(hashes) - WORDS + 1 + i]
    return np.unique(mix(out))


def extend(paths: np.ndarray, tokens: np.ndarray, levels: int) -> np.ndarray:
    """Each path is followed by every token whose hash with it is small: one in four fifths of the set, in the mean.

    Which tokens a path takes doesn't depend on the set, so that sets with common tokens stay together.
    """
    chance = SIMILAR[1] / SIMILAR[0] / max(1, len(tokens))
    bound = np.uint64(min(2**64 - 1, int(chance * 2**64)))
    for _ in range(levels):
        grown = []
        for at in range(0, len(tokens), 1 << 13):
            part = tokens[at : at + (1 << 13)]
            for p in range(0, len(paths), 64):
                own = paths[p : p + 64]
                i, j = np.nonzero((part[None, :] ^ own[:, None]) * C1 <= bound)
                grown.append(mix(own[i] * C2 + part[j]))
        paths = np.unique(np.concatenate(grown)) if grown else paths[:0]
    return paths


SEEDS = mix(np.arange(1, RUNS + 1, dtype=np.uint64) * C1)
SALTS = mix(np.arange(1_001, 1_001 + SKETCH, dtype=np.uint64) * C1)


def sketch(s: np.ndarray) -> np.ndarray:
    """MinHash values: two sets agree on each with a chance of their similarity."""
    least = np.full(SKETCH, 2**64 - 1, np.uint64)
    for at in range(0, len(s), 1 << 13):
        least = np.minimum(least, ((s[None, at : at + (1 << 13)] ^ SALTS[:, None]) * C1).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def _read(batches: Iterator[pa.RecordBatch], text: str | None) -> Iterator[pa.RecordBatch]:
    """What the join needs of each document; its text is the column `text`, or the field of that name in `row`."""
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            signs, sizes, paths, sketches = [], [], [], []
            texts = part["text"] if text is None else part["row"].field(text)
            for t in texts.to_pylist():
                s = shingles(t or "")
                sizes.append(len(s))
                signs.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                paths.append(extend(SEEDS, s, DEPTH).view(np.int64) if len(s) else None)
                sketches.append(sketch(s).tobytes() if len(s) else None)
            new = [pa.array(signs, pa.string()), pa.array(sizes, pa.int32()), pa.array(paths, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "sign", "size", "paths", "sketch"])


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of large buckets in smaller ones, by tokens of their sketches."""
    places = np.arange(SKETCH, dtype=np.uint64) << np.uint64(32)
    for b in batches:
        buckets, ids, sketches = [], [], []
        for bucket, rep, sk in zip(b["bucket"].to_numpy().view(np.uint64), b["rep"].to_pylist(), b["sketch"].to_pylist(), strict=True):
            tokens = mix(np.frombuffer(sk, np.uint32).astype(np.uint64) | places)
            found = extend(mix(bucket + np.arange(1, BOOST + 1, dtype=np.uint64)), tokens, DEEPER).view(np.int64)
            buckets.append(found)
            ids += [rep] * len(found)
            sketches += [sk] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(buckets) if buckets else [], pa.int64()), pa.array(ids, pa.int64()), pa.array(sketches, pa.binary())], names=["bucket", "rep", "sketch"])


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by keys; the last group of a batch waits for the next one."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = [b[k][b.num_rows - 1].as_py() for k in keys]
        starts = np.ones(b.num_rows, bool)
        for k in keys:
            starts &= b[k].to_numpy() == b[k][b.num_rows - 1].as_py()
        cut = int(np.argmax(starts)) if starts.any() else b.num_rows
        if held and [held[0][k][0].as_py() for k in keys] != last:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        elif not held and cut:
            yield pa.Table.from_batches([b.slice(0, cut)])
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def _spans(table: pa.Table, keys: Sequence[str]) -> list[tuple[int, int]]:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in keys:
        v = table[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    at = np.flatnonzero(change)
    return list(zip(at.tolist(), [*at[1:].tolist(), table.num_rows], strict=True))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force in each bucket: a spanning forest of the sets whose sketches agree on ALIKE of their values.

    A search from one set compares it with all that are left, so a bucket of near copies takes about one comparison a set.
    """
    need = int(ALIKE * SKETCH)
    for table in _groups(batches, ["bucket"]):
        reps = table["rep"].to_numpy()
        values = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint32).reshape(-1, SKETCH)
        a, b = [], []
        for start, stop in _spans(table, ["bucket"]):
            left = np.arange(start, stop)
            while len(left) > 1:
                front, left = left[:1], left[1:]
                while len(front) and len(left):
                    one, front = front[0], front[1:]
                    near = (values[left] == values[one]).sum(axis=1) >= need
                    if near.any():
                        a += [int(reps[one])] * int(near.sum())
                        b += reps[left[near]].tolist()
                        front, left = np.concatenate([front, left[near]]), left[~near]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left has in common with each on the right."""
    out = np.zeros((len(left), len(right)), np.int64)
    if len(left) * len(right) <= 16:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                out[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        return out
    x, y = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(x, y)
    for at in range(0, len(common), 4_096):
        part = common[at : at + 4_096]
        sides = []
        for sets in (left, right):
            m = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                place = np.searchsorted(part, s).clip(max=len(part) - 1)
                m[i, place[part[place] == s]] = 1
            sides.append(m)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact similarities in each pair of blocks of a group: links of each set, and a spanning forest of the links."""
    over, under = SIMILAR
    for table in _groups(batches, ["root", "one", "two"]):
        a, b, links = [], [], []
        for start, stop in _spans(table, ["root", "one", "two"]):
            part = table.slice(start, stop - start)
            one, two = part["one"][0].as_py(), part["two"][0].as_py()
            block, reps, copies = part["block"].to_numpy(), part["rep"].to_numpy(), part["copies"].to_numpy()
            sets = [shingles(t) for t in part["text"].to_pylist()]
            li, ri = np.flatnonzero(block == one), np.flatnonzero(block == two)
            both = _shared([sets[i] for i in li], [sets[i] for i in ri])
            sizes = np.array([len(s) for s in sets], np.int64)
            linked = both * under >= (sizes[li][:, None] + sizes[ri][None, :] - both) * over
            if one == two:
                np.fill_diagonal(linked, False)
            sums = np.zeros(len(reps), np.int64)
            sums[li] += (linked * copies[ri][None, :]).sum(axis=1)
            if one != two:
                sums[ri] += (linked * copies[li][:, None]).sum(axis=0)
            some = np.flatnonzero(sums)
            a += reps[some].tolist()
            b += [None] * len(some)
            links += sums[some].tolist()
            root = list(range(len(reps)))

            def find(i: int, root: list[int] = root) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, row in zip(li.tolist(), linked, strict=True):
                for j in ri[row].tolist():
                    p, q = find(i), find(j)
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        a.append(int(reps[i]))
                        b.append(int(reps[j]))
                        links.append(None)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], names=["a", "b", "links"])


def _buckets(sets: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(bucket, rep, sketch) of the buckets with more than one set, large ones split further; and what was staged for it.

    A large bucket loses a pair at the least similarity with a chance of at most (e^(e^-1 - 1))^BOOST a round, and such
    a pair meets in RUNS buckets in the mean; lost_when_split() gives what that leaves. What no token parts after
    ROUNDS (near copies of each other) is compared block by block: every two blocks of BUCKET sets are a bucket.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy("bucket"))
    rows = sets.select("rep", F.explode("paths").alias("bucket")).withColumn("n", size).filter("n > 1")
    rows = stage(rows.join(sets.select("rep", "sketch"), "rep").select("bucket", "rep", "sketch", "n"), "near-buckets")
    out, large, staged = rows.filter(F.col("n") <= BUCKET), rows.filter(F.col("n") > BUCKET), [rows]
    for _ in range(ROUNDS):
        if large.isEmpty():
            return out.drop("n"), staged
        split = stage(large.select("bucket", "rep", "sketch").mapInArrow(tidy(_deeper), "bucket long, rep long, sketch binary").withColumn("n", size).filter("n > 1"), "near-split")
        staged.append(split)
        out, large = out.unionByName(split.filter(F.col("n") <= BUCKET)), split.filter(F.col("n") > BUCKET)
    blocks = F.ceil(F.col("n") / BUCKET).cast("int")
    dealt = large.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    paired = dealt.select(F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"), "rep", "sketch")
    return out.drop("n").unionByName(paired), staged


def join(docs: DataFrame, *, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Links every two documents whose sets of WORDS-word shingles have a Jaccard similarity of 0.8 or more.

    1. Documents of equal sets are one set with a number of copies.
    2. Chosen paths: in each of RUNS runs a set follows the paths of DEPTH tokens that hash small; sets that end on the
       same path share a bucket, and large buckets are split by more tokens. RUNS follows from RECALL.
    3. Brute force in the buckets joins sets of similar sketches to groups.
    4. In each group, in blocks of about GROUP sets, exact similarities over the whole texts give links and classes.

    Returns key, class_id (the smallest key of the documents that links connect, itself without any), n_links (how many
    other documents are linked to this one, copies counted), class_size, first (whether it stands for its class: the
    smallest key, of equals the first read), and carry as the struct `row`. Case and punctuation don't count. Texts of
    fewer words are linked if all their words are equal; null texts and texts without words have no links. Repeated
    rows are copies of each other. An empty table gives an empty result.
    """
    inside = text if text in carry else None  # a text is written once
    rows = docs.select(F.monotonically_increasing_id().alias("at"), column(key).alias("key"), *([] if inside else [column(text).alias("text")]), *whole_row(carry))
    schema = StructType(list(rows.schema.fields)).add("sign", StringType()).add("size", IntegerType()).add("paths", ArrayType(LongType())).add("sketch", BinaryType())
    read = stage(rows.mapInArrow(tidy(lambda batches: _read(batches, inside)), schema), "near-read")
    whole_text = (F.col("row").getField(inside) if inside else F.col("text")).alias("text")
    copies = read.filter("sign IS NOT NULL").groupBy("sign").agg(F.min("at").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"))
    copies = stage(copies, "near-copies")
    sets = read.select(F.col("at").alias("rep"), "paths", "sketch").join(copies.select("rep"), "rep")
    buckets, staged = _buckets(sets)
    groups = components(buckets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_alike), "a long, b long"))
    drop(*staged)
    # exact: members of a group, in blocks
    # sums by group are written before they are joined: Spark may then split the rows of a large group
    sized = groups.join(stage(groups.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "near-sizes"), "root")
    blocks = F.ceil(F.col("members") / GROUP).cast("int")
    placed = sized.select("root", F.col("node").alias("rep"), blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    placed = placed.join(copies.select("rep", "copies"), "rep").join(read.select(F.col("at").alias("rep"), whole_text), "rep")
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    dealt = paired.repartition("root", "one", "two").sortWithinPartitions("root", "one", "two", "rep").select("root", "one", "two", "block", "rep", "copies", "text")
    found = stage(dealt.mapInArrow(tidy(_verify), "a long, b long, links long"), "near-links")
    links = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    classes = components(found.filter("b IS NOT NULL").select("a", "b"))
    summed = copies.join(classes.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    whole = stage(summed.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size")), "near-classes")
    stands = summed.join(whole, "root").select("sign", "root", "class_id", "class_size", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    known = read.select("at", "key", "sign", *(["row"] if carry else [])).withColumnRenamed("sign", "own")
    out = known.join(stands, F.coalesce("own", F.concat(F.lit("at "), F.col("at").cast("string"))) == F.col("sign"), "left")
    # the first of a class: the smallest key, of equals the first read
    firsts = out.filter("root IS NOT NULL").groupBy(F.col("root").alias("f_root")).agg(F.min(F.struct(F.col("key").isNull(), "key", "at")).getField("at").alias("f_at"))
    out = out.join(firsts, F.col("at") == F.col("f_at"), "left")
    return out.select(
        F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (F.col("root").isNull() | F.col("f_at").isNotNull()).alias("first"), *(["row"] if carry else []),
    )


def op1_near(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def keep_firsts(docs: DataFrame) -> DataFrame:
    """One document of each class; same columns."""
    return join(docs, carry=docs.columns).filter("first").select(*unpacked(docs.columns))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+4], ' ') END AS g
  FROM w, range(1, greatest(len(w) - 4, 1) + 1) r(i) WHERE len(w) > 0
), k AS MATERIALIZED (SELECT doc_id, md5(g) AS h FROM g),
n AS (SELECT doc_id, count(*) AS n FROM k GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM k x JOIN k y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE c * 5 >= (p.n + q.n - c) * 4
), t AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a),
m AS (SELECT b AS doc_id, min(a) AS class_id FROM t GROUP BY b),
s AS (SELECT class_id, count(*) AS class_size FROM m GROUP BY class_id)
SELECT m.doc_id, class_id, coalesce(c, 0) AS n_links, class_size, m.doc_id = class_id AS first
FROM m JOIN s USING (class_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS c FROM l GROUP BY a) USING (doc_id)
"""
