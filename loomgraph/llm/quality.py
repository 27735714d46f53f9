"""Quality classifier: an interpolated modified Kneser-Ney model of letters, trained on trusted text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .shared import column, drop, free_shuffles, give_back, stage, tidy, unpacked, whole_row

#: Letters of an n-gram, and bits of a letter in its code. The n-gram's length stands above the letters.
ORDER, BITS, TAG = 4, 15, 60
#: Fixed symbols: a word that repeats the one before, the start and the end of a text.
AGAIN, START, END = "\x07", 2, 3
#: Code points that are scored together, texts counted at once, trusted ids that are sent to every executor (8 bytes each).
BLOCK, SLICE, SENT = 16_000_000, 64, 2_000_000
#: Languages whose thresholds are sent to every executor; with more, documents and thresholds are joined by language.
LANGUAGES = 10_000
#: Parts of the trusted documents; each is scored by a model of the others, so that no document vouches for itself.
FOLDS = 2
#: A document goes if its surprise is above the median of held-out trusted ones by more than so many times the way from
#: the median to the 0.9 quantile: a tenth of them would have to be outliers to move it.
SPREADS = 8.0
#: Held-out trusted documents that a language needs for a threshold of its own.
LEAST = 100


def symbols(text: str) -> np.ndarray:
    """Code points, those of 2**15 and above folded into half that range.

    A word that repeats the one before becomes one symbol, with the blank that follows: repetition, which letters
    alone would find likely, is then as rare as it is in trusted text.
    """
    out, before = [], None
    for word in text.split(" "):
        out.append(AGAIN if word and word == before else word + " ")
        before = word
    points = np.frombuffer("".join(out).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    half = 1 << BITS - 1
    return np.where(points < 1 << BITS, points, (points * 2_654_435_761 >> 7) % half + half)


def codes(text: str) -> np.ndarray:
    """The codes of the text's n-grams, one for each symbol and one for the end."""
    s = np.concatenate([np.full(ORDER - 1, START), symbols(text), [END]])
    out = np.zeros(len(s) - ORDER + 1, np.int64)
    for i in range(ORDER):
        out = out << BITS | s[i : i + len(out)]
    return out | ORDER << TAG


def shorter(code: np.ndarray, n: int) -> np.ndarray:
    """The code of the last n symbols."""
    return code & (1 << BITS * n) - 1 | n << TAG


def context(code: np.ndarray, n: int) -> np.ndarray:
    """The code of all but the last symbol of n-grams of n symbols."""
    return (code & (1 << BITS * n) - 1) >> BITS | n - 1 << TAG


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def summed() -> tuple[np.ndarray, np.ndarray]:
        grams, inverse = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        return grams, np.bincount(inverse, np.concatenate([c for _, c in held])).astype(np.int64)

    def out() -> pa.RecordBatch:
        grams, counts = summed()
        held.clear()
        return pa.RecordBatch.from_pydict({"gram": grams, "n": counts})

    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            held.append(np.unique(np.concatenate([codes(t) for t in b["text"].slice(at, SLICE).to_pylist()]), return_counts=True))
            if len(held) >= 16:
                held[:] = [summed()]
                if len(held[0][0]) > 1_000_000:
                    yield out()
    if held:
        yield out()


def count(trusted: DataFrame) -> DataFrame:
    """(gram, n): the longest n-grams of the column `text`."""
    return trusted.select("text").mapInArrow(tidy(_count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def train(counts: DataFrame) -> tuple[DataFrame, float]:
    """The model from staged counts of the longest n-grams: rows (gram, share, rest), and the share of an unseen symbol.

    Counts of the longest n-grams are summed by n-gram; of shorter ones, the distinct symbols that precede them are
    counted. Each length has three discounts, from how many n-grams occur one to four times. share is the discounted
    count over that of the context; rest, on the row of a context, is the weight of the next shorter n-gram. All
    tables are joined by n-gram, so they may grow with the corpus.
    """
    level, parts, seen = counts, [], 0
    for length in range(ORDER, 0, -1):
        of = level.agg(*[F.coalesce(F.count_if(F.col("n") == k), F.lit(0)).alias(f"n{k}") for k in (1, 2, 3, 4)], F.count(F.lit(1)).alias("all")).first()  # five numbers
        seen = of["all"]
        y = of["n1"] / (of["n1"] + 2 * of["n2"]) if of["n1"] else 0.0
        cut = [min(k, max(0.0, k - (k + 1) * y * of[f"n{k + 1}"] / of[f"n{k}"])) if of[f"n{k}"] else 0.5 for k in (1, 2, 3)]
        taken = F.when(F.col("n") == 1, cut[0]).when(F.col("n") == 2, cut[1]).otherwise(cut[2])
        over = F.shiftright(F.col("gram").bitwiseAND((1 << BITS * length) - 1), BITS).bitwiseOR(length - 1 << TAG)
        rows = level.select("gram", "n", over.alias("context"), taken.alias("taken"))
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("taken").alias("spared"))
        parts.append(rows.join(contexts, "context").select("gram", ((F.col("n") - F.col("taken")) / F.col("total")).alias("share"), F.lit(None).cast("double").alias("rest")))
        parts.append(contexts.select(F.col("context").alias("gram"), F.lit(None).cast("double").alias("share"), (F.col("spared") / F.col("total")).alias("rest")))
        level = level.groupBy(F.col("gram").bitwiseAND((1 << BITS * (length - 1)) - 1).bitwiseOR(length - 1 << TAG).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    model = reduce(DataFrame.unionByName, parts).groupBy("gram").agg(F.max("share").alias("share"), F.max("rest").alias("rest"))
    return stage(model, "quality-model"), 1 / (seen + 1)


def _texts(part: pa.RecordBatch, inside: str | None) -> pa.Array:
    """The texts of a batch: the column `text`, or a field of the struct `row`, where null counts as empty."""
    return part["text"] if inside is None else part["row"].field(inside).fill_null("")


def _asked(batches: Iterator[pa.RecordBatch], inside: str | None) -> Iterator[pa.RecordBatch]:
    """The n-grams of every length that each block of documents asks for; a block's come together."""
    held: dict[int, list[np.ndarray]] = {}

    def out(block: int) -> pa.RecordBatch:
        grams = np.unique(np.concatenate(held.pop(block)))
        every = np.unique(np.concatenate([shorter(grams, n) for n in range(1, ORDER + 1)] + [context(shorter(grams, n), n) for n in range(1, ORDER + 1)]))
        return pa.RecordBatch.from_pydict({"block": np.full(len(every), block, np.int64), "gram": every})

    for b in batches:
        blocks = b["block"].to_numpy()
        for block in np.unique(blocks).tolist():
            own = _texts(b, inside).filter(pa.array(blocks == block))
            for at in range(0, len(own), SLICE):
                held.setdefault(block, []).append(np.unique(np.concatenate([codes(t) for t in own.slice(at, SLICE).to_pylist()])))
                if len(held[block]) > 16:
                    held[block] = [np.unique(np.concatenate(held[block]))]
    for block in list(held):
        yield out(block)


def surprises(texts: Sequence[str], grams: np.ndarray, share: np.ndarray, rest: np.ndarray, unseen: float) -> list[float]:
    """The mean surprise of each text in nats; grams are sorted, with what the model has for them."""

    def find(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(grams):
            return np.full(len(keys), np.nan)
        at = np.searchsorted(grams, keys).clip(max=len(grams) - 1)
        return np.where(grams[at] == keys, values[at], np.nan)

    out: list[float] = []
    for at in range(0, len(texts), SLICE):
        found = [codes(t) for t in texts[at : at + SLICE]]
        distinct, inverse = np.unique(np.concatenate(found), return_inverse=True)
        p = np.full(len(distinct), unseen)
        for n in range(1, ORDER + 1):
            keys = shorter(distinct, n)
            weight = find(context(keys, n), rest)  # null: a context that was never seen
            p = np.where(np.isnan(weight), p, np.nan_to_num(find(keys, share)) + np.nan_to_num(weight) * p)
        bits, ends = -np.log(p)[inverse], np.cumsum([len(f) for f in found])
        sums = np.add.reduceat(bits, np.concatenate([[0], ends[:-1]]))
        out += (sums / [len(f) for f in found]).tolist()
    return out


def _scorer(unseen: float, kept: list[str], inside: str | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams = answers["gram"].to_numpy()
        order = np.argsort(grams)
        share, rest = (answers[c].to_numpy(zero_copy_only=False).astype(np.float64)[order] for c in ("share", "rest"))
        grams, found = grams[order], []
        for b in docs.to_batches():
            for at in range(0, b.num_rows, 1_024):
                found += surprises(_texts(b.slice(at, 1_024), inside).to_pylist(), grams, share, rest, unseen)
        give_back()
        return docs.select(kept).append_column("surprise", pa.array(found, pa.float64()))

    return run


def _scored(rows: DataFrame, model: DataFrame, unseen: float, inside: str | None = None) -> DataFrame:
    """Rows without their column `text`, with the surprise of each; the text may be a field of the struct `row`.

    Documents are dealt at random into blocks of about BLOCK code points, so that rows that repeat fill no block. A
    block asks for its distinct n-grams; the questions are joined with the model by n-gram, and the answers come back
    to the block, so that neither the model nor the corpus has to fit anywhere. Texts are shuffled once for both.
    """
    text = F.coalesce(F.col("row").getField(inside) if inside else F.col("text"), F.lit(""))
    size = rows.agg(F.sum(F.length(text) + 1).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK))
    spread = F.xxhash64(F.monotonically_increasing_id(), "key")
    dealt = rows.withColumn("block", F.pmod(spread, F.lit(blocks))).repartition(blocks, "block")
    asked = dealt.mapInArrow(tidy(lambda batches: _asked(batches, inside)), "block long, gram long")
    answers = asked.join(model, "gram").select("block", "gram", "share", "rest")
    kept = [c for c in rows.columns if c != "text"]
    result = StructType([f for f in rows.schema.fields if f.name != "text"]).add("surprise", DoubleType())
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scorer(unseen, kept, inside), result)


def held_out(known: DataFrame, folds: Sequence[DataFrame]) -> DataFrame:
    """(lang, surprise) of trusted documents, each by a model of the folds that it is not in. Empty if only one fold has documents."""
    sizes = [r["fold"] for r in known.select("fold").distinct().collect()]  # FOLDS numbers
    parts, models = [], []
    for fold in sizes:
        if len(sizes) > 1:
            others = reduce(DataFrame.unionByName, [c for f, c in enumerate(folds) if f != fold])
            model, unseen = train(stage(others.groupBy("gram").agg(F.sum("n").alias("n")), "quality-counts") if len(folds) > 2 else others)
            models.append(model)
            parts.append(_scored(known.filter(F.col("fold") == fold), model, unseen).select("lang", "surprise"))
    empty = known.select("lang", F.lit(None).cast("double").alias("surprise")).limit(0)
    found = stage(reduce(DataFrame.unionByName, parts, empty), "quality-held-out")
    drop(*models)
    return found


def limit() -> Column:
    """The threshold from the held-out surprises of a group."""
    low, high = (F.percentile_approx("surprise", q, 100_000) for q in (0.5, 0.9))
    return low + SPREADS * (high - low)


def score(docs: DataFrame, trusted_ids: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", carry: Sequence[str] = ()) -> DataFrame:
    """Scores every whole text by a model trained on the documents whose key is in trusted_ids (one column `id`, distinct).

    Trusted ids go to every executor up to SENT of them, beyond that the join shuffles.

    Returns key, lang, trusted, perplexity, threshold, keep, and carry as the struct `row`. A document is kept if its
    surprise is at most the limit of its language, which comes from held-out scores of trusted documents; a language
    with fewer than LEAST of them, or null, takes the limit of all. If all trusted texts are in one fold, the limit
    comes from their own scores. Null texts and texts without anything but white space have no perplexity and are not
    kept. Without trusted text there is no model: everything else is kept, with null perplexity and threshold.
    """
    ids = stage(trusted_ids.select(F.col("id").cast("long").alias("trusted_id")), "quality-trusted")
    known = ids.count()
    side = F.broadcast(ids) if known <= SENT else ids
    inside = text if text in carry else None  # a text travels once
    real = F.coalesce(F.rlike(column(text), F.lit(r"[^\s\u00a0]")), F.lit(False))
    whole = F.coalesce(column(text), F.lit("")).alias("text")
    rows = docs.select(column(key).alias("key"), column(lang).alias("lang"), *([] if inside else [whole]), real.alias("real"), *whole_row(carry))
    candidates = docs.filter(real).select(column(key).alias("key"), column(lang).alias("lang"), whole)
    known_rows = stage(candidates.join(side, F.col("key") == F.col("trusted_id"), "left_semi").withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS))), "quality-trusted-texts")
    folds = [stage(count(known_rows.filter(F.col("fold") == f)), f"quality-counts-{f}") for f in range(FOLDS)]
    model, unseen = train(stage(reduce(DataFrame.unionByName, folds).groupBy("gram").agg(F.sum("n").alias("n")), "quality-counts"))
    scored = _scored(rows, model, unseen, inside)
    # narrow: which of the scored documents are trusted
    flags = ids.select("trusted_id", F.lit(True).alias("trusted"))
    marked = scored.join(F.broadcast(flags) if known <= SENT else flags, F.col("key") == F.col("trusted_id"), "left").drop("trusted_id").withColumn("trusted", F.coalesce("trusted", F.lit(False)) & F.col("real"))
    fresh = held_out(known_rows, folds)
    limits = stage(fresh.groupBy("lang").agg(limit().alias("of_lang"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST).select(F.col("lang").alias("l_lang"), "of_lang"), "quality-limits")
    few = F.broadcast(limits) if limits.count() <= LANGUAGES else limits  # documents are not dealt by language, as few languages have most
    of_all = fresh.agg(limit()).first()[0]
    if of_all is None:  # one trusted text or none: nothing is held out
        of_all = _scored(known_rows.select("key", "lang", "text"), model, unseen).agg(limit()).first()[0]
    drop(known_rows, fresh, *folds)
    free_shuffles(docs.sparkSession)  # held-out texts were shuffled for a few numbers, so that stage() lets them lie
    limited = marked.join(few, F.col("lang") == F.col("l_lang"), "left").withColumn("limit", F.coalesce("of_lang", F.lit(of_all).cast("double")))
    usable = F.col("real") & F.col("limit").isNotNull()
    return limited.select(
        F.col("key").alias(key), F.col("lang").alias(lang), "trusted", F.when(usable, F.exp("surprise")).alias("perplexity"), F.exp("limit").alias("threshold"),
        (F.col("real") & F.coalesce(F.col("surprise") <= F.col("limit"), F.lit(True))).alias("keep"), *(["row"] if carry else []),
    )


def trusted(labels: DataFrame) -> DataFrame:
    """Ids that labels calls good and never bad."""
    return labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select(F.col("doc_id").alias("id"))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return score(docs, trusted(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps; same columns."""
    return score(docs, trusted(labels), carry=docs.columns).filter("keep").select(*unpacked(docs.columns))
