"""Language identification by hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components of a vector, letters of an n-gram (three at most, for codes of 63 bits), texts worked on at once.
DIMS, LETTERS, SLICE = 512, 3, 128
SEED = 20_011
BLANK = 32


class Space:
    """Random vectors of +1 and -1 for letters, made from the seed when a letter is first met; the same everywhere."""

    def __init__(self, dims: int = DIMS, letters: int = LETTERS, seed: int = SEED):
        self.dims, self.letters, self.seed = dims, letters, seed
        self.kind = np.full(0x110000, -1, np.int32)  # -1: not met yet; else the code point that stands for it
        self.row_of = np.zeros(0x110000, np.int32)
        self.rows = np.zeros((0, dims), np.int8)
        self.codes, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.grams = np.zeros((0, dims), np.int8)

    def symbols(self, text: str) -> np.ndarray:
        """Lower-case letters with one blank for each run of anything else, and at either end; empty without a letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind[points]
        if (fresh := points[kinds < 0]).size:
            for p in np.unique(fresh).tolist():
                self.kind[p] = p if chr(p).isalpha() else BLANK
            kinds = self.kind[points]
        if not (kinds != BLANK).any():
            return np.zeros(0, np.int64)
        framed = np.concatenate([[BLANK], kinds, [BLANK]])
        return framed[np.concatenate([[True], (framed[1:] != BLANK) | (framed[:-1] != BLANK)])].astype(np.int64)

    def ngrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams' codes and how often each occurs."""
        s = self.symbols(text)
        if not s.size:
            return s, s
        code = np.zeros(max(1, len(s) - self.letters + 1), np.int64)
        for i in range(self.letters):
            part = s[i : i + len(code)]
            code = code << 21 | np.concatenate([part, np.full(len(code) - len(part), BLANK)])
        return np.unique(code, return_counts=True)

    def letter(self, points: np.ndarray) -> np.ndarray:
        for p in np.unique(points).tolist():
            if not self.row_of[p]:
                self.rows = np.vstack([self.rows, np.random.default_rng([self.seed, p]).integers(0, 2, (1, self.dims), np.int8) * 2 - 1])
                self.row_of[p] = len(self.rows)
        return self.rows[self.row_of[points] - 1]

    def bound(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of n-grams: each letter's vector rolled by its distance from the end, multiplied."""
        out = np.ones((len(codes), self.dims), np.int8)
        for i in range(self.letters):
            out *= np.roll(self.letter(codes >> 21 * i & 0x1FFFFF), i, axis=1)
        return out

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """As bound(), remembering n-grams; codes are distinct and sorted."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        if not known.all():
            fresh = codes[~known]
            if len(self.codes) + len(fresh) > 100_000:
                self.codes, self.places, self.grams = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, self.dims), np.int8)
                fresh = codes
            self.places = np.concatenate([self.places, len(self.grams) + np.arange(len(fresh))])
            self.grams = np.vstack([self.grams, self.bound(fresh)])
            self.codes = np.concatenate([self.codes, fresh])
            order = np.argsort(self.codes)
            self.codes, self.places = self.codes[order], self.places[order]
            at = np.searchsorted(self.codes, codes)
        return self.grams[self.places[at]]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts.astype(np.float32) @ self.vectors(codes).astype(np.float32)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bundle for each language of the partition."""
    space, sums = Space(), {}
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            by: dict[str, list] = {}
            for lang, text in zip(b["lang"].slice(at, SLICE).to_pylist(), b["text"].slice(at, SLICE).to_pylist(), strict=True):
                by.setdefault(lang, []).append(space.ngrams(text))
            for lang, found in by.items():
                codes, inverse = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                if codes.size:
                    # every text counts alike, whatever its length
                    shares = np.concatenate([f[1] / max(1, f[1].sum()) for f in found])
                    sums[lang] = sums.get(lang, 0) + space.bundle(codes, np.bincount(inverse, shares)).astype(np.float64)
    if sums:
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(sums)), "bundle": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))})


def learn(labelled: DataFrame, *, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Language prototypes: the bundled n-gram vectors of all rows whose text and lang are not null.

    Each partition gives one vector a language, which are summed component by component; the driver gets DIMS numbers
    for each language. Texts without a letter teach nothing.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    parts = rows.mapInArrow(_learn, "lang string, bundle array<double>")
    summed = parts.select("lang", F.posexplode("bundle").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for r in summed.collect():
        found.setdefault(r["lang"], np.zeros(DIMS))[r["at"]] = r["value"]
    return dict(sorted(found.items()))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], *, key: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """Returns key, the columns of carry, lang_pred and score for every row.

    score is the cosine of the text's bundle with the nearest prototype, 0 if negative; equal cosines go to the
    smaller name. Null texts, texts without a letter and all texts without a prototype get `und` and 0.
    """
    names = list(prototypes)
    profiles = np.stack([prototypes[n] / (np.linalg.norm(prototypes[n]) or 1) for n in names]).astype(np.float32) if names else np.zeros((0, DIMS), np.float32)
    carry = carry or {}
    passed, state = ["_key", *carry], {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = state.setdefault("space", Space())
        for b in batches:
            langs, scores = [], []
            for text_ in b["_text"].to_pylist():
                codes, counts = space.ngrams(text_ or "")
                if not codes.size or not names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                vector = space.bundle(codes, counts)
                cosines = profiles @ vector / (np.linalg.norm(vector) or 1)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(1, max(0, cosines[best]))))
            yield pa.RecordBatch.from_arrays([*(b[n] for n in passed), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*passed, "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("_key"), *[c.alias(n) for n, c in carry.items()], F.col(text).alias("_text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, lang_pred string, score double").withColumnRenamed("_key", key)


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 0 when divided by 5; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    prototypes = learn(docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    return predict(docs, prototypes, carry={"held_out": held_out(F.col("doc_id"))})
