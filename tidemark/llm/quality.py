"""Quality by supervised subword embeddings: word and character n-gram vectors, averaged per document, under a softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, documents, materialise, release
from tidemark.llm.language import remainder

#: Hashed words and n-grams share BUCKETS vectors of WIDTH numbers; n-grams of LENGTHS characters, words set off by blanks.
BITS, WIDTH, LENGTHS = 16, 8, (3, 4)
BUCKETS = 1 << BITS
#: What a fit reads at most: expected labelled rows, and distinct buckets of all of them (8 bytes each).
FIT_ROWS, FIT_ENTRIES = 10_000, 1 << 25
#: Stochastic gradient descent: passes, learning rates of vectors and of the output layer (both fall to 0), and a seed.
PASSES, VECTOR_RATE, OUTPUT_RATE, SEED = 8, 20.0, 0.2, 13
#: Characters of a text that are looked at together; a text is cut at a blank, and only a longer word within.
PIECE = 1 << 20
_SALT = np.arange(8, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PIECE:
        cut = text.rfind(" ", start, start + PIECE)
        cut = start + PIECE if cut <= start else cut
        yield text[start:cut]
        start = cut
    yield text[start:]


def occurrences(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of a text's words and of the character n-grams within a word and its blanks, as often as they occur.

    Each word adds one of 16 buckets for its share of all words (a half or more, a quarter, ...), so that repetition shows.
    """
    for piece in _pieces(text or ""):
        words = piece.lower().split()
        if not words:
            continue
        c = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
        blank = c == 32
        at = np.flatnonzero(blank)
        long = np.diff(at)  # characters of each word, and one
        place = np.arange(len(c) - 1) - np.repeat(at[:-1], long)
        power = np.cumprod(np.concatenate(([np.uint64(0)], [np.uint64(1)], np.full(int(long.max()), _A)))[1:])
        names = np.add.reduceat(c[:-1] * power[place], at[:-1])
        _, which, often = np.unique(names, return_inverse=True, return_counts=True)
        share = np.minimum(np.log2(len(names) / often).astype(np.uint64), np.uint64(15))[which]
        found = [_bucket(names * _C), _bucket((share + np.uint64(1)) * _B)]
        h, inside = c, ~blank
        for n in range(2, max(LENGTHS) + 1):
            m = len(c) - n + 1
            h = h[:m] * _A + c[n - 1 :]
            if n in LENGTHS:
                found.append(_bucket((h if n == 2 else h[inside[:m]]) ^ _SALT[n]))
            if n == 2:
                inside = ~blank[1:]
            else:
                inside = inside[:m] & ~blank[n - 1 :]
        yield np.concatenate(found)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and how often each occurs."""
    total = sum((np.bincount(x, minlength=BUCKETS) for x in occurrences(text)), np.zeros(BUCKETS, dtype=np.int64))
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.float32)


@dataclass
class Model:
    """A vector per bucket, and the weights and offsets of the two outputs."""

    vectors: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def logits(self) -> np.ndarray:
        """What each bucket adds to the difference of the outputs; the mean of it over a text, and the offsets, give its score."""
        return self.vectors.astype(float) @ (self.weights[1] - self.weights[0])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Stochastic gradient descent over texts as (distinct buckets, counts) in a shuffled order, one text a step."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    weights, offsets = np.zeros((2, WIDTH)), np.zeros(2)
    step, steps = 0, PASSES * len(texts)
    for _ in range(PASSES):
        for i in rng.permutation(len(texts)):
            at, n = texts[i]
            share = n / max(1.0, float(n.sum()))
            x = share @ vectors[at]
            error = _softmax(weights @ x + offsets)
            error[labels[i]] -= 1
            rate = 1 - step / steps
            vectors[at] -= np.outer(share, (VECTOR_RATE * rate) * (error @ weights)).astype(np.float32)
            weights -= OUTPUT_RATE * rate * np.outer(error, x)
            offsets -= OUTPUT_RATE * rate * error
            step += 1
    return Model(vectors, weights, offsets)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS, fit_entries: int = FIT_ENTRIES) -> Model:
    """Learn from about fit_rows labelled rows, chosen by a hash of key; fewer if their texts have over fit_entries distinct buckets.

    The sampled labels are bounded, so they are broadcast to the scan of docs. Texts become counts of buckets where they
    are read, at most 12 bytes a bucket however long the text, and one task learns from these. The model, 2 MB, comes to the driver.

    A key with several labels has the greatest; one with several rows is learnt once, from the text with the least hash.
    Null keys and labels are left out; a null text is an empty one, from which only the offsets are learnt. Without
    labelled rows or documents every score is a half. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg((F.max(label) > 0).cast("int").alias("y"))
    n = known.count()
    even = F.pmod(F.xxhash64("key", F.lit(13)), F.lit(1 << 30)).alias("even")
    known = known.select("*", even).where(F.col("even") < F.lit(min(1.0, fit_rows / max(1, n)) * (1 << 30)))
    own = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).join(F.broadcast(known), "key")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [counted(t) for t in pdf["text"]]
            yield pd.DataFrame({"key": pdf["key"], "hash": pdf["hash"], "even": pdf["even"], "y": pdf["y"], "n": [len(a) for a, _ in found], "at": [a.tobytes() for a, _ in found], "often": [c.tobytes() for _, c in found]})

    rows = own.select(F.col("key").cast("string").alias("key"), F.xxhash64("text").alias("hash"), "even", "y", "text").mapInPandas(count, "key string, hash long, even long, y int, n int, at binary, often binary")
    rows = rows.groupBy("key").agg(F.min(F.struct("hash", "even", "y", "n", "at", "often")).alias("r")).select("key", "r.*")
    rows = materialise(rows, "quality-rows")
    entries, last = rows.agg(F.sum("n"), F.max("even")).first()
    if (entries or 0) > fit_entries:
        rows_kept = rows.where(F.col("even") <= F.lit(int(last * fit_entries / entries)))
    else:
        rows_kept = rows

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["even", "key"])
        texts = [(np.frombuffer(a, dtype=np.int32), np.frombuffer(c, dtype=np.float32)) for a, c in zip(pdf["at"], pdf["often"], strict=True)]
        m = train(texts, pdf["y"].to_numpy())
        return pd.DataFrame({"vectors": [m.vectors.tobytes()], "weights": [m.weights.tobytes()], "offsets": [m.offsets.tobytes()]})

    found = rows_kept.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "vectors binary, weights binary, offsets binary").collect()
    release(rows)
    if not found:
        return Model(np.zeros((BUCKETS, WIDTH), dtype=np.float32), np.zeros((2, WIDTH)), np.zeros(2))
    return Model(np.frombuffer(found[0].vectors, dtype=np.float32).reshape(BUCKETS, WIDTH), np.frombuffer(found[0].weights).reshape(2, WIDTH), np.frombuffer(found[0].offsets))


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The probability that a text is good; a null or empty text has the offsets', repeated rows have equal ones.

    A number per bucket is broadcast, half a megabyte. Texts are scored whole, a piece at a time. The result is a column,
    so no column of docs is replaced.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.logits(), float(model.offsets[1] - model.offsets[0])))

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        logits, offset = shared.value
        for texts in batches:
            yield pd.Series([_score(t, logits, offset) for t in texts], dtype=float)

    return apply(F.col(f"`{text}`"))


def _score(text: str | None, logits: np.ndarray, offset: float) -> float:
    total, n = 0.0, 0
    for x in occurrences(text):
        total, n = total + float(logits[x].sum()), n + len(x)
    return float(1 / (1 + np.exp(-min(max(total / max(1, n) + offset, -35.0), 35.0))))


def op13_subword_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from labels outside the held-out fifth."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    held = remainder(F.col("doc_id"), 5) == 0
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held))
    out = docs.select("doc_id", held.alias("held_out"), score(docs, model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
