"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, documents, words
from tidemark.llm.language import remainder

#: Coordinates, and the expected number of labelled rows that a fit reads, which bounds the one task that learns.
DIMS, FIT_ROWS = 1 << 20, 10_000
#: FTRL-proximal: learning rate, its offset and L1; passes over the sample.
ALPHA, BETA, L1, PASSES = 2.0, 1.0, 4.0, 12
#: A coordinate enters the model if this many texts of the sample have it; what a pair or skip-gram counts, words count 1.
SEEN, PAIR = 3, 0.1
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(word_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values of a text: its words, its pairs of neighbours and its pairs with one word between.

    A coordinate is there once however often its n-gram occurs; coordinate 0, the intercept, is always on.
    """
    h = np.asarray(word_hashes, dtype=np.int64).view(np.uint64)
    two = (h[:-1] * _B) ^ (h[1:] * _A + _C)
    skip = (h[:-2] * _C) ^ (h[2:] * _B + _A)
    place = lambda x: 1 + np.unique((x * _A >> np.uint64(24)) % np.uint64(DIMS - 1)).astype(np.int64)
    one, more = place(h), place(np.concatenate((two, skip)))
    return np.concatenate(([0], one, more)), np.concatenate((np.ones(1 + len(one)), np.full(len(more), PAIR)))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA)
    return np.where(np.abs(z) <= L1, 0.0, w)


def _logistic(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -35.0), 35.0)))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights of DIMS coordinates, learnt from docs with labels of about fit_rows rows chosen by a hash of key.

    The sampled labels are bounded, so they are broadcast to the scan of docs. FTRL-proximal is sequential: one task runs
    it over the sample, with a learning rate per coordinate, L1, and only coordinates that SEEN texts have. Weights that
    are 0, nearly all, are not sent.

    A key with several labels has the greatest; one with several rows is learnt once, from the text with the least hash, so
    that repeated rows do not add to the sample. Null keys and labels are left out; a null text is an empty one, which has
    the intercept only. Long texts count whole; a coordinate counts once per text. Without labelled rows or documents, all
    weights are 0. Other columns are not read.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg((F.max(label) > 0).cast("int").alias("_y"))
    n = known.count()
    if not n:
        return np.zeros(DIMS)
    even = F.pmod(F.xxhash64("_key", F.lit(9)), F.lit(1 << 30))
    known = known.where(even < F.lit(min(1.0, fit_rows / n) * (1 << 30)))
    own = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(known), "_key")
    least = F.min(F.struct(F.xxhash64("_text").alias("t"), "_y", F.transform(words(F.lower(F.col("_text"))), lambda x: F.xxhash64(x)).alias("h")))
    rows = own.groupBy("_key").agg(least.alias("r")).select("_key", F.xxhash64("_key", F.lit(3)).alias("_o"), F.col("r._y").alias("_y"), F.col("r.h").alias("h"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_o", "_key"])
        ys = pdf["_y"].to_numpy()
        z, n, seen = np.zeros(DIMS), np.zeros(DIMS), np.zeros(DIMS, dtype=np.int32)
        for h in pdf["h"]:
            seen[features(h)[0]] += 1
        seen[0] = SEEN
        xs = []
        for h in pdf["h"]:  # only what is often enough is held, as coordinates and the number of those that count 1
            x, v = features(h)
            keep = seen[x] >= SEEN
            xs.append((x[keep].astype(np.int32), int((v[keep] == 1).sum())))
        for _ in range(PASSES):
            for (x, words_), y in zip(xs, ys, strict=True):
                v = np.full(len(x), PAIR)
                v[:words_] = 1
                zx, nx = z[x], n[x]
                w = _weights(zx, nx)
                g = (_logistic(w @ v) - y) * v
                z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA * w
                n[x] = nx + g * g
        w = _weights(z, n)
        at = np.flatnonzero(w)
        return pd.DataFrame({"dim": at, "w": w[at]})

    out = np.zeros(DIMS)
    for dim, w in rows.groupBy(F.lit(0).alias("_all")).applyInPandas(learn, "dim int, w double").collect():
        out[dim] = w
    return out


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> Column:
    """The probability that a text is toxic; a null or empty text has the intercept's, repeated rows have equal ones.

    The weights are broadcast as the coordinates that are not zero: at most DIMS, whatever the input. Texts are scored
    whole, in time that grows with their length. The result is a column, so no column of docs is replaced.
    """
    bounded_batches(docs.sparkSession)
    at = np.flatnonzero(weights)
    shared = docs.sparkSession.sparkContext.broadcast((at, weights[at]))

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = np.zeros(DIMS)
        w[shared.value[0]] = shared.value[1]
        for hashes in batches:
            yield pd.Series([_logistic(w[x] @ v) for x, v in map(features, hashes)], dtype=float)

    return apply(F.transform(words(F.lower(F.col(f"`{text}`"))), lambda x: F.xxhash64(x)))


def op9_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from labels outside the held-out fifth."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    held = remainder(F.col("doc_id"), 5) == 0
    weights = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held))
    s = score(docs, weights)
    out = docs.select("doc_id", held.alias("held_out"), s.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
