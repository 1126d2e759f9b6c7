"""Language identification by nearest centroids of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, documents, free_names, without

#: n-grams of bytes of these lengths share DIMS hashed dimensions.
LENGTHS, DIMS = (2, 3, 4), 8192
#: Expected number of training texts per language for the centroids, and centroids per language.
FIT_TEXTS, CENTROIDS, ROUNDS = 1000, 4, 8
#: A text of at least 2 ** SHORT n-grams is rejected if its cosine with the nearest centroid is below SLACK times the QUANTILE of texts of its length.
QUANTILE, SLACK, SHORT = 0.001, 0.3, 6
UNKNOWN = "und"
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))


def _letters() -> np.ndarray:
    """Bytes that are not letters become blanks; bytes beyond ASCII are parts of letters."""
    table = np.full(256, 32, dtype=np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


_LETTERS = _letters()


def _counts(raw: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed n-grams of a lower-case text's bytes, words set off by single blanks."""
    b = _LETTERS[raw]
    b = np.concatenate(([np.uint8(32)], b, [np.uint8(32)]))
    blank = b == 32
    b = b[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint32)
    if len(b) < 3:
        return None
    found = []
    for n in LENGTHS:
        if len(b) < n:
            continue
        h = np.zeros(len(b) - n + 1, dtype=np.uint32)
        for i in range(n):
            h = (h + b[i : len(b) - n + 1 + i] + np.uint32(n)) * _MULTIPLIERS[i]
            h ^= h >> np.uint32(15)
        found.append(h % np.uint32(DIMS))
    return np.bincount(np.concatenate(found), minlength=DIMS)


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    """The bytes of each text of a batch, without a copy."""
    column = batch.column(name)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if pa.types.is_large_string(column.type) else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    for i in range(len(column)):
        yield data[offsets[i] : offsets[i + 1]]


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts).astype(np.float32) * idf
    norm = float(np.sqrt(v @ v))
    return v / norm if norm else v


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def document_frequency(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each hashed n-gram occurs; tasks send one vector each, summed by dimension."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for raw in _texts(batch, "t"):
                n += 1
                if (c := _counts(raw)) is not None:
                    total += c > 0
        at = np.append(np.flatnonzero(total), DIMS)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.append(total[at[:-1]], n), pa.int64())], ["dim", "n"])

    rows = texts.mapInArrow(count, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    out, n = np.zeros(DIMS, dtype=np.int64), 0
    for dim, count_ in rows:
        if dim == DIMS:
            n = count_
        else:
            out[dim] = count_
    return out, n


class Model:
    """Languages, their centroids (one row each), IDF weights and the least cosine that is accepted by length class."""

    def __init__(self, langs: list[str], owner: np.ndarray, centroids: np.ndarray, idf: np.ndarray, floors: np.ndarray):
        self.langs, self.owner, self.centroids, self.idf, self.floors = langs, owner, centroids, idf, floors


def _length_class(n: np.ndarray | int):
    return np.minimum(np.log2(np.maximum(n, 1)).astype(int), 15)


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", fit_texts: int = FIT_TEXTS) -> Model | None:
    """Fit on train's rows that have a text and a language; None without any.

    IDF weights come from all of them. Centroids come from a sample of about fit_texts distinct rows per language,
    chosen by a hash of key and text, so that the driver and a task never hold more: spherical k-means with a fixed
    start splits each language's vectors into CENTROIDS clusters. The rejection floor of each length class is SLACK times
    the QUANTILE of the sample's cosines with its own language, and 0 for texts of fewer than 2 ** SHORT n-grams.

    Null keys are equal keys, told apart by their texts; a row that is repeated is sampled once. Null texts and languages
    are left out; texts without letters count for IDF only. Long texts count whole. Ties between vectors go to the first in
    the order of key and text. An empty table gives None. Other columns are not read.
    """
    bounded_batches(train.sparkSession)
    of = lambda c: F.col(f"`{c}`")
    rows = train.where(of(text).isNotNull() & of(lang).isNotNull()).select(of(lang).alias("lang"), lowered(of(text)).alias("t"), of(key).alias("k"))
    own = F.xxhash64(F.coalesce(F.col("k").cast("string"), F.lit("")), "t", F.lit(5))
    df, n = document_frequency(rows.select("t"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.approx_count_distinct(own, 0.02)).collect()}
    if not counts:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
    share = F.lit(0.0)
    for name, c in counts.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, fit_texts / c))).otherwise(share)
    sample = rows.where(F.pmod(own, F.lit(1 << 30)) < share * F.lit(1 << 30)).dropDuplicates(["lang", "k", "t"])

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["k", "t"])
        x, sizes = np.empty((len(pdf), DIMS), dtype=np.float32), []
        for t in pdf["t"]:
            if (c := _counts(np.frombuffer(t.encode(), dtype=np.uint8))) is not None:
                x[len(sizes)] = _weigh(c, idf)
                sizes.append(c.sum())
        if not sizes:
            return pd.DataFrame({"lang": [], "kind": [], "v": []})
        x, length = x[: len(sizes)], _length_class(np.array(sizes))
        mean = x.sum(axis=0)
        chosen = [x[int(np.argmax(x @ mean))]]
        while len(chosen) < min(CENTROIDS, len(x)):  # the farthest from those chosen
            chosen.append(x[int(np.argmin((x @ np.stack(chosen).T).max(axis=1)))])
        c = np.stack(chosen)
        for _ in range(ROUNDS):
            mine = (x @ c.T).argmax(axis=1)
            for j in range(len(c)):
                if (mine == j).any():
                    c[j] = x[mine == j].sum(axis=0)
                    c[j] /= np.linalg.norm(c[j]) or 1
        c = np.vstack([c, mean / (np.linalg.norm(mean) or 1)])
        best = (x @ c.T).max(axis=1)
        floors = np.array([np.quantile(best[length == k], QUANTILE) * SLACK if (length == k).any() else np.nan for k in range(16)])
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "kind": ["c"] * len(c) + ["f"], "v": [*(r.astype(float).tolist() for r in c), floors.tolist()]})

    learnt = sample.groupBy("lang").applyInPandas(cluster, "lang string, kind string, v array<double>").collect()
    langs = sorted({r["lang"] for r in learnt})
    if not langs:
        return None
    centres = sorted(((langs.index(r["lang"]), list(r["v"])) for r in learnt if r["kind"] == "c"), key=lambda x: (x[0], x[1]))
    floors = np.array([[np.nan if v is None else v for v in r["v"]] for r in learnt if r["kind"] == "f"], dtype=float)
    least = np.array([np.nanmin(c) if np.isfinite(c).any() else np.nan for c in floors.T])
    least = np.where(np.isfinite(least), least, np.nanmin(least))
    floor = np.minimum.accumulate(least[::-1])[::-1]
    floor[:SHORT] = 0  # too short to judge by distance
    return Model(langs, np.array([c[0] for c in centres]), np.array([c[1] for c in centres], dtype=np.float32), idf, floor)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (cosine with the nearest centroid) and rejected.

    A text that is null or has no letter is und with score 0 and is rejected. Any other text gets the language of the
    nearest centroid (ties: the first), and is rejected if its cosine is below the floor of its length class. Without a
    model, all is und. Texts are read whole. Repeated rows have equal results, an empty table has none. Columns of docs
    that are called lang_pred, score or rejected are replaced; others may have any names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            rows = []
            for t in texts:
                c = _counts(np.frombuffer(t.encode(), dtype=np.uint8)) if m is not None and t else None
                if c is None:
                    rows.append((UNKNOWN, 0.0, True))
                    continue
                cosines = m.centroids @ _weigh(c, m.idf)
                j = int(cosines.argmax())
                score = min(1.0, max(0.0, float(cosines[j])))
                rows.append((m.langs[m.owner[j]], score, bool(score < m.floors[_length_class(int(c.sum()))])))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    letters = F.when(F.col(f"`{text}`").rlike(r"\p{L}"), lowered(F.col(f"`{text}`"))).otherwise(F.lit(""))
    (guess,) = free_names(docs, "_guess")
    names = ("lang_pred", "score", "rejected")
    return docs.withColumn(guess, nearest(letters)).select(*without(docs, *names), *[F.col(f"{guess}.{n}").alias(n) for n in names])


def remainder(ident: Column, by: int) -> Column:
    """crc32 of an identifier as text, modulo by; a null identifier counts as empty text."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % by


def op10_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those outside the held-out third."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    held = remainder(F.col("doc_id"), 3) == 1
    model = fit(docs.where(~held))
    out = predict(docs.select("doc_id", "text", held.alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")
