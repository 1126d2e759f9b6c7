"""Hard negatives by a BOND scan: columnar vectors, dimensions in the order of each anchor's magnitudes, shrinking candidates."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, release

#: Values of a columnar block (8 MB as doubles), and the least rows of one; a table is cut into about SPREAD blocks before they get that large.
BLOCK_VALUES, BLOCK_ROWS, SPREAD = 1 << 20, 512, 64
#: The blocks are written to at most so many files, which later tasks share out among them.
FILES = 4096
#: Values of the anchors that are broadcast at once (32 MB as doubles); more anchors take further passes over the blocks.
ANCHOR_VALUES = 1 << 22
#: Dimensions that are read between two looks at the bounds.
STEP = 8
#: Fixed values of the contract: the scale of a component, positives, negatives, and the window of negative scores in percent of the positive's.
SCALE, POSITIVES, NEGATIVES, WINDOW = 256, 5, 10, (30, 90)


class Block:
    """Some rows as columns: ids, labels (ascending) and columns, of which columns[j] has dimension j of all rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.least, self.most = (columns.min(axis=1), columns.max(axis=1)) if columns.size else (np.zeros(len(columns)), np.zeros(len(columns)))

    def of_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right")))


def _numbers(anchor: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, columns and their extremes as doubles while sums of products are exact in them, else as Python's integers."""
    d = min(len(anchor), len(block.columns))
    a, c, least, most = anchor[:d], block.columns[:d], block.least[:d], block.most[:d]
    top = max(abs(float(least.min())), abs(float(most.max())), 1.0) if d else 1.0
    if float(np.abs(a).sum()) * top < 2.0**52:
        return a, c, least, most
    whole = np.frompyfunc(int, 1, 1)
    return tuple(whole(x).astype(object) for x in (a, c, least, most))


def vertical_scan(block: Block, anchor: np.ndarray, alive: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of alive that keep never ruled out, and their exact scores.

    Dimensions are read in the order of the anchor's descending magnitudes; those where it is 0 are not read. What the
    unread ones can still add lies between the sums of their least and greatest products in the block. After each STEP
    keep gets the bounds of the rows that are left and says which stay.
    """
    a, columns, least, most = _numbers(anchor, block)
    order = np.argsort(-np.abs(a).astype(float), kind="stable")
    order = order[: int(np.count_nonzero(a))]
    one, two = a[order] * least[order], a[order] * most[order]
    rest = lambda x: np.concatenate((np.cumsum(x[::-1])[::-1], [0])).astype(columns.dtype)
    low, high = rest(np.minimum(one, two)), rest(np.maximum(one, two))
    whole = len(alive) == len(block.ids)
    score = np.zeros(len(alive), dtype=columns.dtype)
    for k in range(0, len(order), STEP):
        js = order[k : k + STEP]
        score = score + a[js] @ (columns[js] if whole else columns[js[:, None], alive])
        k = min(k + STEP, len(order))
        if k < len(order):
            stay = keep(score + low[k], score + high[k])
            if not stay.all():
                alive, score, whole = alive[stay], score[stay], False
                if not len(alive):
                    break
    return alive, score


def _first(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n highest scores with their ids; ties by smaller id."""
    order = np.lexsort((ids, -scores)) if scores.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), dtype=int)
    return scores[order[:n]], ids[order[:n]]


def _nth(scores: np.ndarray, n: int):
    """The n-th highest score, or None."""
    if len(scores) < n:
        return None
    return np.sort(scores)[-n] if scores.dtype == object else np.partition(scores, len(scores) - n)[len(scores) - n]


class Best:
    """The n best (score, id) of what has been seen so far."""

    def __init__(self, n: int):
        self.n, self.scores, self.ids = n, np.zeros(0), np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        self.scores, self.ids = _first(np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids)), self.n)

    def floor(self):
        """A score below this is not among the best; None while there are too few."""
        return self.scores[-1] if len(self.scores) == self.n else None


def nearest_of_label(block: Block, anchor_id: int, label: int, anchor: np.ndarray, best: Best) -> None:
    """Add to best the rows of the anchor's label, but itself, that can be among its best."""
    own = block.of_label(label)
    alive = np.arange(own.start, own.stop)
    alive = alive[block.ids[alive] != anchor_id]
    if not len(alive):
        return
    known = best.floor()

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least = [x for x in (known, _nth(low, best.n)) if x is not None]
        return high >= max(least) if least else np.ones(len(low), dtype=bool)

    alive, scores = vertical_scan(block, anchor, alive, keep)
    best.add(scores, block.ids[alive])


def windowed(block: Block, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], best: list[Best]) -> None:
    """Add to best, one of each window [lo, hi] of scores, the rows of other labels that lie in it and can be among its best."""
    own = block.of_label(label)
    alive = np.concatenate((np.arange(own.start), np.arange(own.stop, len(block.ids))))
    asked = [(lo, hi, b, b.floor()) for (lo, hi), b in zip(windows, best, strict=True) if lo <= hi]
    if not len(alive) or not asked:
        return

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), dtype=bool)
        for lo, hi, b, known in asked:
            sure = _nth(low[(low >= lo) & (high <= hi)], b.n)  # so many rows lie in the window whatever is unread
            stay |= (high >= max(x for x in (lo, known, sure) if x is not None)) & (low <= hi)
        return stay

    alive, scores = vertical_scan(block, anchor, alive, keep)
    for lo, hi, b, _ in asked:
        inside = np.asarray((scores >= lo) & (scores <= hi), dtype=bool)
        if inside.any():
            b.add(scores[inside], block.ids[alive[inside]])


def score_window(positive: int, window: tuple[int, int]) -> tuple[int, int]:
    """The scores s with window[0] * positive <= 100 s <= window[1] * positive, as the least and the greatest integer."""
    return -((-window[0] * positive) // 100), (window[1] * positive) // 100


def _long(x) -> int:
    return max(-(2**63), min(2**63 - 1, int(x)))


def columnar(rows: DataFrame) -> DataFrame:
    """rows(id, label, q) in blocks: ids, labels and columns (dimension after dimension, doubles), dims; short vectors are filled with 0."""
    n, dims = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    size = max(1, min(BLOCK_VALUES // max(1, dims or 1), max(BLOCK_ROWS, -(-n // SPREAD))))
    blocks = max(1, -(-n // size))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["label", "id"])
        d = max(map(len, pdf["q"]))
        columns = np.zeros((d, len(pdf)))
        for i, v in enumerate(pdf["q"]):
            columns[: len(v), i] = v
        return pd.DataFrame({"ids": [pdf["id"].to_numpy(np.int64).tobytes()], "labels": [pdf["label"].to_numpy(np.int64).tobytes()], "dims": [d], "columns": [columns.tobytes()]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).repartition(min(blocks, FILES), "block")
    return dealt.groupBy("block").applyInPandas(build, "ids binary, labels binary, dims int, columns binary")


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[Block]:
    for batch in batches:
        for ids, labels, dims, columns in batch.itertuples(index=False):
            ids = np.frombuffer(ids, dtype=np.int64)
            yield Block(ids, np.frombuffer(labels, dtype=np.int64), np.frombuffer(columns).reshape(dims, len(ids)))


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as doubles; null for a null vector and for one with a null or non-finite component.

    Doubles from 2**52 on are whole already, and a long could not hold them all.
    """
    usable = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    scaled = F.transform(vector, lambda v: v.cast("double") * scale)
    return F.when(usable, F.transform(scaled, lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v)))


def _best_positives(spark: SparkSession, blocks: DataFrame, asked: list[tuple[int, int, np.ndarray]], n: int) -> DataFrame:
    """anchor_id, place (from 1), positive_id, score."""
    shared = spark.sparkContext.broadcast(asked)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(n) for _ in shared.value]
        for block in _blocks(batches):
            for (ident, label, anchor), b in zip(shared.value, best, strict=True):
                nearest_of_label(block, ident, label, anchor, b)
        rows = [(a[0], int(i), _long(s)) for a, b in zip(shared.value, best, strict=True) for s, i in zip(b.scores, b.ids, strict=True)]
        yield pd.DataFrame(rows, columns=["anchor_id", "positive_id", "score"], dtype="int64")

    rows = blocks.mapInPandas(scan, "anchor_id long, positive_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "positive_id"))
    return rows.withColumn("place", place).where(F.col("place") <= n).select("anchor_id", "place", "positive_id", "score")


def _best_negatives(spark: SparkSession, blocks: DataFrame, asked: list[tuple[int, int, np.ndarray, list[tuple[int, int]]]], n: int) -> DataFrame:
    """anchor_id, place (of the window), rank, negative_id, negative_score."""
    shared = spark.sparkContext.broadcast(asked)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [[Best(n) for _ in a[3]] for a in shared.value]
        for block in _blocks(batches):
            for (_, label, anchor, windows), b in zip(shared.value, best, strict=True):
                windowed(block, label, anchor, windows, b)
        rows = [(a[0], k, int(i), _long(s)) for a, each in zip(shared.value, best, strict=True) for k, b in enumerate(each, 1) for s, i in zip(b.scores, b.ids, strict=True)]
        yield pd.DataFrame(rows, columns=["anchor_id", "place", "negative_id", "negative_score"], dtype="int64")

    rows = blocks.mapInPandas(scan, "anchor_id long, place int, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= n)


def mine(rows: DataFrame, ident: str = "vec_id", label: str = "label", vector: str = "embedding", anchors: Column | None = None, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: each anchor's hard negatives.

    The score of two rows is the inner product of their quantised vectors. An anchor's positives are the other rows of its
    label with the highest scores; a positive's negatives are the rows of other labels with the highest scores within
    window, in percent of the positive's score. Ties go to the smaller identifier. anchors: which rows are anchors; default all.

    All rows lie in columnar blocks in the shared scratch folder. Anchors are broadcast in parts of about ANCHOR_VALUES
    values; each part scans all blocks twice, for positives and then for the windows that these set, and a task carries its
    best rows from block to block, so that they bound later blocks. No row is left out but by its bounds.

    Rows with a null identifier, label or vector, or with a null or non-finite component, take no part. Of rows with one
    identifier the one with the least label and vector counts, so repeated rows change nothing. A vector that is shorter
    than another counts as filled with 0. Scores that doubles can't hold exactly are added up as Python's integers; one beyond
    a long, from components beyond about a million, ends at its limits, and so does its window. An empty table, an anchor without other rows of its label and a window without rows give no
    rows. Only the three columns are read, so others may have any names.
    """
    spark = rows.sparkSession
    named = rows.select(F.col(f"`{ident}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), quantised(F.col(f"`{vector}`"), scale).alias("q"), F.lit(True).alias("anchor") if anchors is None else anchors.alias("anchor"))
    named = named.where("id is not null and label is not null and q is not null").groupBy("id").agg(F.min(F.struct("label", "q", "anchor")).alias("r"))
    named = materialise(named.select("id", "r.*"), "bond-rows")
    blocks = materialise(columnar(named.select("id", "label", "q")), "bond-blocks")
    asked = named.where("anchor").select("id", "label", "q")
    parts = -(-(asked.agg(F.sum(F.size("q") + 1)).first()[0] or 0) // ANCHOR_VALUES)
    found = []
    for part in range(parts):
        own = [(r.id, r.label, np.array(r.q)) for r in asked.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(parts)) == part).orderBy("id").collect()]
        best = materialise(_best_positives(spark, blocks, own, positives), "bond-positives")
        windows: dict[int, list[tuple[int, int]]] = {}
        for r in best.orderBy("anchor_id", "place").collect():
            windows.setdefault(r.anchor_id, []).append(score_window(r.score, window))
        hard = _best_negatives(spark, blocks, [(*a, windows[a[0]]) for a in own if a[0] in windows], negatives)
        pairs = hard.join(best.withColumnRenamed("score", "positive_score"), ["anchor_id", "place"])
        found.append(materialise(pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "bond-found"))
        release(best)
    release(named, blocks)
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, found)


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth embedding; the labels of every seventh are moved on by one first."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", moved.alias("label"), "embedding"), anchors=F.col("vec_id") % 100 == 0)


OP11_SQL = """
with v as (select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.id as anchor_id, b.id, a.label = b.label as same, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::bigint as score from v a join v b on a.id <> b.id where a.id % 100 = 0),
p as (select anchor_id, id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank, id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 10
"""
