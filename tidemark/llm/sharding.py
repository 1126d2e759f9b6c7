"""Sharding by sampled splitters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, materialise, packed, unpacked

SHARDS = 24
#: Fine ranges per shard, at least, and expected samples per fine range.
FINE, SAMPLES = 32, 16
#: Bytes of a range from which there are more of them, and how many there are at most; the driver holds SAMPLES keys of each.
RANGE_BYTES, MOST_RANGES = 256 << 20, 1 << 16
#: Texts that occur often are kept together up to this share of a shard's bytes.
GROUP_SHARE = 0.01
_LOWEST = -(2**63)


def _range_of(cuts: list[tuple[int, int, int]]):
    """A function of (group hash, order, row hash) columns: the number of cuts at or below the key."""
    columns = [np.array([c[i] for c in cuts], dtype=np.int64) for i in range(3)]

    @F.pandas_udf("int")
    def lookup(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for keys in batches:
            g, o, u = (np.concatenate((c, k.to_numpy(np.int64))) for c, k in zip(columns, keys, strict=True))
            is_row = np.arange(len(g)) >= len(columns[0])
            order = np.lexsort((is_row, u, o, g))  # a cut comes before the rows that equal it
            passed = np.empty(len(g), dtype=np.int32)
            passed[order] = np.cumsum(~is_row[order])
            yield pd.Series(passed[is_row])

    return lookup


def _cuts(sample: list[tuple[int, int, int, int]], every: float) -> list[tuple[int, int, int]]:
    """Quantiles of a sample of (group, order, row, weight): one cut for each multiple of every.

    A cut is moved to the start of its group, unless a neighbour falls into the same group, which is overfull; then to the
    start of its order, unless a neighbour falls into that too.
    """
    keys, passed, due = [], 0, every
    for g, o, u, weight in sorted(sample):
        passed += weight
        if passed >= due:
            keys.append((g, o, u))
            due = (passed // every + 1) * every
    pairs = list(zip(keys, keys[1:], strict=False))
    groups, orders = {a[0] for a, b in pairs if a[0] == b[0]}, {a[:2] for a, b in pairs if a[:2] == b[:2]}
    return sorted({(g, o, u) if (g, o) in orders else (g, o, _LOWEST) if g in groups else (g, _LOWEST, _LOWEST) for g, o, u in keys})


def shard(docs: DataFrame, size: Column, group: Column, order: Column, shards: int = SHARDS, fine: int = FINE, samples: int = SAMPLES, group_share: float = GROUP_SHARE) -> DataFrame:
    """docs with columns shard (from 0) and slot (gapless from 0 in each shard), sizes of shards near equal.

    Keys are (hash of group, order, hash of the row's place in the input). A size-weighted sample of keys, of samples
    per range, gives the quantiles that split the key space into ranges: shards * fine, more if they would exceed
    RANGE_BYTES, up to MOST_RANGES; ranges found to be overfull are sampled again and subdivided. Exact sums per range then
    place each row: rows are range-partitioned, and a prefix sum inside the range says which shard a row's middle byte
    falls into. Rows with equal group values share a shard while they have at most group_share of its bytes; larger
    groups are divided.

    Nulls are values like any other (order: lowest). Repeated rows and other ties are all kept and told apart by their
    places, so that one that is repeated very often fills several ranges and no task gathers it. Long texts count by their
    size. An empty input gives an empty result. Sizes must not be negative; if all are 0, rows fill the first shard.
    Columns of docs that are called shard or slot are replaced; others may have any names.
    """
    keyed = docs.select(packed(docs), F.xxhash64(group).alias("_g"), F.coalesce(order.cast("long"), F.lit(_LOWEST)).alias("_o"), F.xxhash64(F.monotonically_increasing_id()).alias("_u"), size.cast("long").alias("_size"))
    keyed = materialise(keyed, "shard-rows")
    narrow = keyed.select("_g", "_o", "_u", "_size")
    rows, total = narrow.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    ranges = max(shards * fine, min(MOST_RANGES, -(-total // RANGE_BYTES)))
    wanted = ranges * samples
    even = F.pmod(F.xxhash64("_g", "_o", "_u", F.lit(17)), F.lit(2**30)) / 2**30

    def draw(df: DataFrame, rate: float) -> list[tuple[int, int, int, int]]:
        """Each row floor(size * rate) times and once more with the probability that remains, which its own hash decides."""
        points = F.col("_size") * F.lit(rate)
        return [tuple(r) for r in df.select("_g", "_o", "_u", (F.floor(points) + (even < points - F.floor(points)).cast("long")).alias("n")).where("n > 0").collect()]

    cuts = _cuts(draw(narrow, wanted / total), samples) if total else []
    for k in range(3):  # overfull ranges are subdivided
        placed = narrow.withColumn("_range", _range_of(cuts)("_g", "_o", "_u"))
        sums = {r[0]: (r[1], r[2]) for r in placed.groupBy("_range").agg(F.count("*"), F.sum("_size")).collect()}
        over = [i for i, (n, b) in sums.items() if n > 1 and b > 3 * total / ranges]
        if not over or k == 2:
            break
        more = _cuts(draw(placed.where(F.col("_range").isin(over)), 2 * wanted / total), samples)
        if set(more) <= set(cuts):
            break
        cuts = sorted({*cuts, *more})

    rows_before, bytes_before, n, b = [], [], 0, 0
    for i in range(len(cuts) + 1):
        rows_before.append(n)
        bytes_before.append(b)
        n, b = n + sums.get(i, (0, 0))[0], b + sums.get(i, (0, 0))[1]
    at = lambda values: F.element_at(F.lit(values), F.col("_range") + 1).cast("long")

    def assigned(df: DataFrame) -> DataFrame:
        by_range = Window.partitionBy("_range").orderBy("_g", "_o", "_u")
        by_group = Window.partitionBy("_range", "_g")
        df = df.withColumn("_range", _range_of(cuts)("_g", "_o", "_u"))
        df = df.withColumns({"_row": F.row_number().over(by_range), "_end": F.sum("_size").over(by_range.rowsBetween(Window.unboundedPreceding, 0))})
        df = df.withColumns({"_group_size": F.sum("_size").over(by_group), "_group_end": F.max("_end").over(by_group)})
        together = F.col("_group_size") <= F.lit(total / shards * group_share)
        middle = at(bytes_before) + F.when(together, F.col("_group_end") - F.col("_group_size") / 2).otherwise(F.col("_end") - F.col("_size") / 2)
        return df.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards / max(total, 1))).cast("int")))

    firsts, n = [], 0
    counts = dict(tuple(r) for r in assigned(narrow).groupBy("shard").count().collect())
    for i in range(shards):
        firsts.append(n)
        n += counts.get(i, 0)
    done = assigned(keyed).withColumn("slot", at(rows_before) + F.col("_row") - 1 - F.element_at(F.lit(firsts), F.col("shard") + 1))
    return done.select("row", "shard", "slot").select(*unpacked(docs, "shard", "slot"))


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes. A null text has no text_crc32."""
    d = documents(spark, sf_dir, "doc_id", "text")
    d = d.select("doc_id", byte_size(d.text).alias("size"), F.crc32(d.text.cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("text_hash"))
    out = shard(d, F.col("size"), F.col("text_hash"), F.col("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
