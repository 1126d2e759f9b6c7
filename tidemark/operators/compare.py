"""Two sources of one series, and statistics of bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import OHLC

VALUES = [*OHLC, "volume"]


def align_sources(first: DataFrame, second: DataFrame, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Rows of both at the same time, with *_1, *_2 and *_diff. strict raises if there are none."""
    on = [*keys, "timestamp"]
    a, b = (df.select(*on, *[F.col(c).alias(f"{c}_{i}") for c in VALUES]) for i, df in ((1, first), (2, second)))
    out = a.join(b, on).withColumns({f"{c}_diff": F.col(f"{c}_1").cast("double") - F.col(f"{c}_2").cast("double") for c in VALUES})
    if strict and out.isEmpty():
        raise ValueError("the sources have no time in common")
    return out


def compare_stats(aligned: DataFrame) -> DataFrame:
    """Per column: mean_diff, max_abs_diff, std_diff, correlation, and the number of matched rows."""
    parts = [F.struct(F.lit(c).alias("column"), F.avg(f"{c}_diff").alias("mean_diff"), F.max(F.abs(f"{c}_diff")).alias("max_abs_diff"), F.stddev_samp(f"{c}_diff").alias("std_diff"), F.corr(F.col(f"{c}_1").cast("double"), F.col(f"{c}_2").cast("double")).alias("correlation"), F.count("*").alias("matched")) for c in VALUES]
    return aligned.agg(F.array(*parts).alias("s")).select(F.inline("s"))


def export_comparison(aligned: DataFrame, path: str, fmt: str) -> None:
    """Aligned rows as CSV, or the statistics as JSON."""
    if fmt == "csv":
        aligned.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "json":
        compare_stats(aligned).write.mode("overwrite").json(path)
    else:
        raise ValueError(f"csv or json, not {fmt}")


def stats(bars: DataFrame, keys: Sequence[str] = ("symbol",), columns: Sequence[str] = VALUES) -> DataFrame:
    """mean, min, max, std, count and nulls of each numeric column. Sums of decimals and integers are exact, so that their means do not depend on the order of rows."""
    return _moments(bars, [*keys], columns)


def _moments(bars: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    kinds = dict(bars.dtypes)

    def mean(c: str) -> Column:
        exact = kinds[c].startswith("decimal") or kinds[c] in ("tinyint", "smallint", "int", "bigint")
        return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)) if exact else F.avg(c)

    double = lambda f, c: f(F.col(c).cast("double"))
    parts = [F.struct(F.lit(c).alias("column"), mean(c).alias("mean"), double(F.min, c).alias("min"), double(F.max, c).alias("max"), double(F.stddev_samp, c).alias("std"), F.count(c).alias("count"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in columns]
    return bars.groupBy(*keys).agg(F.array(*parts).alias("_s")).select(*keys, F.inline("_s"))


def info(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per series: rows, columns, first, last, OHLC ranges, total volume."""
    ranges = [f(c).alias(f"{name}_{c}") for c in OHLC for name, f in (("min", F.min), ("max", F.max))]
    return bars.groupBy(*keys).agg(F.count("*").alias("rows"), F.lit(len(bars.columns)).alias("columns"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), *ranges, F.sum("volume").alias("total_volume"))


def yearly_breakdown(bars: DataFrame, keys: Sequence[str] = ("symbol",), columns: Sequence[str] = VALUES) -> DataFrame:
    """Per series, year and column: bars, their share of the series in per cent, and the column's mean, min, max, std and nulls.

    The total is taken over the yearly rows, of which a series has few.
    """
    years = _moments(bars.withColumn("year", F.year("timestamp")), [*keys, "year"], columns)
    years = years.withColumn("bars", F.col("count") + F.col("nulls")).drop("count")
    return years.withColumn("percent", F.col("bars") * 100.0 / F.sum("bars").over(Window.partitionBy(*keys, "column")))


def validate_aggregate(local: DataFrame, venue: DataFrame, tolerance: float = 1e-5, keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Local daily bars against a venue's: offenders per day.

    A price offends if it is further than tolerance times the mean absolute close of both from the other (1 if that is
    0); volumes must be equal; a day that one side lacks offends as missing_local or missing_venue.
    """
    a, b = (df.select(*keys, F.lit(True).alias(f"_{i}"), *[F.col(c).cast("double").alias(f"{c}_{i}") for c in VALUES]) for i, df in ((1, local), (2, venue)))
    both = a.join(b, [*keys], "full_outer")
    middle = (F.abs("close_1") + F.abs("close_2")) / 2
    scale = F.when(middle == 0, F.lit(1.0)).otherwise(middle)
    off = [F.when(F.col("_1").isNull(), "missing_local"), F.when(F.col("_2").isNull(), "missing_venue")]
    off += [F.when(F.abs(F.col(f"{c}_1") - F.col(f"{c}_2")) > tolerance * scale, c) for c in OHLC] + [F.when(F.col("volume_1") != F.col("volume_2"), "volume")]
    return both.select(*keys, F.array_compact(F.array(*off)).alias("offenders")).withColumn("passed", F.size("offenders") == 0)
