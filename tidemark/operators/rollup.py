"""Bars of coarser timeframes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import BARS, OHLC, minutes

#: Timeframes of the epoch-aligned roll-up.
ALIGNED = ("5m", "15m", "30m", "1h", "1d")


def to_bars(df: DataFrame) -> DataFrame:
    """The six bar columns in their declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BARS])


def to_utc(df: DataFrame) -> DataFrame:
    """timestamp as an instant; a time without zone is taken as UTC."""
    if "timestamp" not in df.columns:
        raise ValueError("a timestamp column is required")
    kind = dict(df.dtypes)["timestamp"]
    if kind == "timestamp":
        return df
    return df.withColumn("timestamp", F.to_timestamp_ltz(F.concat(F.date_format(F.col("timestamp").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00"))))


def with_metadata(df: DataFrame, symbol: str, provider: str, asset_class: str) -> DataFrame:
    return df.withColumns({"symbol": F.lit(symbol), "provider": F.lit(provider), "asset_class": F.lit(asset_class)})


def day_bucket(ts: Column, step: int) -> Column:
    """Start of the step-minute bucket that restarts at midnight."""
    day = F.date_trunc("day", ts)
    minute = F.floor((F.unix_seconds(ts.cast("timestamp")) - F.unix_seconds(day)) / 60)
    return F.timestamp_seconds(F.unix_seconds(day) + F.floor(minute / step) * step * 60)


def aggregate_bars(bars: DataFrame, timeframe: str, keys: Sequence[str] = ("symbol",), allow_multiday: bool = False) -> DataFrame:
    """Day-anchored OHLCV roll-up: first open, highest, lowest, last close, summed volume, one row per series and bucket.

    One minute is passed through. Frames of more than a day are rejected unless allow_multiday, which counts whole
    multiples of them from the epoch. Partial aggregates run before the only shuffle, on (series, bucket).
    """
    step = minutes(timeframe)
    if step <= 1:
        return bars
    if step > 1440 and not allow_multiday:
        raise ValueError(f"{timeframe} is longer than a day")
    ts = F.col("timestamp")
    bucket = day_bucket(ts, step) if step <= 1440 else F.timestamp_seconds(F.floor(F.unix_seconds(ts.cast("timestamp")) / (step * 60)) * step * 60)
    return _ohlcv(bars, [*keys], bucket)


def _ohlcv(bars: DataFrame, keys: list[str], bucket: Column, *more: Column) -> DataFrame:
    out = bars.groupBy(*keys, bucket.alias("bucket")).agg(
        F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "timestamp").alias("close"), F.sum("volume").alias("volume"), *more
    )
    return out.withColumnRenamed("bucket", "timestamp")


def aggregate_bars_by_symbol(bars: DataFrame, timeframe: str) -> DataFrame:
    """Epoch-aligned roll-up of many symbols, left-closed and left-labelled; keeps each bucket's first instrument_id."""
    if timeframe not in ALIGNED:
        raise ValueError(f"{timeframe} is not one of {ALIGNED}")
    step = minutes(timeframe) * 60
    bucket = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / step) * step)
    more = [F.min_by("instrument_id", "timestamp").alias("instrument_id")] if "instrument_id" in bars.columns else []
    return _ohlcv(bars, ["symbol"], bucket, *more)


def splice_history(cached: DataFrame, rebuilt: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Cached rows older than the rebuilt span of their series, and the rebuilt rows; missing columns are null."""
    spans = rebuilt.groupBy(*keys).agg(F.min("timestamp").alias("_from"))
    older = cached.join(spans, [*keys], "left").where(F.col("_from").isNull() | (F.col("timestamp") < F.col("_from"))).drop("_from")
    return older.unionByName(rebuilt, allowMissingColumns=True)


def load_or_rollup(base: DataFrame, cached: DataFrame, timeframe: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """The coarse series: cached rows where the base has nothing newer, rebuilt ones spliced in where it has.

    Only series whose base ends after their cached last bar are rolled up again; full spans only.
    """
    rebuilt = aggregate_bars(base.join(stale_series(base, cached, timeframe, keys), [*keys], "left_semi"), timeframe, keys)
    return splice_history(cached, rebuilt.select(*keys, "timestamp", *OHLC, "volume"), keys)


def stale_series(base: DataFrame, cached: DataFrame, timeframe: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Series whose base ends a bucket or more behind their cached last bar, or of which nothing is cached."""
    step = minutes(timeframe)
    newest = base.groupBy(*keys).agg(F.max("timestamp").alias("base_end"))
    have = cached.groupBy(*keys).agg(F.max("timestamp").alias("cached_end"))
    stale = newest.join(have, [*keys], "left").where(F.col("cached_end").isNull() | (F.col("base_end") >= F.col("cached_end") + F.make_interval(mins=F.lit(step))))
    return stale.select(*keys)
