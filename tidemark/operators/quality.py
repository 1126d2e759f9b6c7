"""Data quality of bars, gaps between them and hourly grids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.segments import carried, neighbours, segment
from tidemark.schemas import OHLC, minutes

#: A move of more than this is extreme in the QA metrics, or a spike in the validation.
EXTREME, SPIKE, STALE_MINUTES = 0.10, 0.20, 60
#: Gaps of these lengths in minutes are weekends in the detailed validation.
WEEKEND_MINUTES = (2000, 5000)


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def move(value: str | Column, before: str | Column) -> Column:
    """Change against the value before; null if that is missing or 0."""
    c = lambda x: (F.col(x) if isinstance(x, str) else x).cast("double")
    return F.try_divide(c(value), c(before)) - 1


def pct_move(bars: DataFrame, name: str, keys: Sequence[str] = ("symbol",), price: str = "close") -> DataFrame:
    """bars with the change of price against the previous row of the series."""
    return neighbours(bars, keys, {"_before": price}).withColumn(name, move(price, "_before")).drop("_before")


def _went_back(bars: DataFrame, keys: Sequence[str], seq: str | None) -> DataFrame:
    """bars with _back: whether the time is before that of the row that arrived before; false without a column of the order of arrival."""
    if seq is None:
        return bars.withColumn("_back", F.lit(False))
    df = neighbours(bars, keys, {"_arrived": "timestamp"}, by=seq)
    return df.withColumn("_back", F.coalesce(micros("timestamp") < micros("_arrived"), F.lit(False))).drop("_arrived")


def _minutes_since(bars: DataFrame, keys: Sequence[str], name: str = "_gap") -> DataFrame:
    """bars with the minutes since the row before."""
    df = neighbours(bars, keys, {"_before": "timestamp"})
    return df.withColumn(name, (micros("timestamp") - micros("_before")) / 60_000_000).drop("_before")


def inconsistent() -> dict[str, Column]:
    """The OHLC rules that a bar can break."""
    c = F.col
    return {"high_below_low": c("high") < c("low"), "high_below_open": c("high") < c("open"), "high_below_close": c("high") < c("close"), "low_above_open": c("low") > c("open"), "low_above_close": c("low") > c("close")}


def run_bar_qa(bars: DataFrame, keys: Sequence[str] = ("symbol",), seq: str | None = None) -> DataFrame:
    """Metrics per series: share of zero volumes, broken OHLC rules, moves over 10 %, negative volumes, inversions of time.

    Inversions need the column that holds the order of arrival; without it they are 0. missing_ratio is always 0.
    """
    df = pct_move(_went_back(bars, keys, seq), "_move", keys).withColumn("_move", F.abs("_move"))
    broken = reduce(lambda a, b: a | b, inconsistent().values())
    return df.groupBy(*keys).agg(
        (F.count_if(F.col("volume") == 0) / F.count("*")).alias("zero_volume_ratio"), F.count_if(broken).alias("ohlc_inconsistencies"), F.count_if(F.col("_move") > EXTREME).alias("extreme_moves"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"), F.count_if("_back").alias("non_monotonic_ts"), F.lit(0.0).alias("missing_ratio"),
    )


def validate_ohlc(bars: DataFrame, keys: Sequence[str] = ("symbol",), strict: bool = False) -> DataFrame:
    """One report row per series: errors, warnings, row_count, start, end. strict raises on the first broken rule."""
    missing = [c for c in ("timestamp", *OHLC, "volume") if c not in bars.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing")
    c = F.col
    rules = {"high_lt_low": c("high") < c("low"), "high_lt_open_close": (c("high") < c("open")) | (c("high") < c("close")), "low_gt_open_close": (c("low") > c("open")) | (c("low") > c("close")), "negative_volume": c("volume") < 0}
    hints = {"price_spike": F.abs(move("close", "_close")) > SPIKE, "stale_data": (micros("timestamp") - micros("_before")) > STALE_MINUTES * 60_000_000}
    df = neighbours(bars, keys, {"_before": "timestamp", "_close": "close"}).withColumns({f"_{k}": v for k, v in (rules | hints).items()})
    if strict:
        df = df.where(F.when(reduce(lambda a, b: a | b, [c(f"_{k}") for k in rules]), F.raise_error(F.lit("bars break OHLC rules"))).otherwise(F.lit(True)))
    named = lambda names: F.array_compact(F.array(*[F.when(F.bool_or(f"_{k}"), F.lit(k)) for k in names]))
    return df.groupBy(*keys).agg(named(rules).alias("errors"), named(hints).alias("warnings"), F.count("*").alias("row_count"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end"))


def validate_series(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """validate_ohlc with nulls over all columns and repeated timestamps."""
    nulls = reduce(lambda a, b: a + b, [F.col(x).isNull().cast("long") for x in bars.columns])
    # counted per timestamp first, so that the distinct count needs no expansion
    stamps = bars.groupBy(*keys, "timestamp").agg(F.count("*").alias("n"), F.sum(nulls).alias("nulls"))
    more = stamps.groupBy(*keys).agg(F.sum("nulls").alias("null_count"), (F.sum("n") - F.count_if(F.col("timestamp").isNotNull())).alias("duplicate_timestamps"))
    return validate_ohlc(bars, keys).join(more, [*keys])


def validation_issues(bars: DataFrame, timeframe: str, keys: Sequence[str] = ("symbol",), seq: str | None = None) -> DataFrame:
    """Issue rows (series, severity, check, count): each rule counted by itself, those with a count only."""
    c, step = F.col, minutes(timeframe)
    df = _minutes_since(_went_back(bars, keys, seq), keys)
    df = df.withColumn("_dup", F.row_number().over(Window.partitionBy(*keys, "timestamp").orderBy("timestamp")) > 1)
    checks = {("error", k): v for k, v in inconsistent().items()} | {("error", f"negative_{x}"): c(x) < 0 for x in (*OHLC, "volume")} | {("error", f"null_{x}"): c(x).isNull() for x in (*OHLC, "volume")}
    checks |= {("error", "duplicate_timestamps"): c("_dup"), ("error", "not_sorted"): c("_back"), ("warning", "gaps"): (c("_gap") > 2 * step) & ~c("_gap").between(*WEEKEND_MINUTES)}
    counts = df.groupBy(*keys).agg(*[F.count_if(v).alias(f"{s}|{k}") for (s, k), v in checks.items()])
    long = counts.unpivot([*keys], [f"{s}|{k}" for s, k in checks], "_what", "count").where("count > 0")
    return long.select(*keys, F.split_part("_what", F.lit("|"), F.lit(1)).alias("severity"), F.split_part("_what", F.lit("|"), F.lit(2)).alias("check"), "count")


def health_report(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """All series and, with null keys, their total: bars, nulls, dups, status, first, last."""
    nulls = reduce(lambda a, b: a + b, [F.col(x).isNull().cast("long") for x in bars.columns if x not in keys])
    per = bars.groupBy(*keys, "timestamp").agg(F.count("*").alias("n"), F.sum(nulls).alias("nulls"))
    each = per.groupBy(*keys).agg(F.sum("n").alias("bars"), F.sum("nulls").alias("nulls"), F.sum(F.col("n") - 1).alias("dups"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    total = each.agg(*[F.lit(None).cast(each.schema[k].dataType).alias(k) for k in keys], F.sum("bars").alias("bars"), F.sum("nulls").alias("nulls"), F.sum("dups").alias("dups"), F.min("first").alias("first"), F.max("last").alias("last"))
    return each.unionByName(total).withColumn("status", F.when(F.col("dups") > 0, "Issues").when(F.col("nulls") > 0, "Warning").otherwise("Healthy"))


def detect_gaps(bars: DataFrame, step: float, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Neighbours further apart than step minutes: series, timestamp, next_ts."""
    df = neighbours(bars.select(*keys, "timestamp"), keys, after={"next_ts": "timestamp"})
    return df.where(micros("next_ts") - micros("timestamp") > step * 60_000_000)


def first_gaps(gaps: DataFrame, n: int = 10) -> DataFrame:
    return gaps.orderBy("timestamp", *[c for c in gaps.columns if c not in ("timestamp", "next_ts")]).limit(n)


def audit(bars: DataFrame, timeframe: str, keys: Sequence[str] = ("symbol",), examples: int = 10) -> DataFrame:
    """Per series: bars, nulls, dups, gap_count and its first gaps."""
    nulls = reduce(lambda a, b: a + b, [F.col(x).isNull().cast("long") for x in bars.columns if x not in keys])
    df = neighbours(bars.select(*keys, "timestamp", nulls.alias("_nulls")), keys, {"_before": "timestamp"}, {"next_ts": "timestamp"})
    gap = micros("next_ts") - micros("timestamp") > minutes(timeframe) * 60_000_000
    df = df.withColumns({"_gap": F.when(gap, F.struct("timestamp", "next_ts")), "_segment": segment(df, "timestamp")})
    first = lambda gaps: F.slice(F.sort_array(gaps), 1, examples)
    # by segment first, so that a series' examples are the first of its segments' first
    parts = df.groupBy(*keys, "_segment").agg(F.count("*").alias("bars"), F.sum("_nulls").alias("nulls"), F.count_if(F.col("_before") == F.col("timestamp")).alias("dups"), F.count("_gap").alias("gap_count"), F.collect_list("_gap").alias("_gaps"))
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("bars", "nulls", "dups", "gap_count")], first(F.flatten(F.collect_list(first(F.col("_gaps"))))).alias("first_gaps"))


def classify_gaps(bars: DataFrame, expected_minutes: float, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """bars with delta_s and gap: none (first row), weekend (Friday or Saturday to Sunday or Monday, two days or more), on_schedule or gap."""
    df = neighbours(bars, keys, {"_before": "timestamp"}).withColumn("delta_s", (micros("timestamp") - micros("_before")) / 1e6)
    weekend = F.weekday("timestamp").isin(6, 0) & F.weekday("_before").isin(4, 5) & (F.col("delta_s") >= 2 * 86400)
    kind = F.when(F.col("_before").isNull(), "none").when(weekend, "weekend").when(F.col("delta_s") <= expected_minutes * 60, "on_schedule").otherwise("gap")
    return df.withColumn("gap", kind).drop("_before")


def detect_internal_gaps(bars: DataFrame, timeframe: str, skip_weekends: bool = False, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Ranges of missing bars between rows over 1.1 intervals apart: gap_start, gap_end, the latter not before the former."""
    step = minutes(timeframe) * 60_000_000
    df = neighbours(bars.select(*keys, "timestamp"), keys, {"_before": "timestamp"})
    delta = micros("timestamp") - micros("_before")
    df = df.where(delta > 1.1 * step)
    if skip_weekends:
        df = df.where(~(F.weekday("_before").isin(4, 5) & F.weekday("timestamp").isin(6, 0) & delta.between(48 * 3_600_000_000, 72 * 3_600_000_000)))
    start = F.timestamp_micros(micros("_before") + step)
    return df.select(*keys, start.alias("gap_start"), F.greatest(start, F.timestamp_micros(micros("timestamp") - step)).alias("gap_end"))


def is_monotonic(bars: DataFrame, seq: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Whether each series' timestamps never go back in the order of arrival."""
    df = _went_back(bars.select(*dict.fromkeys([*keys, "timestamp", seq])), keys, seq)
    return df.groupBy(*keys).agg((~F.bool_or("_back")).alias("is_monotonic"))


def has_duplicates(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    return bars.groupBy(*keys, "timestamp").count().groupBy(*keys).agg(F.bool_or(F.col("count") > 1).alias("has_duplicates"))


def detect_gap_policy(bars: DataFrame, expected: float = 60, max_fill: float = 4320, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """gap_count, max_gap_minutes (floored, 0 without gaps), oversized gaps and whether all gaps are within max_fill."""
    df = _minutes_since(bars.select(*keys, "timestamp"), keys)
    out = df.groupBy(*keys).agg(F.count_if(F.col("_gap") > expected).alias("gap_count"), F.coalesce(F.floor(F.max(F.when(F.col("_gap") > expected, F.col("_gap")))), F.lit(0)).cast("long").alias("max_gap_minutes"), F.count_if(F.col("_gap") > max_fill).alias("oversized_gaps"))
    return out.withColumn("within_limit", F.col("oversized_gaps") == 0)


def normalize_hourly(bars: DataFrame, max_fill: float = 4320, keys: Sequence[str] = ("symbol",)) -> tuple[DataFrame, DataFrame]:
    """(hourly bars, rejected series with a reason).

    Series with repeated timestamps or a gap over max_fill minutes are rejected. The others get every hour between
    their first and last; hours without a bar repeat the last close, with volume 0 and is_synthetic_bar. Rows off the
    hour drop out.
    """
    gaps = _minutes_since(bars.select(*keys, "timestamp"), keys)
    seen = gaps.groupBy(*keys).agg(F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"), F.bool_or(F.col("_gap") == 0).alias("_dup"), F.bool_or(F.col("_gap") > max_fill).alias("_wide"))
    seen = seen.withColumn("reason", F.when(F.col("_dup"), "duplicate timestamps").when(F.col("_wide"), "gap over the limit"))
    hour = 3600
    ends = [F.floor(F.unix_seconds(F.col("_first").cast("timestamp")) / hour) * hour, F.ceil(micros("_last") / (hour * 1_000_000)) * hour]
    grid = seen.where("reason is null").select(*keys, F.explode(F.sequence(*ends, F.lit(hour).cast("long"))).alias("_s")).select(*keys, F.timestamp_seconds("_s").alias("timestamp"))
    own = bars.select(*keys, F.col("timestamp").cast("timestamp").alias("timestamp"), *OHLC, "volume")
    df = grid.join(own, [*keys, "timestamp"], "left").withColumn("is_synthetic_bar", F.col("close").isNull())
    df = carried(df, keys, "close", "_close")
    filled = df.select(*keys, "timestamp", *[F.when(F.col("is_synthetic_bar"), F.col("_close")).otherwise(F.col(c)).alias(c) for c in OHLC], F.coalesce("volume", F.lit(0)).alias("volume"), "is_synthetic_bar")
    return filled, seen.where("reason is not null").select(*keys, "reason")


def filter_day(bars: DataFrame, day: str) -> DataFrame:
    """The UTC day [day, day + 1)."""
    return bars.where((F.col("timestamp") >= F.lit(day).cast("timestamp")) & (F.col("timestamp") < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp")))


def last_n(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """The n rows of each series that are last by order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))).where(F.col("_rank") <= n).drop("_rank")


def dedup_bars(existing: DataFrame, fetched: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Both together, one row per series and timestamp: a fetched row replaces an existing one."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(fetched.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "timestamp").orderBy(F.col("_new").desc(), *[F.col(c).desc() for c in OHLC])
    return both.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_new")


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of per-series results (status, rows, gaps)."""
    return results.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"))
