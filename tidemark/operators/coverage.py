"""Half-open [start, end) coverage of series, and what it lacks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.segments import carried, reach, stacked
from tidemark.schemas import minutes

KEYS = ("symbol",)


def merge_ranges(cov: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Overlapping or touching ranges as one: the latest fetched_at, and batch_job_id if all have the same.

    A range that begins beyond all ends before it begins an island, whose start is carried on to its other ranges. Ranges
    are ordered within a series' month of their start; how far earlier months reach, and the island that they end in, comes
    from a row per month, so that no task has a whole series. A range's end must not be before its start.
    """
    df = reach(cov, keys, "start_ts", "end_ts", "_before", "end_ts")
    df = df.withColumn("_head", F.when(F.coalesce(F.col("start_ts") > F.col("_before"), F.lit(True)), F.col("start_ts"))).drop("_before")
    df = carried(df, keys, "_head", "_island", "start_ts")
    aggs = [F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts")]
    if "fetched_at" in cov.columns:
        aggs.append(F.max("fetched_at").alias("fetched_at"))
    if "batch_job_id" in cov.columns:
        same = (F.count("batch_job_id") == F.count("*")) & (F.min("batch_job_id") == F.max("batch_job_id"))
        aggs.append(F.when(same, F.min("batch_job_id")).alias("batch_job_id"))
    return df.groupBy(*keys, "_island").agg(*aggs).drop("_island")


def coverage_gaps(cov: DataFrame, start: str, end: str, keys: Sequence[str] = KEYS, series: DataFrame | None = None) -> DataFrame:
    """The parts of [start, end) that no range of a series covers: series, gap_start, gap_end.

    series are those to look at, each once; default those with coverage. Ranges need not be merged. A range of no length at the end closes the last gap.
    """
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    if not start < end:
        raise ValueError("the window is empty")
    inside = cov.where((F.col("end_ts") > lo) & (F.col("start_ts") < hi)).select(*keys, F.greatest("start_ts", lo).alias("s"), F.least("end_ts", hi).alias("e"))
    ends = (cov.select(*keys).distinct() if series is None else series).select(*keys, hi.alias("s"), hi.alias("e"))
    df = reach(stacked(inside, ends), keys, "s", "e", "gap_start", "e").withColumn("gap_start", F.coalesce("gap_start", lo))
    return df.where(F.col("s") > F.col("gap_start")).select(*keys, "gap_start", F.col("s").alias("gap_end"))


def per_symbol_gaps(symbols: DataFrame, cov: DataFrame, start: str, end: str) -> DataFrame:
    """coverage_gaps of the given symbols; a symbol without coverage lacks the whole window."""
    asked = symbols.select("symbol").distinct()
    return coverage_gaps(cov.join(asked, "symbol", "left_semi"), start, end, series=asked)


def edge_gaps(ranges: DataFrame, start: str, end: str, timeframe: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Date ranges missing before the first and after the last stored date of each series (first_date, last_date; null: nothing stored).

    The gap after begins max(1, days of the timeframe) days behind the last date.
    """
    lo, hi, step = F.lit(start).cast("date"), F.lit(end).cast("date"), max(1, minutes(timeframe) // 1440)
    one = lambda a, b, ok: F.when(ok & (a <= b), F.struct(a.alias("gap_start"), b.alias("gap_end")))
    first, last = F.col("first_date"), F.col("last_date")
    gaps = F.array(one(lo, hi, first.isNull()), one(lo, F.least(F.date_sub(first, 1), hi), first > lo), one(F.greatest(F.date_add(last, step), lo), hi, last < hi))
    return ranges.select(*keys, F.inline(F.array_compact(gaps)))


def coverage_summary(symbols: DataFrame, gaps: DataFrame, start: str, end: str) -> DataFrame:
    """n_total, n_covered, n_partial, n_missing (one gap as long as the window) and the gaps' symbol-days, rounded."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    each = gaps.groupBy("symbol").agg(F.count("*").alias("n"), F.bool_or((F.col("gap_start") == lo) & (F.col("gap_end") == hi)).alias("whole"), F.sum(F.unix_seconds("gap_end") - F.unix_seconds("gap_start")).alias("s"))
    df = symbols.distinct().join(each, "symbol", "left")
    missing = (F.col("n") == 1) & F.col("whole")
    return df.agg(F.count("*").alias("n_total"), F.count_if(F.col("n").isNull()).alias("n_covered"), F.count_if(F.col("n").isNotNull() & ~missing).alias("n_partial"), F.count_if(missing).alias("n_missing"), F.round(F.coalesce(F.sum("s"), F.lit(0)) / 86400, 2).alias("gap_symbol_days"))


def gap_pattern_members(symbols: DataFrame, gaps: DataFrame) -> DataFrame:
    """symbol, gaps (an array, empty without any) and pattern, a SHA-256 of the gaps in microseconds."""
    each = gaps.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("gap_start", "gap_end"))).alias("gaps"))
    df = symbols.distinct().join(each, "symbol", "left").withColumn("gaps", F.coalesce("gaps", F.array().cast("array<struct<gap_start:timestamp,gap_end:timestamp>>")))
    listed = F.array_join(F.transform("gaps", lambda g: F.concat_ws("-", F.unix_micros(g["gap_start"]).cast("string"), F.unix_micros(g["gap_end"]).cast("string"))), ",")
    return df.withColumn("pattern", F.sha2(listed.cast("binary"), 256))


def group_by_gap_pattern(symbols: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row per set of gaps: pattern, gaps, n_symbols and the first symbol; gap_pattern_members() has all symbols, a row each."""
    return gap_pattern_members(symbols, gaps).groupBy("pattern").agg(F.first("gaps").alias("gaps"), F.count("*").alias("n_symbols"), F.min("symbol").alias("first_symbol"))


def coverage_observation(bars: DataFrame, start: str, end: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """What timestamps alone say, no prices: rows, unique, duplicates, outside the window, first, last and a SHA-256 of them.

    The digest is that of a series' timestamps in order, a line each, repeated ones too. The rows of a series, sorted by
    Spark, run through one digest, so that a worker holds a batch and a state of fixed size, whatever the series' length. A
    digest has an order, so a series is one task; different series are independent. A row without a time has no line.
    """
    stamp = F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    per = bars.groupBy(*keys, F.unix_micros(F.col("timestamp").cast("timestamp")).alias("_us"), stamp.alias("_stamp")).agg(F.count("*").alias("_n"))
    lo, hi = (per.sparkSession.range(1).select(F.unix_micros(F.lit(x).cast("timestamp"))).first()[0] for x in (start, end))
    ordered = per.repartition(*keys).sortWithinPartitions(*keys, "_us")
    n_keys = len(keys)

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None  # the series, its digest, and rows, unique, outside, first, last
        done: list[tuple] = []

        def close() -> None:
            if state is not None:
                series, digest, rows, unique, outside, first, last = state
                done.append((*series, rows, unique, rows - unique, outside, first, last, digest.hexdigest()))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                series, (us, line, n) = row[:n_keys], row[n_keys:]
                if state is None or state[0] != series:
                    close()
                    state = [series, hashlib.sha256(), 0, 0, 0, None, None]
                if us is not None:
                    text = "\n".join([line] * n)
                    state[1].update((text if state[5] is None else "\n" + text).encode())
                    state[5], state[6] = (us if state[5] is None else state[5]), us
                    state[4] += 0 if lo <= us < hi else n
                state[2], state[3] = state[2] + n, state[3] + 1
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    longs = ["rows", "unique_rows", "duplicate_rows", "outside_window", "_first", "_last"]
    result = T.StructType([*[per.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in longs], T.StructField("sha256", T.StringType())])
    arrow = to_arrow_schema(result)
    names, kinds = arrow.names, arrow.types
    out = ordered.mapInArrow(observe, result)
    return out.select(*keys, *longs[:4], F.timestamp_micros("_first").alias("first"), F.timestamp_micros("_last").alias("last"), "sha256")


def inside_any(rows: DataFrame, ranges: DataFrame, start: str = "gap_start", end: str = "gap_end", keys: Sequence[str] = KEYS, at: str = "timestamp") -> DataFrame:
    """Rows whose time is in one of their series' ranges [start, end).

    Rows and ranges are put in one order within a series' month: a row is inside if the ranges that begin before or with
    it reach beyond it. A range is one row, however long, and there is one shuffle, on (series, month) of rows and range
    starts. Ranges may overlap. A row without a time is in none.
    """
    own = rows.where(F.col(at).isNotNull()).withColumns({"_from": F.col(at).cast("timestamp"), "_until": F.lit(None).cast("timestamp"), "_row": F.lit(1)})
    spans = ranges.where(F.col(start) < F.col(end)).select(*keys, F.col(start).cast("timestamp").alias("_from"), F.col(end).cast("timestamp").alias("_until"), F.lit(0).alias("_row"))
    df = reach(stacked(own, spans), keys, "_from", "_until", "_reach", "_row")
    return df.where((F.col("_row") == 1) & (F.col("_reach") > F.col("_from"))).select(*rows.columns)


def date_range(bars: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return bars.groupBy(*keys).agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
