"""Incremental, idempotent loading that is driven by gaps in coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.coverage import edge_gaps, inside_any, merge_ranges, per_symbol_gaps
from tidemark.operators.quality import dedup_bars, detect_internal_gaps
from tidemark.operators.segments import stacked
from tidemark.schemas import BARS, SERIES, minutes
from tidemark.sources import tables


def _until(spark: SparkSession, end: str) -> str:
    """The end of the window that has end as its last day."""
    return spark.range(1).select(F.date_add(F.lit(end).cast("date"), 1).cast("timestamp").cast("string")).first()[0]


def _bare(universe: DataFrame, landing: DataFrame) -> DataFrame:
    """Symbols that the landing table marks as without data."""
    return landing.where("no_data").select("symbol").distinct() if "no_data" in landing.columns else universe.select("symbol").limit(0)


def _claims(universe: DataFrame, landing: DataFrame, coverage: DataFrame, start: str, until: str, force: bool) -> DataFrame:
    gaps = per_symbol_gaps(universe.select("symbol"), coverage.limit(0) if force else coverage, f"{start} 00:00:00", until)
    gaps = gaps.join(_bare(universe, landing), "symbol", "left_anti")
    return gaps.select("symbol", F.col("gap_start").alias("start_ts"), F.col("gap_end").alias("end_ts"))


def _rows(landing: DataFrame, claims: DataFrame, start: str, until: str) -> DataFrame:
    """Landing rows inside the claims; rows outside the window, which are in none, go before they are shuffled."""
    bars = landing.where("not no_data").drop("no_data") if "no_data" in landing.columns else landing
    bars = bars.where((F.col("timestamp") >= F.lit(f"{start} 00:00:00").cast("timestamp")) & (F.col("timestamp") < F.lit(until).cast("timestamp")))
    return inside_any(bars, claims, "start_ts", "end_ts")


def _report(universe: DataFrame, landing: DataFrame, rows: DataFrame, claims: DataFrame) -> DataFrame:
    loaded = rows.groupBy("symbol").agg(F.count("*").alias("rows"))
    asked = claims.groupBy("symbol").agg(F.count("*").alias("gaps"))
    skipped = _bare(universe, landing).withColumn("_bare", F.lit(True))
    report = universe.select("symbol").distinct().join(loaded, "symbol", "left").join(asked, "symbol", "left").join(skipped, "symbol", "left")
    return report.select("symbol", F.when(F.col("_bare"), "skipped").otherwise("ok").alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("gaps", F.lit(0)).alias("gaps"))


def sync(universe: DataFrame, landing: DataFrame, coverage: DataFrame, start: str, end: str, force: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows to load, coverage claims, report) for all symbols of a universe in one plan.

    The window is [start, end + 1 day) in UTC. Rows of the landing table inside a symbol's gaps are taken, or of the
    whole window if forced. Each gap is claimed, also if it has no rows, unless the landing table marks the symbol as
    without data (no_data, if there is such a column).
    """
    until = _until(landing.sparkSession, end)
    claims = _claims(universe, landing, coverage, start, until, force)
    rows = _rows(landing, claims, start, until)
    return rows, claims, _report(universe, landing, rows, claims)


def commit(claims: DataFrame, coverage: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Coverage after a run: old ranges and the claims of symbols that did not fail, merged.

    Call it once the bars are written. A run that dies in between is repeated: its rows are deduplicated, its claims merge.
    """
    good = claims.join(failed.select("symbol").distinct(), "symbol", "left_anti") if failed is not None else claims
    return merge_ranges(stacked(coverage.select("symbol", "start_ts", "end_ts"), good.select("symbol", "start_ts", "end_ts")))


COVERAGE = "symbol string, start_ts timestamp, end_ts timestamp"


def read_coverage(spark: SparkSession, root: str) -> DataFrame:
    """The coverage that the last finished run left under root; empty before the first.

    Every run writes a version of its own, numbered upwards; a version counts once it is complete.
    """
    versions = _versions(spark, root)
    return spark.read.schema(COVERAGE).parquet(f"{root}/coverage/{versions[-1]}") if versions else spark.createDataFrame([], COVERAGE)


def _versions(spark: SparkSession, root: str) -> list[str]:
    fs, path = tables.exists_in(spark, root), spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(path(f"{root}/coverage")):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path(f"{root}/coverage"))]
    return sorted(n for n in names if fs.exists(path(f"{root}/coverage/{n}/_SUCCESS")))


def _step(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at path; made first unless it is complete, so that a repeated run goes on with the same rows."""
    if not tables.exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_sync(universe: DataFrame, landing: DataFrame, root: str, run: str, start: str, end: str, provider: str, timeframe: str, force: bool = False) -> DataFrame:
    """Load what a universe lacks into the bar table and the coverage under root; returns the report.

    The run, named by the caller, has four steps: claims and report, then rows, are staged; bars are written, merged with
    those that are there, or instead of them if forced; coverage, with the claims of all symbols but those whose bars were
    refused, comes last; what a forced run has replaced is only covered by its own claims. A run that stops after any step is called again with its name: what is complete is kept, a write of
    bars gives the same table again, and coverage never claims what was not written. A finished run does nothing but return its report.

    landing has the columns of bars and symbol, and no_data (boolean) if it marks symbols without data. In the report a
    refused symbol has the status failed, no rows and its gaps. Runs of one root must not overlap.
    """
    spark, at = universe.sparkSession, f"{root}/runs/{run}"
    if not tables.exists(spark, f"{at}/coverage-before/_SUCCESS"):
        read_coverage(spark, root).write.mode("overwrite").parquet(f"{at}/coverage-before")  # what the claims are made from
    before = spark.read.schema(COVERAGE).parquet(f"{at}/coverage-before")
    until = _until(spark, end)
    # each step is made from the ones that are staged, so that nothing is worked out twice
    claims = _step(spark, f"{at}/claims", lambda: _claims(universe, landing, before, start, until, force))
    rows = _step(spark, f"{at}/rows", lambda: _rows(landing, claims, start, until))
    report = _step(spark, f"{at}/report", lambda: _report(universe, landing, rows, claims))

    def write():
        series = {"provider": F.lit(provider), "timeframe": F.lit(timeframe)}
        bad = tables.write_bars(rows.withColumns(series).select(*SERIES, *BARS.names), f"{root}/bars", f"{at}/staging", "overwrite" if force else "append")
        return bad.select("symbol")

    failed = _step(spark, f"{at}/refused", write)
    number = len([v for v in _versions(spark, root) if not v.endswith(f"-{run}")])
    written = rows.select("symbol").distinct().join(failed, "symbol", "left_anti")
    kept = before.join(written, "symbol", "left_anti") if force else before  # bars that were replaced are covered no more
    _step(spark, f"{root}/coverage/{number:08d}-{run}", lambda: commit(claims, kept, failed))
    refused = failed.distinct().withColumn("_failed", F.lit(True))
    out = report.join(refused, "symbol", "left")
    return out.select("symbol", F.when(F.col("_failed"), "failed").otherwise(F.col("status")).alias("status"), F.when(F.col("_failed"), 0).otherwise(F.col("rows")).alias("rows"), "gaps")


def skipped_symbols(requested: DataFrame, markers: DataFrame) -> DataFrame:
    """Requested symbols that the landing table marks as without data; they claim nothing."""
    return requested.select("symbol").distinct().join(markers.where("no_data").select("symbol").distinct(), "symbol", "left_semi")


def _stored_gaps(bars: DataFrame, start: str, end: str, timeframe: str) -> DataFrame:
    """Gaps of stored series as half-open times: inside, before and after; fewer than two rows leave the whole range."""
    step = F.make_interval(mins=F.lit(minutes(timeframe)))
    ends = bars.groupBy("symbol").agg(F.count("*").alias("n"), F.to_date(F.min("timestamp")).alias("first_date"), F.to_date(F.max("timestamp")).alias("last_date"))
    few = F.col("n") < 2
    edges = edge_gaps(ends.select("symbol", F.when(~few, F.col("first_date")).alias("first_date"), F.when(~few, F.col("last_date")).alias("last_date")), start, end, timeframe)
    edges = edges.select("symbol", F.col("gap_start").cast("timestamp").alias("gap_start"), F.date_add("gap_end", 1).cast("timestamp").alias("gap_end"))
    inner = detect_internal_gaps(bars, timeframe).select("symbol", "gap_start", (F.col("gap_end") + step).alias("gap_end"))
    return stacked(inner, edges)


def backfill(bars: DataFrame, landing: DataFrame, start: str, end: str, timeframe: str) -> DataFrame:
    """Stored bars together with landing rows in their gaps, one row per time."""
    return dedup_bars(bars, inside_any(landing, _stored_gaps(bars, start, end, timeframe)))


def backfill_gaps(gaps: DataFrame, bars: DataFrame, landing: DataFrame) -> DataFrame:
    """The same with given ranges [gap_start, gap_end)."""
    return dedup_bars(bars, inside_any(landing, gaps))


def update_to_now(bars: DataFrame, landing: DataFrame, now: str, lookback_days: int = 30) -> DataFrame:
    """Landing rows after each series' last stored time; series without rows start lookback_days before now."""
    last = bars.groupBy("symbol").agg(F.max("timestamp").alias("_last"))
    at = F.lit(now).cast("timestamp")
    df = landing.join(last, "symbol", "left").where((F.col("timestamp") > F.coalesce("_last", at - F.make_interval(days=F.lit(lookback_days)))) & (F.col("timestamp") <= at))
    return df.drop("_last")


def update_many(series: DataFrame, landing: DataFrame, start: str, end: str, stored: DataFrame | None = None, timeframe: str = "1d") -> DataFrame:
    """One result row per series: status ok, failed (it has a malformed row, whose reason is in quarantine) or skipped (no rows), rows and gaps.

    gaps counts the ranges that the stored bars lack of start to end, inside, before and after, which the update of the
    series fills; a series with fewer than two bars lacks one range, all of it. A series that is not updated fills none.
    """
    inside = landing.where(F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    per = inside.groupBy("symbol").agg(F.count("*").alias("n"), F.min("quarantine").alias("quarantine"))
    df = series.select("symbol").distinct().join(per, "symbol", "left")
    if stored is None:
        df = df.withColumn("_lacks", F.lit(1).cast("long"))
    else:
        lacks = _stored_gaps(stored, start, end, timeframe).groupBy("symbol").agg(F.count("*").alias("_lacks"))
        lacks = stored.select("symbol").distinct().join(lacks, "symbol", "left").select("symbol", F.coalesce("_lacks", F.lit(0)).alias("_lacks"))
        df = df.join(lacks, "symbol", "left").withColumn("_lacks", F.coalesce("_lacks", F.lit(1)).cast("long"))
    status = F.when(F.col("n").isNull(), "skipped").when(F.col("quarantine").isNotNull(), "failed").otherwise("ok")
    done = lambda c: F.when(status == "ok", F.col(c)).otherwise(0)
    return df.select("symbol", status.alias("status"), done("n").alias("rows"), done("_lacks").alias("gaps"), F.col("quarantine").alias("reason"))
