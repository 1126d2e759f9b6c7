"""Bar, coverage and reference tables: Parquet in a bounded number of folders, whatever the number of series."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import inconsistent, validate_ohlc
from tidemark.operators.rollup import aggregate_bars, stale_series
from tidemark.schemas import BARS, SERIES, minutes

#: A bar table has a folder per provider, timeframe, bucket of symbols and period: a month below an hour, else a year.
PARTS = ["provider", "timeframe", "bucket", "period"]
BUCKETS = 16


def _bucket(symbol: Column) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(BUCKETS)).cast("int")


def bar_table(spark: SparkSession, path: str, ids: Sequence[str] = ()) -> DataFrame:
    """All bars of a table, with the identifiers of ticks that it was written with. Its schema is declared: folder names are not guessed at, as `1d` would become a number."""
    kinds = {"bucket": T.IntegerType()} | dict.fromkeys([*SERIES, "period"], T.StringType())
    return spark.read.schema(T.StructType([T.StructField("symbol", T.StringType()), *BARS, *[T.StructField(c, T.LongType()) for c in ids], *[T.StructField(c, kinds[c]) for c in PARTS]])).parquet(path)


def read_bars(spark: SparkSession, path: str, provider: str, symbol: str, timeframe: str, start: str | None = None, end: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """One series between two dates, both inclusive; a series that is not there is an error.

    Filters on partition columns prune folders, those on symbol and timestamp reach the Parquet scan.
    """
    df = bar_table(spark, path).where((F.col("provider") == provider) & (F.col("timeframe") == timeframe) & (F.col("bucket") == _bucket(F.lit(symbol))) & (F.col("symbol") == symbol))
    if df.isEmpty():
        raise KeyError(f"{provider}/{symbol}/bars/{timeframe}")
    period = (lambda day: f"m{day[:7]}") if (timeframe == "tick" or minutes(timeframe) < 60) else (lambda day: f"y{day[:4]}")
    if start:
        df = df.where((F.col("timestamp") >= F.lit(start).cast("timestamp")) & (F.col("period") >= period(start)))
    if end:
        df = df.where((F.col("timestamp") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")) & (F.col("period") <= period(end)))
    return df.select(*columns) if columns else df.drop("bucket", "period")


def list_series(bars: DataFrame, provider: str | None = None) -> DataFrame:
    return (bars.where(F.col("provider") == provider) if provider else bars).select(*SERIES).distinct()


def read_latest(bars: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy(*SERIES).orderBy(F.col("timestamp").desc())
    return bars.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def _placed(bars: DataFrame) -> DataFrame:
    """bars with the folder that they belong to."""
    fine = F.col("timeframe").rlike("^([1-5]?[0-9]m|tick)$")
    return bars.withColumns({"bucket": _bucket(F.col("symbol")), "period": F.when(fine, F.date_format("timestamp", "'m'yyyy-MM")).otherwise(F.date_format("timestamp", "'y'yyyy"))})


def _write(df: DataFrame, path: str) -> None:
    """Replace the folders that df has rows of, leaving others. Rows of a folder end up together, a very large one in several files."""
    df.hint("rebalance", *PARTS).sortWithinPartitions(*PARTS, "symbol", "timestamp").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def _replace(spark: SparkSession, path: str, staging: str, make: Callable[[], tuple[DataFrame | None, DataFrame]]) -> None:
    """Give some folders of the table new rows: make() returns the folders, or None if all get rows, and all rows that they are to have.

    Both are staged first, as a table can't be overwritten while it is read. staging names the call: if it was interrupted
    and is repeated, what was staged completely is used again, so that folders which were half replaced lose nothing; it is
    deleted at the end. Folders that are to have no rows are deleted; their names, bounded by buckets and periods, are all
    that the driver sees.
    """
    fs, kind = exists_in(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    if not exists(spark, f"{staging}/rows/_SUCCESS"):
        folders, rows = make()
        if folders is not None:
            folders.write.mode("overwrite").parquet(f"{staging}/folders")
        rows.write.mode("overwrite").parquet(f"{staging}/rows")
    rows = spark.read.parquet(f"{staging}/rows")
    if not rows.isEmpty():
        _write(rows, path)
    if exists(spark, f"{staging}/folders/_SUCCESS") and exists(spark, path):
        emptied = spark.read.parquet(f"{staging}/folders").select(*PARTS).join(rows.select(*PARTS).distinct(), PARTS, "left_anti")
        there = bar_table(spark, path).select(*PARTS, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")).join(F.broadcast(emptied), PARTS).distinct()
        for row in there.select("folder").collect():
            fs.delete(kind(spark._jvm.java.net.URI.create(row.folder)), True)
    fs.delete(kind(staging), True)


def valid_series(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars of series that pass validation, reports of those that do not)."""
    broken = reduce(lambda a, b: a | b, [*inconsistent().values(), F.col("volume") < 0])
    bad = bars.where(broken).select(*SERIES).distinct()
    return bars.join(bad, SERIES, "left_anti"), validate_ohlc(bars.join(bad, SERIES, "left_semi"), SERIES)


def write_bars(bars: DataFrame, path: str, staging: str, mode: str = "append", ids: Sequence[str] = ()) -> DataFrame:
    """Write valid series, in the types of bars, and return the reports of those refused.

    append merges with what is there in the folders that the new rows touch: of rows with one series and timestamp the
    last ingested stays (ingest_seq, stored rows first). overwrite replaces the series, all their bars; other series in
    their folders are written again. An interrupted call can be repeated with the same staging. ids are whole numbers that
    tell ticks of one series and timestamp apart; a table always has the same.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"append or overwrite, not {mode}")
    spark = bars.sparkSession
    good, bad = valid_series(bars)
    seq = F.col("ingest_seq") if "ingest_seq" in bars.columns else F.lit(0)

    def merged() -> tuple[DataFrame | None, DataFrame]:
        new, folders = _placed(good.select(*SERIES, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BARS], *[F.col(c).cast("long").alias(c) for c in ids], (seq + 1).cast("long").alias("_seq"))), None
        if has_bars(spark, path):
            new.write.mode("overwrite").parquet(f"{staging}/new")  # what is there is looked up by its folders, and then merged
            new = spark.read.parquet(f"{staging}/new")
            touched, there = new.select(*PARTS).distinct(), bar_table(spark, path, ids)
            if mode == "overwrite":
                replaced = new.select(*SERIES).distinct()
                folders = touched.union(there.join(replaced, SERIES, "left_semi").select(*PARTS)).distinct()
                there = there.join(replaced, SERIES, "left_anti")
            old = there.join(touched if folders is None else folders, PARTS, "left_semi")
            new = new.unionByName(old.withColumn("_seq", F.lit(-1).cast("long")))
        w = Window.partitionBy(*SERIES, "timestamp", *ids).orderBy(F.col("_seq").desc(), *[F.col(c).desc() for c in ("close", "open", "high", "low", "volume")])
        return folders, new.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_seq")

    _replace(spark, path, staging, merged)
    return bad


def has_bars(spark: SparkSession, path: str) -> bool:
    """Whether the table has a folder of bars."""
    if not exists(spark, path):
        return False
    return any(f.getPath().getName().startswith("provider=") for f in exists_in(spark, path).listStatus(spark._jvm.org.apache.hadoop.fs.Path(path)))


def cached_rollup(spark: SparkSession, path: str, staging: str, provider: str, timeframe: str, base: str = "1m") -> tuple[DataFrame, int]:
    """(all series of a provider in a coarser timeframe, how many were rolled up): kept in the bar table beside their base.

    Series whose base has gone on since they were cached are rolled up from the last cached bucket on, which may have been
    incomplete, and merged into the table; a second call finds nothing to do. Cached bars from before the base's span stay.
    """
    own = bar_table(spark, path).where(F.col("provider") == provider)
    fine, coarse = own.where(F.col("timeframe") == base), own.where(F.col("timeframe") == timeframe)
    stale = stale_series(fine, coarse, timeframe, ["symbol"])
    n = stale.count()
    if n:
        last = coarse.groupBy("symbol").agg(F.max("timestamp").alias("_from"))
        since = fine.join(stale, "symbol", "left_semi").join(last, "symbol", "left").where(F.col("_from").isNull() | (F.col("timestamp") >= F.col("_from")))
        new = aggregate_bars(since.drop("_from"), timeframe).withColumns({"provider": F.lit(provider), "timeframe": F.lit(timeframe)})
        write_bars(new, path, staging)
    return bar_table(spark, path).where((F.col("provider") == provider) & (F.col("timeframe") == timeframe)), n


def exists_in(spark: SparkSession, path: str):
    """The path's own file system."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table has files; the question goes to the path's own file system."""
    return exists_in(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def delete_series(spark: SparkSession, path: str, keys: DataFrame, staging: str | None = None) -> int:
    """Remove the bars of the given series; returns how many rows went. The folders they lie in are written again without them."""
    gone = keys.select(*SERIES).distinct()
    own = bar_table(spark, path).join(gone, SERIES, "left_semi")
    n = own.count()

    def left() -> tuple[DataFrame, DataFrame]:
        folders = own.select(*PARTS).distinct()
        return folders, bar_table(spark, path).join(folders, PARTS, "left_semi").join(gone, SERIES, "left_anti")

    if n or staging:
        _replace(spark, path, staging or f"{path}/_deleting-{uuid.uuid4().hex}", left)
    return n


def write_table(df: DataFrame, root: str, kind: str) -> None:
    """Quotes are appended, fundamentals and corporate actions replaced."""
    modes = {"quotes": "append", "fundamentals": "overwrite", "corp_actions": "overwrite", "instruments": "overwrite"}
    if kind not in modes:
        raise ValueError(f"no table of {kind}")
    df.write.mode(modes[kind]).parquet(f"{root}/{kind}")


#: Columns of the short-interest file and their names here.
SHORT_INTEREST_COLUMNS = {
    "symbolCode": "symbol", "issueName": "issue_name", "marketClassCode": "market", "currentShortPositionQuantity": "short_interest", "previousShortPositionQuantity": "prev_short_interest",
    "averageDailyVolumeQuantity": "avg_daily_volume", "daysToCoverQuantity": "days_to_cover", "revisionFlag": "revision_flag", "changePercent": "change_pct", "changePreviousNumber": "change_shares",
}
_LONGS, _DOUBLES = ("short_interest", "prev_short_interest", "avg_daily_volume", "change_shares"), ("days_to_cover", "change_pct")


def normalize_short_interest(spark: SparkSession, path: str, settlement_date: str, dissemination_date: str) -> DataFrame:
    """A pipe-delimited short-interest file: declared columns, bad numbers null, both dates, the file's URL and SHA-256."""
    raw = spark.read.option("sep", "|").option("header", True).option("inferSchema", False).csv(path)
    missing = sorted(set(SHORT_INTEREST_COLUMNS) - set(raw.columns))
    if missing:
        raise ValueError(f"columns {missing} are missing")
    kind = lambda n: "long" if n in _LONGS else "double" if n in _DOUBLES else "string"
    digest = spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_url"), F.sha2("content", 256).alias("source_sha256"))
    rows = raw.select(F.lit(settlement_date).cast("date").alias("settlement_date"), F.lit(dissemination_date).cast("date").alias("dissemination_date"), *[F.nullif(F.col(c), F.lit("N/A")).try_cast(kind(n)).alias(n) for c, n in SHORT_INTEREST_COLUMNS.items()], F.col("_metadata.file_path").alias("source_url"))
    return rows.join(F.broadcast(digest), "source_url", "left")  # one row per file of one settlement date


def read_membership_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """date and tickers of a CSV with a date and a comma-separated list."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.to_date("date").alias("date"), F.transform(F.split("tickers", ","), lambda t: F.trim(t)).alias("tickers"))
