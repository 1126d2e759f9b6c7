"""Decisions on reads of research data, from ledgers of windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



#: Purposes, those that count as research, symbols with routes of their own.
PURPOSES = ("discovery", "validation", "characterization", "forward_accrual", "dev_smoke")
RESEARCH = PURPOSES[:-1]
LADDER, MONTH_END, CRYPTO_FUTURES = ("SPY", "QQQ"), ("SPY", "AGG"), ("@MBT", "@MET")
LEDGER_DAYS = ("discovery_start", "discovery_end", "validation_start", "validation_end", "lockbox_start", "characterization_start", "characterization_end", "forward_accrual_start")
LEDGER = T.StructType([T.StructField("version", T.StringType()), T.StructField("dataset", T.StringType()), *[T.StructField(c, T.DateType()) for c in LEDGER_DAYS], T.StructField("allowed_purposes", T.ArrayType(T.StringType()))])
#: The campaign's ledger: dataset, discovery, validation, lockbox, characterization, forward accrual, purposes.
CAMPAIGN = """
spy_qqq_ladder_tradestation | 2015-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
month_end_spy_agg           | 2017-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
index_recon_sp500           | 2017-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
tradestation_cohort_1m      | 2019-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
oanda_fx                    | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
binance_spot                | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
coinbase_spot               | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
tradestation_crypto_futures | 2022-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
short_interest_bar_coverage | | | | | | 2021-06-15 | 2025-12-31 | | characterization
binance_perp                | | | | | | | | |
databento_extended_hours    | | | | | | 2023-01-01 | 2025-12-31 | 2026-01-01 | characterization,forward_accrual
"""
#: The ledger whose datasets share one set of windows.
UNIFORM = """
spy_qqq_ladder_tradestation | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
tradestation_cohort_1m      | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
oanda_fx                    | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
coinbase_spot               | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
databento_extended_hours    | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
databento_opra_options      | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
fred_macro                  | 2020-01-01 | 2024-12-31 | 2025-01-01 | 2025-12-31 | 2026-01-01 | | | |
"""


def campaign_ledger(spark: SparkSession) -> DataFrame:
    """The campaign's datasets and windows."""
    return _ledger(spark, "intraday_campaign_v1.3", CAMPAIGN)


def uniform_ledger(spark: SparkSession) -> DataFrame:
    """The ledger whose datasets share one set of windows."""
    return _ledger(spark, "fce_v1_2020_2026", UNIFORM)


def _ledger(spark: SparkSession, version: str, table: str) -> DataFrame:
    rows = [[cell.strip() or None for cell in line.split("|")] for line in table.strip().splitlines()]
    df = spark.createDataFrame([(version, *r) for r in rows], ", ".join(f"{n} string" for n in LEDGER.names))
    return df.select(*[(F.split(f.name, ",") if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast(f.dataType)).alias(f.name) for f in LEDGER])


def route_dataset(provider: Column, symbol: Column, asset_class: Column) -> Column:
    """The ledger's dataset of a read; null if it is not governed."""
    p, s, a = F.lower(provider), F.upper(symbol), F.coalesce(asset_class, F.lit(""))
    ts = p == "tradestation"
    out = F.when(ts & ((a == "future") | s.isin(*CRYPTO_FUTURES)), "tradestation_crypto_futures").when(ts & (a == "month_end_book") & s.isin(*MONTH_END), "month_end_spy_agg").when(ts & (a == "index_recon_book"), "index_recon_sp500")
    out = out.when(ts & (a == "short_interest_book"), "short_interest_bar_coverage").when(ts & s.isin(*LADDER), "spy_qqq_ladder_tradestation").when(ts, "tradestation_cohort_1m")
    out = out.when(p == "oanda", "oanda_fx").when(p == "binance", "binance_spot").when(p == "coinbase", "coinbase_spot")
    out = out.when((p == "databento") & (a == "option"), "databento_opra_options").when((p == "databento") & (a == "index_recon_book"), "index_recon_sp500").when(p == "databento", "databento_extended_hours")
    return out.when(p.isin("alpaca", "sec_edgar") & (a == "index_recon_book"), "index_recon_sp500")


def asset_class_rules(requests: DataFrame) -> DataFrame:
    """requests with rule: what an asset class forbids ahead of the ledger, or null."""
    c = F.col
    short, index = c("asset_class") == "short_interest_book", c("asset_class") == "index_recon_book"
    off = lambda cond: F.coalesce(cond, F.lit(True))
    rule = F.when(short & off(F.lower("provider") != "tradestation"), "short_interest_provider").when(short & c("purpose").isNull(), "short_interest_purpose").when(short & off(c("data_kind") != "bar_coverage"), "short_interest_kind").when(short & off(c("timeframe") != "1d"), "short_interest_timeframe")
    rule = rule.when(c("purpose").isNotNull() & index & (c("data_kind") == "bars") & off(c("timeframe") != "1d"), "index_recon_timeframe")
    return requests.withColumn("rule", rule)


def decide_reads(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """requests with dataset, allowed and reason.

    Rules apply in order: asset class, no purpose (not governed), arm, route (ungoverned is allowed), purpose, bounds,
    dataset, then the purpose's windows; dev_smoke needs no window. A final review may read inside the lockbox only. The
    ledger has a row per dataset, a handful, and is broadcast.
    """
    c = F.col
    df = asset_class_rules(requests).withColumn("dataset", route_dataset(c("provider"), c("symbol"), c("asset_class")))
    df = df.join(F.broadcast(ledger.drop("version").withColumn("_known", F.lit(True))), "dataset", "left")
    lacks = lambda k: c(f"{k}_start").isNull()
    outside = lambda k: (c("start") < c(f"{k}_start")) | (c("end") > c(f"{k}_end"))
    p = c("purpose")
    locked = c("lockbox_start").isNotNull() & (c("end") >= c("lockbox_start"))
    not_admitted = c("allowed_purposes").isNotNull() & ~F.array_contains("allowed_purposes", p)
    reason = F.when(c("rule").isNotNull(), c("rule")).when(p.isNull(), "ungoverned").when(F.coalesce(c("arm_id"), F.lit("")) == "", "arm_required").when(c("dataset").isNull(), "ungoverned")
    reason = reason.when(~p.isin(*PURPOSES), "unknown_purpose").when(c("start").isNull() | c("end").isNull(), "missing_bounds").when(c("start") > c("end"), "start_after_end").when(c("_known").isNull(), "unknown_dataset")
    reason = reason.when(p == "dev_smoke", "allowed").when(not_admitted, "purpose_not_admitted").when(c("final_portfolio_review") & locked & (c("start") < c("lockbox_start")), "review_crosses_lockbox").when(c("final_portfolio_review") & locked, "allowed").when(locked, "lockbox")
    for k in ("discovery", "validation"):
        reason = reason.when((p == k) & lacks(k), "no_window").when((p == k) & outside(k), "outside_window")
    reason = reason.when((p == "characterization") & (c("allowed_purposes").isNull() | ~F.array_contains("allowed_purposes", "characterization")), "purpose_not_admitted").when((p == "characterization") & lacks("characterization"), "no_window").when((p == "characterization") & outside("characterization"), "outside_window")
    reason = reason.when((p == "forward_accrual") & lacks("forward_accrual"), "no_window").when((p == "forward_accrual") & (c("start") < c("forward_accrual_start")), "outside_window").otherwise("allowed")
    return df.withColumn("reason", reason).select(*requests.columns, "dataset", "reason", F.col("reason").isin("allowed", "ungoverned").alias("allowed"))


def check_validation_reuse(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Validation reads of requests and log by (dataset, arm): those of a later session than the first are denied (reused)."""
    both = log.where(F.col("purpose") == "validation").select("dataset", "arm_id", "session_id", "ts", F.lit(None).cast("long").alias("request_id")).unionByName(requests.where(F.col("purpose") == "validation").select("dataset", "arm_id", "session_id", "ts", F.col("request_id").cast("long").alias("request_id")))
    first = F.first("session_id").over(Window.partitionBy("dataset", "arm_id").orderBy("ts", "session_id"))
    return both.withColumn("reused", F.col("session_id") != first).where("request_id is not null").select("request_id", "dataset", "arm_id", "session_id", "reused")


def usage_entries(permitted: DataFrame, version: str) -> DataFrame:
    """The nine logged fields of permitted reads."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    return permitted.where("allowed and dataset is not null and purpose is not null").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("ts"), "session_id", F.lit(version).alias("ledger_version"), "dataset", iso("start").alias("start"), iso("end").alias("end"), "purpose", "arm_id", F.coalesce("final_portfolio_review", F.lit(False)).alias("final_portfolio_review"))


def append_usage_log(permitted: DataFrame, version: str, path: str) -> None:
    usage_entries(permitted, version).write.mode("append").json(path)


def citable_windows(log: DataFrame, arm_id: str, dataset: str, session_id: str | None = None) -> DataFrame:
    """start and end of logged research reads of one arm and dataset."""
    out = log.where((F.col("arm_id") == arm_id) & (F.col("dataset") == dataset) & F.col("purpose").isin(*RESEARCH))
    return (out.where(F.col("session_id") == session_id) if session_id else out).select("start", "end")
