"""Option chains, open interest and the frame that joins them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import PRICE

#: Underlyings with European exercise, the statistic that is open interest, and days that it may be old.
EUROPEAN = ("SPX", "SPXW", "NDX", "NDXP", "RUT", "VIX")
OPEN_INTEREST, OLDEST_DAYS = 9, 7


def q9(value: Column) -> Column:
    """A fixed-point integer with nine decimals as a price: half to even at the eighth."""
    return F.bround(value.cast("decimal(20,0)") / F.lit(10**9).cast("decimal(10,0)"), 8).cast(PRICE)


def ns_date(ns: Column) -> Column:
    return F.to_date(F.timestamp_seconds(F.floor(ns / 1_000_000_000)))


def normalize_option_chain(definitions: DataFrame, underlying: str) -> DataFrame:
    """Calls and puts of definition records, other classes left out; a missing multiplier is 0."""
    style = "E" if underlying.upper() in EUROPEAN else "A"
    rows = definitions.where(F.col("instrument_class").isin("C", "P"))
    return rows.select("instrument_id", F.col("raw_symbol").alias("osi_symbol"), F.col("instrument_class").alias("option_type"), q9(F.col("strike_price")).alias("strike"), ns_date(F.col("expiration")).alias("expiration"), F.coalesce("contract_multiplier", F.lit(0)).cast("int").alias("contract_multiplier"), F.lit(style).alias("exercise_style"))


def normalize_open_interest(statistics: DataFrame) -> DataFrame:
    """Open interest by instrument and date: that of ts_ref, or of ts_event where ts_ref is missing or 0."""
    rows = statistics.where(F.col("stat_type") == OPEN_INTEREST)
    return rows.select("instrument_id", ns_date(F.coalesce(F.nullif("ts_ref", F.lit(0)), "ts_event")).alias("oi_as_of"), F.col("quantity").cast("long").alias("open_interest"))


def normalize_option_mid(prices: DataFrame) -> DataFrame:
    """Middle of high and low by instrument and session, in decimals."""
    calc = lambda c: q9(F.col(c)).cast("decimal(18,8)")
    return prices.select("instrument_id", ns_date(F.col("ts_event")).alias("session"), ((calc("high") + calc("low")) / F.lit(2).cast("decimal(1,0)")).cast(PRICE).alias("mid"))


def latest_open_interest(oi: DataFrame, as_of: str, lag_sessions: int) -> DataFrame:
    """Per instrument the last figure in the week up to as_of less lag_sessions days; the larger of two of one day."""
    if lag_sessions < 1:
        raise ValueError("open interest settles a day later: lag_sessions must be 1 or more")
    cutoff = F.date_sub(F.lit(as_of).cast("date"), lag_sessions)
    known = oi.where(F.col("oi_as_of").between(F.date_sub(cutoff, OLDEST_DAYS), cutoff))
    return known.groupBy("instrument_id").agg(F.max(F.struct("oi_as_of", "open_interest")).alias("x")).select("instrument_id", "x.oi_as_of", "x.open_interest")


def gamma_flow_frame(chain: DataFrame, oi: DataFrame, mid: DataFrame, spot: float, spot_as_of: str, as_of: str, lag_sessions: int = 1) -> DataFrame:
    """Contracts with known open interest, a mid of the day and time left; usable from the next day on."""
    if spot_as_of > as_of:
        raise ValueError("spot_as_of must not be after as_of")
    day = F.lit(as_of).cast("date")
    today = mid.where(F.col("session") == day).select("instrument_id", "mid")
    df = chain.join(latest_open_interest(oi, as_of, lag_sessions), "instrument_id").join(today, "instrument_id").withColumn("tte_years", F.datediff("expiration", day) / 365.25).where("tte_years > 0")
    return df.select("instrument_id", "option_type", "strike", "expiration", "tte_years", "open_interest", "oi_as_of", "mid", F.lit(spot).cast(PRICE).alias("underlying_spot"), F.lit(spot_as_of).cast("date").alias("spot_as_of"), "contract_multiplier", "exercise_style", F.date_add(day, 1).cast("timestamp").alias("feature_available_at"))
