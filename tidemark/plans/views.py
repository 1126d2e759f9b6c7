"""Series and dimensions that the queries derive from the driver's tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import CALC

#: ticks and one-minute bars of the events table; ties of time are broken by event_id.
BARS_SQL = """
ticks as (select event_type as symbol, ts, event_id, cast(value as decimal(18,8)) as price from events),
bars as (select symbol, date_trunc('minute', ts) as ts, arg_min(price, row(ts, event_id)) as open, max(price) as high, min(price) as low,
  arg_max(price, row(ts, event_id)) as close, count(*)::bigint as volume from ticks group by 1, 2)"""
#: Daily bars of the lineitem table by supplier: the close is the average price in whole ticks, from sums of whole cents, so
#: that neither the order of rows nor ties matter.
DAILY_SQL = """
daily as (select 'S' || l_suppkey as symbol, l_shipdate as ts, floor(sum(round(l_extendedprice * 100)::bigint)::double / sum(l_quantity)::double * 100) / 10000.0::double as close,
  max(l_extendedprice / l_quantity) as high, min(l_extendedprice / l_quantity) as low, sum(l_quantity)::bigint as volume from lineitem group by 1, 2)"""
COVERAGE_SQL = """
coverage as (select 'C' || o_custkey as symbol, o_orderdate as start_ts, o_orderdate + to_days(cast(o_orderkey % 30 + 1 as integer)) as end_ts,
  o_orderdate + interval 1 hour as fetched_at, 'J' || (o_orderkey % 3) as batch_job_id from orders)"""
SNAPSHOTS_SQL = """
snapshots as (select 'orders' as source, last_day(o_orderdate) as date, list_sort(list(distinct 'C' || o_custkey)) as tickers
  from orders group by last_day(o_orderdate))"""
CHANGES_SQL = """
changes as (select distinct o_orderdate::date as date, 'C' || o_custkey as symbol, case when o_orderkey % 2 = 0 then 'added' else 'removed' end as action from orders)"""
SYMBOLOGY_SQL = """
firsts as (select 'C' || o_custkey as raw_symbol, o_orderdate::date as valid_from, max(o_orderkey) as instrument_id from orders group by 1, 2),
symbology as (select *, lead(valid_from) over (partition by raw_symbol order by valid_from) - 1 as valid_to from firsts)"""
FACTS_SQL = """
facts as (select 'K' || (o_custkey % 500) as cik,
    ['Revenues', 'SalesRevenueNet', 'InventoryNet', 'NetCashProvidedByUsedInOperatingActivities', 'PaymentsToAcquireProductiveAssets', 'OperatingIncomeLoss', 'InterestExpense', 'ShareBasedCompensation'][1 + (o_orderkey % 8)] as tag,
    'USD' as unit, make_date(year(o_orderdate), 1, 1) as start, make_date(year(o_orderdate), 12, 31) as "end", make_date(year(o_orderdate), 12, 31) + 60 + (o_orderkey % 3)::integer as filed,
    '10-K' as form, 'FY' as fp, (min(o_orderkey))::bigint as pos, round(sum(o_totalprice), 2) as val
  from orders group by all)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def us(c: str, name: str | None = None):
    """A time as microseconds, which both engines compare alike."""
    return F.unix_micros(F.col(c).cast("timestamp")).alias(name or f"{c}_us")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("timestamp"), "event_id", F.col("value").cast(CALC).alias("price"))


def bars_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    at = F.struct("timestamp", "event_id")
    return t.groupBy("symbol", F.date_trunc("minute", "timestamp").alias("minute")).agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").alias("volume")).withColumnRenamed("minute", "timestamp")


def bars_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_extendedprice") / F.col("l_quantity")
    out = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.col("l_shipdate").cast("timestamp").alias("timestamp"))
    return out.agg((F.floor(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).cast("double") / F.sum("l_quantity").cast("double") * 100) / F.lit(10_000.0)).alias("close"), F.max(p).alias("high"), F.min(p).alias("low"), F.sum("l_quantity").cast("long").alias("volume"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("o_orderdate").cast("timestamp")
    days = F.make_interval(days=(F.col("o_orderkey") % 30 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("symbol"), start.alias("start_ts"), (start + days).alias("end_ts"), (start + F.expr("interval 1 hour")).alias("fetched_at"), F.concat(F.lit("J"), F.col("o_orderkey") % 3).alias("batch_job_id"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the snapshots are made of."""
    return table(spark, sf_dir, "orders").select(F.lit("orders").alias("source"), F.last_day(F.col("o_orderdate").cast("date")).alias("date"), F.concat(F.lit("C"), "o_custkey").alias("symbol"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.last_day(F.col("o_orderdate").cast("date")).alias("date")).agg(F.sort_array(F.collect_set(F.concat(F.lit("C"), "o_custkey"))).alias("tickers"), F.min(F.lit("orders")).alias("source"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").cast("date").alias("date"), F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.when(F.col("o_orderkey") % 2 == 0, "added").otherwise("removed").alias("action")).distinct()


def symbology(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders")
    one = o.groupBy(F.concat(F.lit("C"), "o_custkey").alias("raw_symbol"), F.col("o_orderdate").cast("date").alias("valid_from")).agg(F.max("o_orderkey").alias("instrument_id"))
    return one.withColumn("valid_to", F.date_sub(F.lead("valid_from").over(Window.partitionBy("raw_symbol").orderBy("valid_from")), 1))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = ["Revenues", "SalesRevenueNet", "InventoryNet", "NetCashProvidedByUsedInOperatingActivities", "PaymentsToAcquireProductiveAssets", "OperatingIncomeLoss", "InterestExpense", "ShareBasedCompensation"]
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    year = F.year("o_orderdate")
    end = F.make_date(year, F.lit(12), F.lit(31))
    keys = [F.concat(F.lit("K"), F.col("o_custkey") % 500).alias("cik"), F.element_at(F.lit(tags), (k % 8 + 1).cast("int")).alias("tag"), F.lit("USD").alias("unit"), F.make_date(year, F.lit(1), F.lit(1)).alias("start"), end.alias("end"), F.date_add(end, (k % 3 + 60).cast("int")).alias("filed"), F.lit("10-K").alias("form"), F.lit("FY").alias("fp")]
    return o.groupBy(*keys).agg(F.min(k).alias("pos"), F.round(F.sum("o_totalprice"), 2).alias("val"))


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.concat(F.lit("P"), "p_partkey").alias("symbol"), F.col("p_retailprice").alias("price"), (F.col("p_size") * F.col("p_retailprice")).alias("dollar_volume_20d"), F.col("p_type").alias("security_type"), F.col("p_brand").alias("exchange"))
