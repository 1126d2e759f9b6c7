"""Queries that render driver tables as vendor payloads and read them back, and queries over calendar, options and governance."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidemark.operators import calendar, governance, options
from tidemark.plans import views
from tidemark.plans.views import BARS_SQL, us
from tidemark.sources import payloads

_BARS_OUT = "symbol, epoch_us(ts) as ts_us, open::double as open, high::double as high, low::double as low, close::double as close, volume::double as volume"


def _out(df, key="symbol"):
    return df.select(F.col(key).alias("symbol"), us("timestamp", "ts_us"), *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")])


def _landed(spark, d, item, wrap):
    """One payload per symbol and day: what a landing folder holds."""
    b = views.bars_1m(spark, d).withColumn("day", F.to_date("timestamp"))
    price = {c: F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close")}
    rows = b.select("symbol", "day", item({k: v for k, v in price.items()}).alias("x"))
    return rows.groupBy("symbol", "day").agg(wrap(F.collect_list("x")).alias("payload")).select("symbol", "payload")


_iso = lambda: F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'.000000000Z'")
_sec = lambda: F.unix_seconds("timestamp")
_json = lambda name: lambda x: F.to_json(F.struct(x.alias(name)))


def a9(spark, d):
    item = lambda p: F.struct((F.minute("timestamp") % 10 != 0).alias("complete"), _iso().alias("time"), F.col("volume").alias("volume"), F.struct(p["open"].alias("o"), p["high"].alias("h"), p["low"].alias("l"), p["close"].alias("c")).alias("mid"))
    return _out(payloads.normalize_oanda(_landed(spark, d, item, _json("candles"))))


def a10(spark, d):
    item = lambda p: F.array((_sec() * 1000).cast("string"), p["open"], p["high"], p["low"], p["close"], F.col("volume").cast("string"), F.lit("0"))
    return _out(payloads.normalize_binance(_landed(spark, d, item, F.to_json)))


def a11(spark, d):
    item = lambda p: F.array(_sec().cast("string"), p["low"], p["high"], p["open"], p["close"], F.col("volume").cast("string"))
    return _out(payloads.normalize_coinbase(_landed(spark, d, item, F.to_json), "2024-01-05", "2024-01-20"))


def a12(spark, d):
    item = lambda p: F.struct((_sec() * 1000).alias("t"), p["open"].alias("o"), p["high"].alias("h"), p["low"].alias("l"), p["close"].alias("c"), F.col("volume").alias("v"))
    return _out(payloads.normalize_polygon(_landed(spark, d, item, _json("results"))))


def a13(spark, d):
    item = lambda p: F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"), p["open"].alias("o"), p["high"].alias("h"), p["low"].alias("l"), p["close"].alias("c"), F.col("volume").alias("v"))
    return _out(payloads.normalize_alpaca(_landed(spark, d, item, _json("bars"))))


def a14(spark, d):
    item = lambda p: F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("TimeStamp"), p["open"].alias("Open"), p["high"].alias("High"), p["low"].alias("Low"), p["close"].alias("Close"), F.when(F.minute("timestamp") % 3 != 0, F.col("volume")).alias("TotalVolume"))
    return _out(payloads.normalize_tradestation(_landed(spark, d, item, _json("Bars")), "2024-01-10"))


def a15(spark, d):
    e = views.table(spark, d, "orders").select(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").cast("date").alias("date"), F.when(F.col("o_orderkey") % 4 == 0, F.lit(float("nan"))).when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("value"))
    return _out(payloads.normalize_fred(e), "series")


def _q9_records(spark, d):
    b = views.bars_1m(spark, d)
    fixed = lambda c: (F.col(c).cast("decimal(18,8)") * 1_000_000_000).cast("long")
    gone = F.when(F.minute("timestamp") % 13 == 0, F.lit(payloads.NO_PRICE)).otherwise(fixed("high"))
    return b.select("symbol", F.lit(7).alias("instrument_id"), (F.unix_micros("timestamp") * 1000).alias("ts_event"), fixed("open").alias("open"), gone.alias("high"), fixed("low").alias("low"), fixed("close").alias("close"), "volume")


def a18(spark, d):
    s = views.symbology(spark, d)
    entry = F.struct(F.date_format("valid_from", "yyyy-MM-dd").alias("d0"), F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit("")).alias("d1"), F.when(F.col("instrument_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("instrument_id").cast("string")).alias("s"))
    per = s.groupBy("raw_symbol").agg(F.collect_list(entry).alias("v"))
    landed = per.select(F.to_json(F.struct(F.create_map("raw_symbol", "v").alias("mappings"))).alias("payload"))
    out = payloads.flatten_symbology(landed)
    return out.select("raw_symbol", "instrument_id", F.datediff("valid_from", F.lit("1970-01-01").cast("date")).alias("from_day"), F.datediff("valid_to", F.lit("1970-01-01").cast("date")).alias("to_day"))


def a21(spark, d):
    b = views.bars_1m(spark, d)
    q = F.struct(F.col("symbol").alias("Symbol"), *[F.col(c).cast("string").alias(n) for c, n in (("close", "Last"), ("high", "High"), ("low", "Low"))], F.when(F.minute("timestamp") % 7 != 0, F.col("open").cast("string")).otherwise("n/a").alias("PreviousClose"), F.col("volume").cast("string").alias("Volume"))
    landed = b.groupBy("symbol", F.to_date("timestamp").alias("day")).agg(F.to_json(F.struct(F.collect_list(q).alias("Quotes"))).alias("payload")).select("payload")
    return payloads.normalize_quotes(landed)


def a22(spark, d):
    p = views.table(spark, d, "part")
    x = F.struct(F.col("p_name").alias("symbol"), F.col("p_type").alias("name"), F.lit("us_equity").alias("class"), F.col("p_brand").alias("exchange"), F.when(F.col("p_partkey") % 3 == 0, "inactive").otherwise("active").alias("status"))
    landed = p.groupBy("p_brand").agg(F.to_json(F.collect_list(x)).alias("payload")).select("payload")
    return payloads.normalize_instruments(landed, "alpaca").drop("type")


def a23(spark, d):
    p = views.table(spark, d, "part").select(F.concat_ws("_", F.lit("P"), "p_partkey", F.lit("X")).alias("symbol"), "p_brand")
    return payloads.standardize_instruments(p, "vendor", "stocks")


def a25(spark, d):
    o = views.table(spark, d, "orders")
    rec = F.create_map(F.lit("id"), F.col("o_orderkey").cast("string"), F.lit("price"), F.col("o_totalprice").cast("string"))
    per = o.groupBy("o_custkey", F.col("o_orderpriority").alias("kind")).agg(F.collect_list(rec).alias("v"))
    landed = per.groupBy("o_custkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("kind", "v")))).alias("payload")).select("payload")
    return payloads.flatten_corporate_actions(landed).select("corporate_action_type", F.col("record")["id"].cast("long").alias("id"))


def a29(spark, d):
    f = views.facts(spark, d)
    x = F.struct(F.date_format("start", "yyyy-MM-dd").alias("start"), F.date_format("end", "yyyy-MM-dd").alias("end"), "val", F.date_format("filed", "yyyy-MM-dd").alias("filed"), "form", "fp")
    tags = f.groupBy("cik", "tag").agg(F.collect_list(x).alias("v")).select("cik", "tag", F.struct(F.create_map(F.lit("USD"), "v").alias("units")).alias("n"))
    landed = tags.groupBy("cik").agg(F.to_json(F.struct(F.create_map(F.lit("us-gaap"), F.map_from_entries(F.collect_list(F.struct("tag", "n")))).alias("facts"))).alias("payload"))
    out = payloads.explode_companyfacts(landed)
    return out.select("cik", "taxonomy", "tag", "unit", F.datediff("end", F.lit("1970-01-01").cast("date")).alias("end_day"), F.datediff("filed", F.lit("1970-01-01").cast("date")).alias("filed_day"), F.col("val"))


def a30(spark, d):
    o = views.table(spark, d, "orders")
    at = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'12:30:00.000'Z'")
    cols = {"form": F.when(F.col("o_orderkey") % 2 == 0, "8-K").otherwise("10-Q"), "filingDate": F.date_format("o_orderdate", "yyyy-MM-dd"), "acceptanceDateTime": at, "accessionNumber": F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), "items": F.when(F.col("o_orderkey") % 4 == 0, "2.02,9.01").otherwise("7.01")}
    one = F.sort_array(F.collect_list(F.struct("o_orderkey", *[v.alias(k) for k, v in cols.items()])))
    per = o.groupBy(F.col("o_custkey").cast("string").alias("cik")).agg(one.alias("r"))
    return per.select("cik", F.to_json(F.struct(F.struct(F.struct(*[F.col(f"r.{k}").alias(k) for k in cols]).alias("recent")).alias("filings"))).alias("payload"))


def a30_out(spark, d):
    out = payloads.explode_submissions(a30(spark, d))
    return out.select("cik", "form", F.datediff("filing_date", F.lit("1970-01-01").cast("date")).alias("filing_day"), us("accepted_ts", "accepted_us"), "accession", "items")


def a31(spark, d):
    s = views.table(spark, d, "supplier")
    x = F.struct(F.col("s_nationkey").cast("string").alias("cik_str"), F.lower("s_name").alias("ticker"), F.col("s_name").alias("title"))
    landed = s.groupBy("s_nationkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("s_suppkey").cast("string"), x)))).alias("payload")).select("payload")
    return payloads.explode_tickers(landed)


def _definitions(spark, d):
    p, k = views.table(spark, d, "part"), F.col("p_partkey")
    ns = F.lit(1704067200).cast("long") + (k % 40 - 5) * 86400
    return p.select(k.alias("instrument_id"), F.col("p_name").alias("raw_symbol"), F.element_at(F.lit(["C", "P", "M"]), (k % 3 + 1).cast("int")).alias("instrument_class"), (F.col("p_size").cast("long") * 1_000_000_005).alias("strike_price"), (ns * 1_000_000_000).alias("expiration"), F.when(k % 4 != 0, F.lit(100)).alias("contract_multiplier"))


def _statistics(spark, d):
    li = views.table(spark, d, "lineitem")
    ns = (F.lit(1704067200).cast("long") - (F.col("l_orderkey") % 12) * 86400) * 1_000_000_000
    return li.select(F.col("l_partkey").alias("instrument_id"), F.when(F.col("l_linenumber") % 2 == 0, F.lit(9)).otherwise(3).alias("stat_type"), F.when(F.col("l_orderkey") % 5 == 0, F.lit(0).cast("long")).otherwise(ns).alias("ts_ref"), ns.alias("ts_event"), F.col("l_quantity").cast("long").alias("quantity"))


def _prices(spark, d):
    p = views.table(spark, d, "part")
    price = (F.col("p_retailprice") * 100).cast("long") * 10_000_000
    return p.select(F.col("p_partkey").alias("instrument_id"), (F.lit(1704067200).cast("long") * 1_000_000_000).alias("ts_event"), (price + 10_000_000).alias("high"), (price - 30_000_000).alias("low"))


def c6(spark, d):
    f = options.gamma_flow_frame(options.normalize_option_chain(_definitions(spark, d), "SPX"), options.normalize_open_interest(_statistics(spark, d)), options.normalize_option_mid(_prices(spark, d)), 4800.25, "2024-01-01", "2024-01-01", 1)
    return f.select("instrument_id", "option_type", F.col("strike").cast("double").alias("strike"), F.round("tte_years", 8).alias("tte_years"), "open_interest", F.col("mid").cast("double").alias("mid"), "contract_multiplier", "exercise_style")


def _requests(spark, d):
    o, k = views.table(spark, d, "orders"), F.col("o_orderkey")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))
    start = F.date_add(F.col("o_orderdate").cast("date"), 9000)
    return o.select(
        k.alias("request_id"), pick(["tradestation", "OANDA", "binance", "databento", "fred", "alpaca"], k).alias("provider"), pick(["SPY", "AGG", "EUR_USD", "@MBT", "MSFT"], k).alias("symbol"), pick([None, "option", "index_recon_book", "short_interest_book", "future", "month_end_book"], F.floor(k / 6)).alias("asset_class"),
        pick(["1d", "1m"], F.floor(k / 3)).alias("timeframe"), pick(["bars", "bar_coverage"], F.floor(k / 5)).alias("data_kind"), F.when(k % 17 != 0, start).alias("start"), F.date_add(start, (k % 90).cast("int") - 5).alias("end"),
        pick(["discovery", "validation", "characterization", "forward_accrual", "dev_smoke", "other", None], F.floor(k / 7)).alias("purpose"), pick(["arm1", "arm2", ""], F.floor(k / 11)).alias("arm_id"), (k % 13 == 0).alias("final_portfolio_review"), F.concat(F.lit("s"), F.floor(k / 100) % 3).alias("session_id"), F.timestamp_seconds(k).alias("ts"),
    )


def j2(spark, d):
    return governance.decide_reads(_requests(spark, d), governance.campaign_ledger(spark)).select("request_id", "dataset", "reason", "allowed")


def j2_uniform(spark, d):
    """Reads decided by the ledger whose datasets share their windows."""
    return governance.decide_reads(_requests(spark, d), governance.uniform_ledger(spark)).groupBy("dataset", "allowed").agg(F.count("*").alias("n"), F.min("request_id").alias("first"), F.max("request_id").alias("last"))


def h4_fomc(spark, d):
    """Events on the days of scheduled statements, by whether they come before it."""
    e = views.ticks(spark, d).select("event_id", "timestamp", F.to_date(F.from_utc_timestamp("timestamp", calendar.NEW_YORK)).alias("announcement_date"))
    o = views.table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), (F.col("o_orderdate").cast("timestamp") + F.expr("interval 7305 days 19 hours")).alias("timestamp"))
    o = o.withColumn("announcement_date", F.to_date(F.from_utc_timestamp("timestamp", calendar.NEW_YORK)))
    both = e.unionByName(o).join(F.broadcast(calendar.fomc(spark, "2015-01-01", "2022-12-31")), "announcement_date")
    return both.select("event_id", us("timestamp", "ts_us"), us("announcement_utc", "announced_us"), (F.col("timestamp") < F.col("announcement_utc")).alias("before"))


def j3(spark, d):
    r = governance.decide_reads(_requests(spark, d), governance.campaign_ledger(spark)).where("dataset is not null")
    early = F.substring("session_id", 2, 1) == "0"  # the first session's reads are in the log already
    return governance.check_validation_reuse(r.where(~early), r.where(early)).select("request_id", "dataset", "arm_id", "session_id", "reused")


def j5(spark, d):
    r = governance.decide_reads(_requests(spark, d), governance.campaign_ledger(spark))
    return governance.citable_windows(governance.usage_entries(r, "v"), "arm1", "oanda_fx")


def _cal(spark):
    return calendar.sessions(spark, "2023-12-01", "2024-03-31")


def c9(spark, d):
    e = views.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("accepted_ts"))
    out = calendar.event_clock(e, _cal(spark))
    return out.select("event_id", F.datediff("session_date", F.lit("1970-01-01").cast("date")).alias("session_day"), "session_bucket", us("event_time", "event_us"), us("reaction_end", "reaction_us"), F.size("decision_times").alias("n_decisions"))


def c10(spark, d):
    e = views.ticks(spark, d).select("event_id", F.col("timestamp").alias("close_ts"), (F.col("timestamp") + F.make_interval(hours=(F.col("event_id") % 90).cast("int"))).alias("open_ts"))
    return calendar.classify_closed_gap(e, _cal(spark)).select("event_id", "gap_class")


def h1(spark, d):
    e = views.ticks(spark, d).select("event_id", F.col("timestamp").alias("end"), (F.col("event_id") % 800 + 1).alias("n"))
    return calendar.trading_minutes_window(e, _cal(spark)).select("event_id", us("start", "start_us"))


def h2(spark, d):
    e = views.ticks(spark, d).select("event_id", F.col("timestamp").alias("end"), (F.col("event_id") % 800 + 1).alias("n"))
    return calendar.extended_minutes_window(e, _cal(spark)).select("event_id", us("start", "start_us"))


def h3(spark, d):
    e = views.ticks(spark, d).select("event_id", F.col("timestamp").alias("end"), (F.col("event_id") % 9 + 1).alias("n"))
    return calendar.sessions_window(e, _cal(spark)).select("event_id", us("start", "start_us"))


def h5(spark, d):
    e = views.table(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("settlement_date"))
    return calendar.dissemination_date(e, _cal(spark)).select("event_id", F.datediff("dissemination_date", F.lit("1970-01-01").cast("date")).alias("day"))


def b8(spark, d):
    out = calendar.tag_fx_sessions(views.ticks(spark, d))
    return out.select("event_id", F.datediff("session_date", F.lit("1970-01-01").cast("date")).alias("session_day"), "in_asian_window", "in_london_open_window", "is_post_open")


def b10(spark, d):
    dates = views.ticks(spark, d).select(calendar.fx_session_date(F.col("timestamp")).alias("session_date")).distinct()
    return calendar.fx_windows(dates).select(F.datediff("session_date", F.lit("1970-01-01").cast("date")).alias("day"), us("asian_start", "asian_us"), us("london_open", "open_us"), us("window_end", "end_us"))


def b13(spark, d):
    e = views.ticks(spark, d)
    return e.select("event_id", F.round(calendar.closed_hours(F.col("timestamp"), F.col("timestamp") + F.make_interval(mins=(F.col("event_id") % 5000).cast("int"))), 6).alias("hours"))


QUERIES = {
    "a9_oanda": a9, "a10_binance": a10, "a11_coinbase": a11, "a12_polygon": a12, "a13_alpaca": a13, "a14_tradestation": a14, "a15_fred": a15,
    "a16_q9_bars": lambda s, d: _out(payloads.normalize_q9(_q9_records(s, d))[0]),
    "a16_q9_excluded": lambda s, d: payloads.normalize_q9(_q9_records(s, d))[1],
    "a18_symbology": a18, "a21_quotes": a21, "a22_instruments": a22, "a23_standardize": a23, "a25_corporate_actions": a25, "a29_companyfacts": a29, "a30_submissions": a30_out, "a31_tickers": a31,
    "a32_option_chain": lambda s, d: options.normalize_option_chain(_definitions(s, d), "SPX").select("instrument_id", "option_type", F.col("strike").cast("double").alias("strike"), F.datediff("expiration", F.lit("1970-01-01").cast("date")).alias("expiration_day"), "contract_multiplier", "exercise_style"),
    "a33_open_interest": lambda s, d: options.normalize_open_interest(_statistics(s, d)).select("instrument_id", F.datediff("oi_as_of", F.lit("1970-01-01").cast("date")).alias("day"), "open_interest"),
    "a34_option_mid": lambda s, d: options.normalize_option_mid(_prices(s, d)).select("instrument_id", F.col("mid").cast("double").alias("mid")),
    "d21_latest_oi": lambda s, d: options.latest_open_interest(options.normalize_open_interest(_statistics(s, d)), "2024-01-01", 1).select("instrument_id", F.datediff("oi_as_of", F.lit("1970-01-01").cast("date")).alias("day"), "open_interest"),
    "c6_gamma_flow": c6, "j2_decide_reads": j2, "j2_uniform_ledger": j2_uniform, "h4_fomc": h4_fomc, "j3_validation_reuse": j3, "j5_citable_windows": j5,
    "b8_fx_sessions": b8, "b10_fx_windows": b10, "b13_closed_hours": b13,
    "b5_symbols": lambda s, d: views.table(s, d, "events").select("event_id", *[payloads.normalize_symbol(F.concat_ws("_", "event_type", F.lit("usd")), v).alias(v) for v in ("coinbase", "binance", "alpaca")]),
    "b9_fx_week": lambda s, d: views.ticks(s, d).select("event_id", calendar.is_fx_trading_week(F.col("timestamp")).alias("open")),
    "c9_event_clock": c9, "c10_closed_gap": c10, "h1_trading_minutes": h1, "h2_extended_minutes": h2, "h3_sessions_back": h3, "h5_dissemination": h5,
}

_DEF = "with c as (select p_partkey as instrument_id, ['C', 'P', 'M'][1 + p_partkey % 3] as t, p_size::bigint * 1000000005 as q, (1704067200 + (p_partkey % 40 - 5) * 86400) // 86400 as e, case when p_partkey % 4 <> 0 then 100 else 0 end as m from part)"
_OI = "o as (select l_partkey as instrument_id, (1704067200 - (l_orderkey % 12) * 86400) // 86400 as day, l_quantity::bigint as oi from lineitem where l_linenumber % 2 = 0)"
_LATEST = f"{_OI}, k as (select * from o where day between 19722 - 7 and 19722 qualify row_number() over (partition by instrument_id order by day desc, oi desc) = 1)"
_STRIKE = "((q // 10 + case when q % 10 > 5 or (q % 10 = 5 and (q // 10) % 2 = 1) then 1 else 0 end) / 100000000.0::double)"
_SESSIONS = """sess as (select d::date as day, row_number() over (order by d) - 1 as no,
    timezone('UTC', timezone('America/New_York', d + interval 570 minute)) as o, timezone('UTC', timezone('America/New_York', d + interval 960 minute)) as c
  from (select unnest(generate_series(timestamp '2023-12-01', timestamp '2024-03-31', interval 1 day)) as d) where isodow(d) < 6 and d::date not in (date '2023-12-25', date '2024-01-01', date '2024-01-15', date '2024-02-19', date '2024-03-29'))"""
_NY = lambda c: f"timezone('America/New_York', timezone('UTC', {c}))"
_LONDON = "timezone('Europe/London', timezone('UTC', ts))"
_REQ = """r as (select o_orderkey as k, lower(['tradestation', 'OANDA', 'binance', 'databento', 'fred', 'alpaca'][1 + o_orderkey % 6]) as p, ['SPY', 'AGG', 'EUR_USD', '@MBT', 'MSFT'][1 + o_orderkey % 5] as s,
   [null, 'option', 'index_recon_book', 'short_interest_book', 'future', 'month_end_book'][1 + (o_orderkey // 6) % 6] as a, ['1d', '1m'][1 + (o_orderkey // 3) % 2] as tf, ['bars', 'bar_coverage'][1 + (o_orderkey // 5) % 2] as dk,
   case when o_orderkey % 17 <> 0 then o_orderdate::date + 9000 end as st, o_orderdate::date + 9000 + (o_orderkey % 90)::int - 5 as en, ['discovery', 'validation', 'characterization', 'forward_accrual', 'dev_smoke', 'other', null][1 + (o_orderkey // 7) % 7] as pu,
   ['arm1', 'arm2', ''][1 + (o_orderkey // 11) % 3] as arm, o_orderkey % 13 = 0 as fin, 's' || (o_orderkey // 100) % 3 as sess from orders),
 routed as (select *, case when p = 'tradestation' and (a = 'future' or s = '@MBT') then 'tradestation_crypto_futures' when p = 'tradestation' and a = 'month_end_book' and s in ('SPY', 'AGG') then 'month_end_spy_agg' when p = 'tradestation' and a = 'index_recon_book' then 'index_recon_sp500'
   when p = 'tradestation' and a = 'short_interest_book' then 'short_interest_bar_coverage' when p = 'tradestation' and s = 'SPY' then 'spy_qqq_ladder_tradestation' when p = 'tradestation' then 'tradestation_cohort_1m' when p = 'oanda' then 'oanda_fx' when p = 'binance' then 'binance_spot'
   when p = 'databento' and a = 'option' then 'databento_opra_options' when p = 'databento' and a = 'index_recon_book' then 'index_recon_sp500' when p = 'databento' then 'databento_extended_hours' when p = 'alpaca' and a = 'index_recon_book' then 'index_recon_sp500' end as ds from r),
 l(ds, y) as (values ('spy_qqq_ladder_tradestation', 2015), ('month_end_spy_agg', 2017), ('index_recon_sp500', 2017), ('tradestation_cohort_1m', 2019), ('oanda_fx', 2020), ('binance_spot', 2020), ('coinbase_spot', 2020), ('tradestation_crypto_futures', 2022)),
 j as (select routed.*, case when y is not null then make_date(y, 1, 1) end as d0, case when y is not null then date '2024-12-31' end as d1, case when y is not null then date '2025-01-01' end as v0, case when y is not null then date '2025-12-31' end as v1, case when y is not null then date '2026-01-01' end as lb,
   routed.ds = 'short_interest_bar_coverage' as si, routed.ds = 'databento_extended_hours' as eh, y is not null or routed.ds in ('short_interest_bar_coverage', 'databento_extended_hours') as known from routed left join l on l.ds = routed.ds),
 dec as (select *, case when a = 'short_interest_book' and p <> 'tradestation' then 'short_interest_provider' when a = 'short_interest_book' and pu is null then 'short_interest_purpose' when a = 'short_interest_book' and dk <> 'bar_coverage' then 'short_interest_kind' when a = 'short_interest_book' and tf <> '1d' then 'short_interest_timeframe'
   when pu is not null and a = 'index_recon_book' and dk = 'bars' and tf <> '1d' then 'index_recon_timeframe' when pu is null then 'ungoverned' when arm = '' then 'arm_required' when ds is null then 'ungoverned' when pu = 'other' then 'unknown_purpose' when st is null then 'missing_bounds' when st > en then 'start_after_end' when not known then 'unknown_dataset'
   when pu = 'dev_smoke' then 'allowed' when si and pu <> 'characterization' then 'purpose_not_admitted' when eh and pu not in ('characterization', 'forward_accrual') then 'purpose_not_admitted' when fin and en >= lb and st < lb then 'review_crosses_lockbox' when fin and en >= lb then 'allowed' when en >= lb then 'lockbox'
   when pu = 'discovery' and d0 is null then 'no_window' when pu = 'discovery' and (st < d0 or en > d1) then 'outside_window' when pu = 'validation' and v0 is null then 'no_window' when pu = 'validation' and (st < v0 or en > v1) then 'outside_window'
   when pu = 'characterization' and not (si or eh) then 'purpose_not_admitted' when pu = 'characterization' and (st < case when si then date '2021-06-15' else date '2023-01-01' end or en > date '2025-12-31') then 'outside_window'
   when pu = 'forward_accrual' and not eh then 'no_window' when pu = 'forward_accrual' and st < date '2026-01-01' then 'outside_window' else 'allowed' end as reason from j)"""
_UNIFORM_REQ = re.sub(r"l\(ds, y\) as \(values .*?\)\),", "l(ds, y) as (values ('spy_qqq_ladder_tradestation', 2020), ('tradestation_cohort_1m', 2020), ('oanda_fx', 2020), ('coinbase_spot', 2020), ('databento_extended_hours', 2020), ('databento_opra_options', 2020), ('fred_macro', 2020)),", _REQ)
for _special in ("short_interest_bar_coverage' as si", "databento_extended_hours' as eh"):
    _UNIFORM_REQ = _UNIFORM_REQ.replace(f"routed.ds = '{_special}", f"false as {_special[-2:]}")
_UNIFORM_REQ = _UNIFORM_REQ.replace("y is not null or routed.ds in ('short_interest_bar_coverage', 'databento_extended_hours') as known", "y is not null as known")
ORACLE_SQL = {
    "a9_oanda": f"with {BARS_SQL} select {_BARS_OUT} from bars where minute(ts) % 10 <> 0",
    "a10_binance": f"with {BARS_SQL} select {_BARS_OUT} from bars", "a12_polygon": f"with {BARS_SQL} select {_BARS_OUT} from bars", "a13_alpaca": f"with {BARS_SQL} select {_BARS_OUT} from bars",
    "a11_coinbase": f"with {BARS_SQL} select {_BARS_OUT} from bars where ts between timestamp '2024-01-05' and timestamp '2024-01-20'",
    "a14_tradestation": f"with {BARS_SQL} select {_BARS_OUT.replace('volume::double', '(case when minute(ts) % 3 <> 0 then volume else 0 end)::double')} from bars where ts >= timestamp '2024-01-10'",
    "a15_fred": "select o_orderpriority as symbol, epoch_us(o_orderdate::date::timestamp) as ts_us, o_totalprice as open, o_totalprice as high, o_totalprice as low, o_totalprice as close, 0.0::double as volume from orders where o_orderkey % 4 <> 0 and o_orderkey % 9 <> 0",
    "a16_q9_bars": f"with {BARS_SQL} select {_BARS_OUT} from bars where minute(ts) % 13 <> 0",
    "a16_q9_excluded": f"with {BARS_SQL} select symbol, count(*) as excluded from bars where minute(ts) % 13 = 0 group by symbol",
    "a18_symbology": f"with {views.SYMBOLOGY_SQL} select raw_symbol, instrument_id, date_diff('day', date '1970-01-01', valid_from)::int as from_day, date_diff('day', date '1970-01-01', valid_to)::int as to_day from symbology where instrument_id % 5 <> 0",
    "a21_quotes": f"with {BARS_SQL} select symbol, close::double as last, high::double as high, low::double as low, open::double as previous_close, volume::double as volume from bars where minute(ts) % 7 <> 0",
    "a22_instruments": "select p_name as symbol, p_type as name, 'us_equity' as asset_class, p_brand as exchange from part where p_partkey % 3 <> 0",
    "a23_standardize": "select 'P_' || p_partkey || '_X' as symbol, 'P/' || p_partkey || '_X' as name, 'vendor' as provider, 'stocks' as asset_class, p_brand from part",
    "a25_corporate_actions": "select o_orderpriority as corporate_action_type, o_orderkey as id from orders",
    "a29_companyfacts": f"with {views.FACTS_SQL} select cik, 'us-gaap' as taxonomy, tag, unit, date_diff('day', date '1970-01-01', \"end\")::int as end_day, date_diff('day', date '1970-01-01', filed)::int as filed_day, val from facts",
    "a30_submissions": "select o_custkey::varchar as cik, case when o_orderkey % 2 = 0 then '8-K' else '10-Q' end as form, date_diff('day', date '1970-01-01', o_orderdate::date)::int as filing_day, epoch_us(o_orderdate::date::timestamp + interval 750 minute) as accepted_us, lpad(o_orderkey::varchar, 10, '0') as accession, case when o_orderkey % 4 = 0 then '2.02,9.01' else '7.01' end as items from orders",
    "a31_tickers": "select distinct lpad(s_nationkey::varchar, 10, '0') as cik, upper(s_name) as ticker from supplier",
    "a32_option_chain": f"{_DEF} select instrument_id, t as option_type, {_STRIKE}::double as strike, e::int as expiration_day, m::int as contract_multiplier, 'E' as exercise_style from c where t <> 'M'",
    "a33_open_interest": f"with {_OI} select instrument_id, day::int as day, oi as open_interest from o",
    "a34_option_mid": "select p_partkey as instrument_id, ((p_retailprice * 100)::bigint - 1) / 100.0::double as mid from part",
    "d21_latest_oi": f"with {_LATEST} select instrument_id, day::int as day, oi as open_interest from k",
    "c6_gamma_flow": f"{_DEF}, {_LATEST} select c.instrument_id, t as option_type, {_STRIKE}::double as strike, round((e - 19723) / 365.25::double, 8) as tte_years, oi as open_interest, ((p_retailprice * 100)::bigint - 1) / 100.0::double as mid, m::int as contract_multiplier, 'E' as exercise_style from c join k using (instrument_id) join part on p_partkey = c.instrument_id where t <> 'M' and e > 19723",
    "j2_decide_reads": f"with {_REQ} select k as request_id, ds as dataset, reason, reason in ('allowed', 'ungoverned') as allowed from dec",
    "j2_uniform_ledger": f"with {_UNIFORM_REQ} select ds as dataset, reason in ('allowed', 'ungoverned') as allowed, count(*) as n, min(k) as first, max(k) as last from dec group by all",
    "h4_fomc": f"""with e as (select event_id, ts from events union all select o_orderkey, o_orderdate + interval 7305 day + interval 19 hour from orders),
      f as (select d::date as day, timezone('UTC', timezone('America/New_York', d::date + interval 14 hour)) as said from (select unnest({calendar.FOMC}) as d))
      select event_id, epoch_us(ts) as ts_us, epoch_us(said) as announced_us, ts < said as before from e join f on {_NY('ts')}::date = f.day""",
    "j3_validation_reuse": f"with {_REQ}, v as (select *, first_value(sess) over (partition by ds, arm order by k) as f from dec where ds is not null and pu = 'validation') select k as request_id, ds as dataset, arm as arm_id, sess as session_id, sess <> f as reused from v where sess <> 's0'",
    "j5_citable_windows": f"with {_REQ} select strftime(st, '%Y-%m-%d') as start, strftime(en, '%Y-%m-%d') as \"end\" from dec where reason = 'allowed' and ds = 'oanda_fx' and arm = 'arm1' and pu in ('discovery', 'validation', 'characterization', 'forward_accrual')",
    "b5_symbols": "select event_id, upper(event_type) || '-USD' as coinbase, replace(upper(event_type), '_', '') || 'USD' as binance, upper(event_type) || '_USD' as alpaca from events",
    "b8_fx_sessions": f"select event_id, date_diff('day', date '1970-01-01', ({_LONDON})::date)::int as session_day, hour({_LONDON}) < 8 as in_asian_window, hour({_LONDON}) = 8 and minute({_LONDON}) < 15 as in_london_open_window, hour({_LONDON}) >= 8 as is_post_open from events",
    "b9_fx_week": f"with t as (select event_id, {_NY('ts')} as l from events) select event_id, case isodow(l) when 6 then false when 7 then hour(l) >= 17 when 5 then hour(l) < 17 else true end as open from t",
    "b10_fx_windows": f"with d as (select distinct ({_LONDON})::date as day from events), u as (select day, timezone('UTC', timezone('Europe/London', day::timestamp)) as a, timezone('UTC', timezone('Europe/London', day + interval 480 minute)) as o, timezone('UTC', timezone('Europe/London', day + interval 495 minute)) as e from d) select date_diff('day', date '1970-01-01', day)::int as day, epoch_us(a) as asian_us, epoch_us(o) as open_us, epoch_us(e) as end_us from u",
    "b13_closed_hours": "select event_id, round((event_id % 5000) / 60.0::double, 6) as hours from events",
    "c9_event_clock": f"with {_SESSIONS}, e as (select event_id, ts, ({_NY('ts')})::date as ld from events), x as (select e.*, s.o, s.c, s.day as sday, (select min(n.day) from sess n where n.day > e.ld) as nday from e left join sess s on s.day = e.ld), y as (select x.*, n.o as no, case when sday is null then 'non_session' when ts < x.o then 'before_open' when ts < x.c then 'in_hours' else 'after_close' end as b from x join sess n on n.day = x.nday), z as (select *, case b when 'in_hours' then ts when 'before_open' then o else no end as et, case when b in ('in_hours', 'before_open') then sday else nday end as sd from y) select event_id, date_diff('day', date '1970-01-01', sd)::int as session_day, b as session_bucket, epoch_us(et) as event_us, epoch_us(et) + 300000000 as reaction_us, 3::int as n_decisions from z",
    "c10_closed_gap": f"with {_SESSIONS}, e as (select event_id, ts as a, ts + to_hours(event_id % 90) as b from events), x as (select e.*, (select max(day) from sess where o <= e.a) as ca, (select min(day) from sess where c > e.b) as ob from e), y as (select *, date_diff('day', ca, ob) as n, (select count(*) from sess where day > ca and day < ob) as inner_s, (select count(*) from (select unnest(generate_series(1, date_diff('day', ca, ob) - 1)) as i) where isodow(ca + i::int) > 5) as we from x) select event_id, case when ca = ob then 'halt_reopen' when n = 1 then 'weeknight' when inner_s > 0 then 'long_holiday' when we > 0 and we < n - 1 then 'long_holiday' when we > 0 then 'weekend' else 'pre_holiday' end as gap_class from y",
    "h3_sessions_back": f"with {_SESSIONS}, e as (select event_id, ts, event_id % 9 + 1 as n from events), x as (select e.*, (select max(no) from sess where o < e.ts) as last from e) select event_id, epoch_us(s.o) as start_us from x left join sess s on s.no = x.last - x.n + 1",
    "h5_dissemination": f"with {_SESSIONS}, x as (select event_id, (select max(no) from sess where day <= events.ts::date) + 7 as no from events) select event_id, date_diff('day', date '1970-01-01', s.day)::int as day from x join sess s using (no)",
    "h1_trading_minutes": f"with {_SESSIONS}, m as (select o + to_minutes(i) as t, row_number() over (order by o + to_minutes(i)) as k from (select o, unnest(generate_series(0, 389)) as i from sess)), e as (select event_id, date_trunc('minute', ts) as t, event_id % 800 + 1 as n from events), x as (select e.*, (select k from m where m.t < e.t order by k desc limit 1) as last from e) select event_id, epoch_us(m.t) as start_us from x left join m on m.k = x.last - x.n + 1",
    "h2_extended_minutes": f"with {_SESSIONS}, m as (select o - interval 330 minute + to_minutes(i) as t, row_number() over (order by o + to_minutes(i)) as k from (select o, unnest(generate_series(0, 959)) as i from sess)), e as (select event_id, date_trunc('minute', ts) as t, event_id % 800 + 1 as n from events), x as (select e.*, (select k from m where m.t < e.t order by k desc limit 1) as last from e) select event_id, epoch_us(m.t) as start_us from x left join m on m.k = x.last - x.n + 1",
}
