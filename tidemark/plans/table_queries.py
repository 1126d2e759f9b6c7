"""Queries over sinks and sources on disk, calendar dimensions and single rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import calendar, compare, filings, governance, quality, rollup, universe
from tidemark.plans import bar_queries, flow_queries, vendor_queries, views
from tidemark.plans.views import BARS_SQL, us
from tidemark.session import workdir
from tidemark.sources import payloads, tables

_EPOCH = lambda c, name: F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).alias(name)


def a2(spark, d):
    path, _ = flow_queries._stored(spark, d)
    return tables.list_series(tables.bar_table(spark, path), "vendor")


def a5(spark, d):
    path, staging = flow_queries._stored(spark, d)
    again = tables.bar_table(spark, path).where("symbol = 'click' and hour(timestamp) < 3")
    tables.write_bars(again, path, f"{staging}/3", "overwrite")
    return tables.bar_table(spark, path).select("symbol", us("timestamp", "ts_us"))


def a8(spark, d):
    b = rollup.to_bars(views.bars_1m(spark, d))
    return b.select(us("timestamp", "ts_us"), *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")])


def a19(spark, d):
    s, path = views.table(spark, d, "supplier"), workdir(spark, "short-interest")
    k = F.col("s_suppkey")
    values = {"symbolCode": F.col("s_name"), "issueName": F.concat(F.lit("Issue "), k), "marketClassCode": F.lit("NYSE"), "currentShortPositionQuantity": k * 100, "previousShortPositionQuantity": F.when(k % 5 == 0, "bad").otherwise((k * 90).cast("string")), "averageDailyVolumeQuantity": k, "daysToCoverQuantity": F.when(k % 3 == 0, "N/A").otherwise((k / 4).cast("string")), "revisionFlag": F.lit("R"), "changePercent": k / 8, "changePreviousNumber": k * 10}
    s.select(*[v.cast("string").alias(n) for n, v in values.items()], F.lit("x").alias("unused")).write.option("sep", "|").option("header", True).csv(path)
    out = tables.normalize_short_interest(spark, path, "2024-12-31", "2025-01-13")
    return out.select("symbol", "issue_name", "short_interest", "prev_short_interest", "avg_daily_volume", "days_to_cover", "change_pct", "change_shares", _EPOCH("dissemination_date", "day"), (F.length("source_sha256") == 64).alias("has_digest"))


def a20(spark, d):
    path = workdir(spark, "snapshots")
    views.snapshots(spark, d).select("date", F.array_join("tickers", " , ").alias("tickers")).write.option("header", True).csv(path)
    return tables.read_membership_snapshots(spark, path).select(_EPOCH("date", "day"), F.array_join("tickers", ",").alias("tickers"))


def a26(spark, d):
    o = views.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("ex_date"), F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("factor"))
    return payloads.normalize_reference(o, "ex_date", "1996-03-01", "1997-02-28")


def a27(spark, d):
    path, aligned = workdir(spark, "export"), bar_queries.c1(spark, d)
    compare.export_comparison(aligned, path, "csv")
    return spark.read.option("header", True).schema(aligned.schema).csv(path).select(us("timestamp", "ts_us"), F.round("close_diff", 6).alias("close_diff"))


def a28(spark, d):
    root, n = workdir(spark, "tables"), views.table(spark, d, "nation")
    for _ in range(2):
        for kind in ("quotes", "fundamentals"):
            tables.write_table(n, root, kind)
    both = spark.read.parquet(f"{root}/quotes").withColumn("kind", F.lit("quotes")).unionByName(spark.read.parquet(f"{root}/fundamentals").withColumn("kind", F.lit("fundamentals")))
    return both.groupBy("kind", "n_name").agg(F.count("*").alias("n"))


def b3(spark, d):
    e = views.table(spark, d, "events").select("event_id", F.col("ts").alias("timestamp"))
    return rollup.to_utc(e).select("event_id", us("timestamp", "ts_us"))


def b4(spark, d):
    return rollup.with_metadata(views.table(spark, d, "events").select("event_id"), "EUR_USD", "vendor", "forex")


def f5(spark, d):
    o = views.table(spark, d, "orders")
    day = F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    none = F.lit(None).cast("string")
    a = o.select(F.col("o_custkey").cast("string").alias("accession"), F.lit("cash_dividend").alias("corporate_action_type"), day.alias("ex_date"), *[none.alias(c) for c in ("effective_date", "record_date", "payment_date", "distribution_date")], F.lit(None).cast("int").alias("split_ratio_from"), F.lit(None).cast("int").alias("split_ratio_to"), (F.col("o_orderkey") % 3).cast("string").alias("cash_amount"))
    return filings.dedup_actions(a, ["accession"]).select("accession", "ex_date", "cash_amount")


def h0(spark, d):
    days = views.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("session_date")).distinct()
    cal = calendar.sessions(spark, "1995-01-01", "2001-08-31")
    return days.join(F.broadcast(cal), "session_date").select(_EPOCH("session_date", "day"), ((F.unix_seconds("close_ts") - F.unix_seconds("open_ts")) / 60).cast("int").alias("minutes"), F.hour(F.from_utc_timestamp("open_ts", calendar.NEW_YORK)).alias("open_hour"))


def h6(spark, d):
    cal = calendar.sessions(spark, "1996-01-01", "1999-12-31")
    days = calendar.settlement_dates(cal, "1996-01-01", "1999-12-31")
    o = views.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("settlement_date"))
    return o.join(F.broadcast(days), "settlement_date").groupBy(_EPOCH("settlement_date", "day")).agg(F.count("*").alias("n"))


def i10(spark, d):
    o = views.table(spark, d, "orders")
    iso = lambda n: F.date_format(F.date_add(F.col("o_orderdate").cast("date"), n), "yyyy-MM-dd")
    none = F.lit(None).cast("string")
    a = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, iso(10)).alias("ex_date"), none.alias("effective_date"), iso(20).alias("record_date"), iso(40).alias("payment_date"), none.alias("distribution_date"), iso(0).alias("filing_date"))
    return filings.range_match_basis(a, "1997-01-01", "1997-03-31").select("o_orderkey", "match_basis")


def j1(spark, d):
    r = vendor_queries._requests(spark, d)
    return r.select("request_id", governance.route_dataset(F.col("provider"), F.col("symbol"), F.col("asset_class")).alias("dataset"))


def j4(spark, d):
    path = workdir(spark, "usage")
    governance.append_usage_log(governance.decide_reads(vendor_queries._requests(spark, d), governance.campaign_ledger(spark)), "intraday_campaign_v1.3", path)
    log = spark.read.schema("ts string, session_id string, ledger_version string, dataset string, start string, end string, purpose string, arm_id string, final_portfolio_review boolean").json(path)
    return log.drop("ts")


def f3(spark, d):
    o = views.table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return quality.last_n(o, ["o_custkey"], "o_orderkey", 3)


def c2(spark, d):
    hourly, _ = quality.normalize_hourly(rollup.aggregate_bars(views.bars_1m(spark, d), "1h"))
    return hourly.groupBy("symbol").agg(F.count("*").alias("hours"), F.count_if("is_synthetic_bar").alias("synthetic"))


def c11(spark, d):
    out = governance.decide_reads(vendor_queries._requests(spark, d), governance.campaign_ledger(spark))
    return out.where("reason in ('outside_window', 'no_window', 'lockbox')").groupBy("dataset", "reason").agg(F.count("*").alias("n"))


def g7(spark, d):
    b = views.bars_1m(spark, d)
    newer = b.where(F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp")).withColumn("volume", F.col("volume") + 1)
    return rollup.splice_history(b.where("symbol <> 'view'").drop("open"), newer).select("symbol", us("timestamp", "ts_us"), F.col("open").cast("double").alias("open"), "volume")


QUERIES = {
    "b11_fx_session_date": lambda s, d: views.ticks(s, d).select("event_id", F.datediff(calendar.fx_session_date(F.col("timestamp")), F.lit("1970-01-01").cast("date")).alias("day")),
    "c2_hourly_grid": c2, "c11_windows": c11, "g7_splice_history": g7,
    "g2_filter_universe": lambda s, d: universe.filter_universe(views.reference(s, d), "security_type in ('STANDARD', 'PROMO') and dollar_volume_20d < 10000"),
    "a2_list_series": a2, "a5_overwrite_bars": a5, "a8_to_bars": a8, "a19_short_interest": a19, "a20_membership_snapshots": a20, "a26_reference": a26, "a27_export": a27, "a28_write_table": a28, "b3_to_utc": b3, "b4_metadata": b4,
    "f3_last_n": f3, "f5_dedup_actions": f5, "h0_sessions": h0, "h6_settlement_dates": h6, "i10_match_basis": i10, "j1_route_dataset": j1, "j4_usage_log": j4,
    "j6_asset_rules": lambda s, d: governance.asset_class_rules(vendor_queries._requests(s, d)).select("request_id", "rule"),
}

# Closed days of 1995 to 2001 without a rule by month and weekday: Good Fridays, and four days of September 2001.
_OTHER_CLOSED = "date '1995-04-14', date '1996-04-05', date '1997-03-28', date '1998-04-10', date '1999-04-02', date '2000-04-21', date '2001-04-13', date '2001-09-11', date '2001-09-12', date '2001-09-13', date '2001-09-14'"


def _closed(d):
    """The exchange's holidays as rules on a date, stated apart from the operator that the SQL checks."""
    on = lambda m, day: f"(month({d}) = {m} and (day({d}) = {day} or day({d}) = {day + 1} and isodow({d}) = 1 or {'true' if m > 1 else 'false'} and day({d}) = {day - 1} and isodow({d}) = 5))"
    nth = lambda m, weekday, first: f"(month({d}) = {m} and isodow({d}) = {weekday} and day({d}) between {first} and {first + 6})"
    return "(" + " or ".join([on(1, 1), nth(1, 1, 15), nth(2, 1, 15), nth(5, 1, 25), on(7, 4), nth(9, 1, 1), nth(11, 4, 22), on(12, 25), f"{d} in ({_OTHER_CLOSED})"]) + ")"


def _early(d):
    """Days that close at 13:00: after Thanksgiving, and Monday to Thursday before the Fourth of July and Christmas."""
    return f"(month({d}) = 11 and isodow({d}) = 5 and day({d}) between 23 and 29 or isodow({d}) < 5 and (month({d}) = 7 and day({d}) = 3 or month({d}) = 12 and day({d}) = 24))"
_DAYS = lambda c: f"date_diff('day', date '1970-01-01', {c})::int"
ORACLE_SQL = {
    "b11_fx_session_date": f"select event_id, {_DAYS('(' + vendor_queries._LONDON + ')::date')} as day from events",
    "c2_hourly_grid": f"with {BARS_SQL}, h as (select distinct symbol, date_trunc('hour', ts) as ts from bars), g as (select symbol, unnest(generate_series(min(ts), max(ts), interval 1 hour)) as ts from h group by symbol) select g.symbol, count(*) as hours, count(*) filter (h.ts is null) as synthetic from g left join h on h.symbol = g.symbol and h.ts = g.ts group by g.symbol",
    "c11_windows": f"with {vendor_queries._REQ} select ds as dataset, reason, count(*) as n from dec where reason in ('outside_window', 'no_window', 'lockbox') group by all",
    "g7_splice_history": f"with {BARS_SQL}, n as (select * from bars where ts >= timestamp '2024-01-10'), f as (select symbol, min(ts) as a from n group by symbol) select symbol, epoch_us(ts) as ts_us, open::double as open, volume + 1 as volume from n union all select b.symbol, epoch_us(ts), null, volume from bars b left join f on f.symbol = b.symbol where b.symbol <> 'view' and (a is null or ts < a)",
    "g2_filter_universe": "select distinct 'P' || p_partkey as symbol, true as pit from part where p_type in ('STANDARD', 'PROMO') and p_size * p_retailprice < 10000",
    "a2_list_series": f"with {BARS_SQL} select distinct 'vendor' as provider, symbol, '1m' as timeframe from bars",
    "a5_overwrite_bars": f"with {BARS_SQL} select symbol, epoch_us(ts) as ts_us from bars where symbol <> 'click' or hour(ts) < 3",
    "a8_to_bars": f"with {BARS_SQL} select epoch_us(ts) as ts_us, open::varchar as open, high::varchar as high, low::varchar as low, close::varchar as close, volume::decimal(18,2)::varchar as volume from bars",
    "a19_short_interest": "select s_name as symbol, 'Issue ' || s_suppkey as issue_name, s_suppkey * 100 as short_interest, case when s_suppkey % 5 <> 0 then s_suppkey * 90 end as prev_short_interest, s_suppkey as avg_daily_volume, case when s_suppkey % 3 <> 0 then s_suppkey / 4 end as days_to_cover, s_suppkey / 8 as change_pct, s_suppkey * 10 as change_shares, 20101::int as day, true as has_digest from supplier",
    "a20_membership_snapshots": f"with {views.SNAPSHOTS_SQL} select {_DAYS('date')} as day, array_to_string(tickers, ',') as tickers from snapshots",
    "a26_reference": "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as ex_date, case when o_orderkey % 3 <> 0 then o_totalprice end as factor from orders where o_orderdate::date between date '1996-03-01' and date '1997-02-28'",
    "a27_export": bar_queries._C1_SQL + " select epoch_us(ts) as ts_us, round(close_1 - close_2, 6) as close_diff from a",
    "a28_write_table": "select 'quotes' as kind, n_name, 2 * count(*) as n from nation group by n_name union all select 'fundamentals', n_name, count(*) from nation group by n_name",
    "b3_to_utc": "select event_id, epoch_us(ts) as ts_us from events",
    "b4_metadata": "select event_id, 'EUR_USD' as symbol, 'vendor' as provider, 'forex' as asset_class from events",
    "f3_last_n": "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) <= 3",
    "f5_dedup_actions": "with a as (select distinct o_custkey::varchar as accession, case when o_orderkey % 4 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end as ex_date, (o_orderkey % 3)::varchar as cash_amount from orders) select * from a where ex_date is not null or not exists (select 1 from a b where b.accession = a.accession and b.cash_amount = a.cash_amount and b.ex_date is not null)",
    "h0_sessions": f"select distinct {_DAYS('o_orderdate::date')} as day, case when {_early('o_orderdate::date')} then 210 else 390 end::int as minutes, 9::int as open_hour from orders where isodow(o_orderdate) < 6 and not {_closed('o_orderdate::date')}",
    "h6_settlement_dates": f"with s as (select d::date as day from (select unnest(generate_series(timestamp '1996-01-01', timestamp '1999-12-31', interval 1 day)) as d) where isodow(d) < 6 and not {_closed('d::date')}), m as (select max(day) filter (day(day) <= 15) as a, max(day) as b from s group by year(day), month(day)), x as (select a as day from m union select b from m) select {_DAYS('x.day')} as day, count(*) as n from orders join x on o_orderdate::date = x.day group by x.day",
    "i10_match_basis": "select o_orderkey, case when o_orderkey % 2 = 0 and o_orderdate::date + 10 between date '1997-01-01' and date '1997-03-31' then 'ex_date' when o_orderdate::date + 20 between date '1997-01-01' and date '1997-03-31' then 'record_date' when o_orderdate::date + 40 between date '1997-01-01' and date '1997-03-31' then 'payment_date' when o_orderdate::date between date '1997-01-01' and date '1997-03-31' then 'filing_date' end as match_basis from orders",
    "j1_route_dataset": f"with {vendor_queries._REQ} select k as request_id, ds as dataset from routed",
    "j4_usage_log": f"with {vendor_queries._REQ} select sess as session_id, 'intraday_campaign_v1.3' as ledger_version, ds as dataset, strftime(st, '%Y-%m-%d') as start, strftime(en, '%Y-%m-%d') as \"end\", pu as purpose, arm as arm_id, fin as final_portfolio_review from dec where reason = 'allowed' and ds is not null and pu is not null",
    "j6_asset_rules": f"with {vendor_queries._REQ} select k as request_id, case when reason in ('short_interest_provider', 'short_interest_purpose', 'short_interest_kind', 'short_interest_timeframe', 'index_recon_timeframe') then reason end as rule from dec",
}
