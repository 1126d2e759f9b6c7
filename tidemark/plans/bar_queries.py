"""Queries over bars: roll-ups, quality, gaps, comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import compare, quality, rollup
from tidemark.plans import views
from tidemark.plans.views import BARS_SQL, DAILY_SQL, us
from tidemark.session import workdir
from tidemark.sources import tables

def _out(df, *more):
    prices = [F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")]
    return df.select("symbol", us("timestamp", "ts_us"), *prices, F.col("volume").cast("long").alias("volume"), *more)


def _rollup(timeframe):
    return lambda spark, d: _out(rollup.aggregate_bars(views.bars_1m(spark, d), timeframe))


def _rollup_sql(bucket):
    return f"""with {BARS_SQL} select symbol, epoch_us({bucket}) as ts_us, arg_min(open, ts)::double as open, max(high)::double as high, min(low)::double as low,
      arg_max(close, ts)::double as close, sum(volume)::bigint as volume from bars group by symbol, {bucket}"""


def _day_bucket(n):
    return f"(date_trunc('day', ts) + to_minutes(cast(floor((hour(ts) * 60 + minute(ts)) / {n}) * {n} as integer)))"


_LAG = "lag(ts) over (partition by symbol order by ts)"
_LEAD = "lead(ts) over (partition by symbol order by ts)"


def d3(spark, d):
    """Hourly bars from the bar table: cached while half of the minutes were there, gone on with, then found complete."""
    path, staging = workdir(spark, "rollup"), workdir(spark, "rollup-staging")
    base = views.bars_1m(spark, d).withColumns({"provider": F.lit("vendor"), "timeframe": F.lit("1m")})
    early = F.col("timestamp") < F.lit("2024-01-16 09:30:00").cast("timestamp")
    for k, part in enumerate((base.where(early), base.where(~early))):
        tables.write_bars(part, path, f"{staging}/{k}")
        tables.cached_rollup(spark, path, f"{staging}/{k}-1h", "vendor", "1h")
    out, again = tables.cached_rollup(spark, path, f"{staging}/none", "vendor", "1h")
    if again:
        raise AssertionError("a complete roll-up was made again")
    return _out(out)


def d3_splice(spark, d):
    base = views.bars_1m(spark, d)
    cached = rollup.aggregate_bars(base.where(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")), "1h").select("symbol", "timestamp", "open", "high", "low", "close", "volume")
    return _out(rollup.load_or_rollup(base, cached, "1h"))


def d4(spark, d):
    out = quality.run_bar_qa(views.bars_1m(spark, d))
    return out.withColumn("zero_volume_ratio", F.round("zero_volume_ratio", 6))


def d5(spark, d):
    out = quality.validate_ohlc(views.bars_1m(spark, d))
    return out.select("symbol", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "row_count", us("start"), us("end"))


def d6(spark, d):
    out = quality.validate_series(views.bars_1m(spark, d))
    return out.select("symbol", "row_count", F.col("null_count").cast("long").alias("null_count"), "duplicate_timestamps")


def d8(spark, d):
    out = quality.health_report(views.bars_1m(spark, d))
    return out.select(F.coalesce("symbol", F.lit("all")).alias("symbol"), F.col("bars").cast("long").alias("bars"), F.col("nulls").cast("long").alias("nulls"), F.col("dups").cast("long").alias("dups"), "status", us("first"), us("last"))


def d9(spark, d):
    out = quality.audit(views.bars_1m(spark, d), "1m")
    return out.select("symbol", "bars", F.col("nulls").cast("long").alias("nulls"), "dups", "gap_count", F.unix_micros(F.get("first_gaps", 0)["timestamp"]).alias("first_gap_us"), F.size("first_gaps").alias("n_first"))



def c1(spark, d):
    b = rollup.aggregate_bars(views.bars_1m(spark, d), "1h")
    first = b.groupBy("timestamp").agg(F.min("symbol").alias("s1"), F.max("symbol").alias("s2"))
    both = b.join(first, "timestamp")
    one, two = both.where("symbol = s1"), both.where("symbol = s2")
    return compare.align_sources(one, two)


def c1_out(spark, d):
    return c1(spark, d).select(us("timestamp", "ts_us"), *[F.round(f"{c}_diff", 6).alias(f"{c}_diff") for c in compare.VALUES])


def d10(spark, d):
    s = compare.compare_stats(c1(spark, d))
    return s.select("column", *[F.round(c, 6).alias(c) for c in ("mean_diff", "max_abs_diff", "std_diff", "correlation")], "matched")


_C1_SQL = f"""with {BARS_SQL}, h as (select symbol, date_trunc('hour', ts) as ts, arg_min(open, ts)::double as open, max(high)::double as high, min(low)::double as low, arg_max(close, ts)::double as close, sum(volume)::double as volume from bars group by 1, 2),
 f as (select ts, min(symbol) as s1, max(symbol) as s2 from h group by ts),
 a as (select h1.ts, h1.open as open_1, h2.open as open_2, h1.high as high_1, h2.high as high_2, h1.low as low_1, h2.low as low_2, h1.close as close_1, h2.close as close_2, h1.volume as volume_1, h2.volume as volume_2
   from f join h h1 on h1.ts = f.ts and h1.symbol = f.s1 join h h2 on h2.ts = f.ts and h2.symbol = f.s2)"""
_COLS = ("open", "high", "low", "close", "volume")


_MEASURED = ("close", "high", "low", "volume")


def _exact_days(spark, d):
    """Daily bars with a decimal close and with highs and lows in whole ticks, whose sums do not depend on the order of rows."""
    return views.bars_1d(spark, d).withColumns({"close": F.col("close").cast("decimal(18,4)"), **{c: F.floor(F.col(c) * 10_000) for c in ("high", "low")}})


def d11(spark, d):
    s = compare.stats(_exact_days(spark, d), columns=_MEASURED)
    return s.select("symbol", "column", "mean", "min", "max", F.round("std", 4).alias("std"), "count", "nulls")


def d12(spark, d):
    s = compare.info(views.bars_1m(spark, d))
    return s.select("symbol", "rows", us("first"), us("last"), F.col("min_low").cast("double").alias("min_low"), F.col("max_high").cast("double").alias("max_high"), F.col("total_volume").cast("long").alias("total_volume"))


def d13(spark, d):
    s = compare.yearly_breakdown(_exact_days(spark, d), columns=_MEASURED)
    return s.select("symbol", "year", "column", "bars", F.round("percent", 6).alias("percent"), "mean", "min", "max", F.round("std", 4).alias("std"), "nulls")


def e7(spark, d):
    hourly, _ = quality.normalize_hourly(rollup.aggregate_bars(views.bars_1m(spark, d), "1h"))
    return _out(hourly, "is_synthetic_bar")


def c8(spark, d):
    b = views.bars_1m(spark, d)
    local = rollup.aggregate_bars(b, "1d").withColumn("date", F.to_date("timestamp"))
    venue = local.withColumns({"close": F.when(F.dayofmonth("date") % 5 == 0, F.col("close").cast("double") * 1.01).otherwise(F.col("close").cast("double")), "volume": F.when(F.dayofmonth("date") % 7 == 0, F.col("volume") + 1).otherwise(F.col("volume"))}).where(F.dayofmonth("date") % 11 != 0)
    out = compare.validate_aggregate(local, venue)
    return out.select("symbol", F.datediff("date", F.lit("1970-01-01").cast("date")).alias("day"), F.array_join("offenders", ",").alias("offenders"), "passed")


def d7(spark, d):
    return quality.validation_issues(views.bars_1m(spark, d), "1m")


def f4(spark, d):
    b = views.bars_1m(spark, d)
    fetched = b.where(F.minute("timestamp") % 2 == 0).withColumn("volume", F.col("volume") + 100)
    return _out(quality.dedup_bars(b, fetched))


QUERIES = {
    "d1_rollup_1h": _rollup("1h"), "d1_rollup_7m": _rollup("7m"), "d1_rollup_12h": _rollup("12h"), "d1_rollup_1d": _rollup("1d"),
    "d1_rollup_3d": lambda s, d: _out(rollup.aggregate_bars(views.bars_1m(s, d), "3d", allow_multiday=True)),
    "d2_rollup_15m": lambda s, d: _out(rollup.aggregate_bars_by_symbol(views.bars_1m(s, d), "15m")),
    "d3_load_or_rollup": d3, "d3_splice": d3_splice, "d4_bar_qa": d4, "d5_validate_ohlc": d5, "d6_validate_series": d6, "d7_validation_issues": d7, "d8_health_report": d8, "d9_audit": d9,
    "c1_align_sources": c1_out, "d10_compare_stats": d10, "d11_stats": d11, "d12_info": d12, "d13_yearly": d13, "c8_validate_aggregate": c8,
    "e1_classify_gaps": lambda s, d: quality.classify_gaps(views.bars_1d(s, d), 1440).select("symbol", us("timestamp", "ts_us"), "delta_s", "gap"),
    "e2_detect_gaps": lambda s, d: quality.detect_gaps(views.bars_1m(s, d), 5).select("symbol", us("timestamp", "ts_us"), us("next_ts", "next_us")),
    "e3_pct_move": lambda s, d: quality.pct_move(views.bars_1m(s, d), "move").select("symbol", us("timestamp", "ts_us"), F.round("move", 6).alias("move")),
    "e4_internal_gaps": lambda s, d: quality.detect_internal_gaps(views.bars_1d(s, d), "1d", True).select("symbol", us("gap_start"), us("gap_end")),
    "e5_is_monotonic": lambda s, d: quality.is_monotonic(views.table(s, d, "events").select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("timestamp"), (F.col("event_id") % 1000 + F.col("event_id")).alias("seq")), "seq"),
    "e6_has_duplicates": lambda s, d: quality.has_duplicates(views.table(s, d, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.col("l_shipdate").alias("timestamp"))),
    "e7_normalize_hourly": e7,
    "d20_gap_policy": lambda s, d: quality.detect_gap_policy(views.bars_1m(s, d)),
    "a6_read_latest": lambda s, d: _out(quality.last_n(views.bars_1m(s, d), ["symbol"], "timestamp", 5)),
    "b6_filter_day": lambda s, d: _out(quality.filter_day(views.bars_1m(s, d), "2024-01-10")),
    "f2_first_gaps": lambda s, d: quality.first_gaps(quality.detect_gaps(views.bars_1m(s, d), 5)).select("symbol", us("timestamp", "ts_us"), us("next_ts", "next_us")),
    "f4_dedup_bars": f4,
}

_EXACT_SQL = "long as (" + " union all ".join(f"select symbol, ts, '{c}' as \"column\", {f'floor({c} * 10000)::bigint' if c in ('high', 'low') else c}::decimal(22,4) as value from daily" for c in _MEASURED) + ")"
_MOMENTS_SQL = "(sum(value) * 10000)::bigint::double / 10000.0::double / count(value) as mean, min(value)::double as min, max(value)::double as max, round(stddev_samp(value::double), 4) as std"
_ALL = "symbol, epoch_us(ts) as ts_us, open::double as open, high::double as high, low::double as low, close::double as close, volume"
_ISSUES = [("error", "high_below_low", "high < low"), ("error", "high_below_open", "high < open"), ("error", "high_below_close", "high < close"), ("error", "low_above_open", "low > open"), ("error", "low_above_close", "low > close")]
_ISSUES += [("error", f"negative_{c}", f"{c} < 0") for c in _COLS] + [("error", f"null_{c}", f"{c} is null") for c in _COLS] + [("error", "duplicate_timestamps", "dup > 1"), ("error", "not_sorted", "false"), ("warning", "gaps", "gap > 2 and not gap between 2000 and 5000")]
ORACLE_SQL = {
    "d1_rollup_1h": _rollup_sql("date_trunc('hour', ts)"), "d1_rollup_7m": _rollup_sql(_day_bucket(7)), "d1_rollup_12h": _rollup_sql(_day_bucket(720)), "d1_rollup_1d": _rollup_sql("date_trunc('day', ts)"),
    "d1_rollup_3d": _rollup_sql("make_timestamp((epoch_us(ts) // 259200000000) * 259200000000)"),
    "d2_rollup_15m": _rollup_sql("make_timestamp((epoch_us(ts) // 900000000) * 900000000)"),
    "d3_load_or_rollup": _rollup_sql("date_trunc('hour', ts)"), "d3_splice": _rollup_sql("date_trunc('hour', ts)"),
    "d4_bar_qa": f"""with {BARS_SQL}, m as (select *, abs(close::double / nullif(lag(close::double) over (partition by symbol order by ts), 0) - 1) as move from bars)
      select symbol, round(count(*) filter (volume = 0) / count(*), 6) as zero_volume_ratio, count(*) filter (high < low or high < open or high < close or low > open or low > close) as ohlc_inconsistencies,
      count(*) filter (move > 0.1) as extreme_moves, count(*) filter (volume < 0) as negative_volume, 0::bigint as non_monotonic_ts, 0.0::double as missing_ratio from m group by symbol""",
    "d5_validate_ohlc": f"""with {BARS_SQL}, m as (select *, abs(close::double / nullif(lag(close::double) over (partition by symbol order by ts), 0) - 1) as move, epoch_us(ts) - epoch_us({_LAG}) as gap from bars)
      select symbol, concat_ws(',', case when bool_or(high < low) then 'high_lt_low' end, case when bool_or(high < open or high < close) then 'high_lt_open_close' end, case when bool_or(low > open or low > close) then 'low_gt_open_close' end, case when bool_or(volume < 0) then 'negative_volume' end) as errors,
      concat_ws(',', case when bool_or(move > 0.2) then 'price_spike' end, case when bool_or(gap > 3600000000) then 'stale_data' end) as warnings, count(*) as row_count, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as end_us from m group by symbol""",
    "d6_validate_series": f"with {BARS_SQL} select symbol, count(*) as row_count, sum((open is null)::int + (close is null)::int)::bigint as null_count, count(*) - count(distinct ts) as duplicate_timestamps from bars group by symbol",
    "d7_validation_issues": f"with {BARS_SQL}, m as (select *, row_number() over (partition by symbol, ts) as dup, (epoch_us(ts) - epoch_us({_LAG})) / 60000000 as gap from bars) select * from (" + " union all ".join(f"select symbol, '{s}' as severity, '{k}' as \"check\", count(*) filter ({w}) as count from m group by symbol" for s, k, w in _ISSUES) + ") where count > 0",
    "d8_health_report": f"with {BARS_SQL}, e as (select symbol, count(*) as bars, 0::bigint as nulls, (count(*) - count(distinct ts))::bigint as dups, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us from bars group by symbol) select symbol, bars::bigint as bars, nulls, dups, case when dups > 0 then 'Issues' else 'Healthy' end as status, first_us, last_us from e union all select 'all', sum(bars)::bigint, 0, sum(dups)::bigint, case when sum(dups) > 0 then 'Issues' else 'Healthy' end, min(first_us), max(last_us) from e",
    "d9_audit": f"with {BARS_SQL}, m as (select *, {_LEAD} as n from bars) select symbol, count(*) as bars, 0::bigint as nulls, 0::bigint as dups, count(*) filter (epoch_us(n) - epoch_us(ts) > 60000000) as gap_count, min(epoch_us(ts)) filter (epoch_us(n) - epoch_us(ts) > 60000000) as first_gap_us, least(10, count(*) filter (epoch_us(n) - epoch_us(ts) > 60000000))::int as n_first from m group by symbol",
    "c1_align_sources": _C1_SQL + " select epoch_us(ts) as ts_us, " + ", ".join(f"round({c}_1 - {c}_2, 6) as {c}_diff" for c in _COLS) + " from a",
    "d10_compare_stats": _C1_SQL + " " + " union all ".join(f"select '{c}' as \"column\", round(avg({c}_1 - {c}_2), 6) as mean_diff, round(max(abs({c}_1 - {c}_2)), 6) as max_abs_diff, round(stddev_samp({c}_1 - {c}_2), 6) as std_diff, round(corr({c}_1, {c}_2), 6) as correlation, count(*) as matched from a" for c in _COLS),
    "d11_stats": f"with {DAILY_SQL}, {_EXACT_SQL} select symbol, \"column\", {_MOMENTS_SQL}, count(value) as count, count(*) - count(value) as nulls from long group by symbol, \"column\"",
    "d12_info": f"with {BARS_SQL} select symbol, count(*) as rows, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us, min(low)::double as min_low, max(high)::double as max_high, sum(volume)::bigint as total_volume from bars group by symbol",
    "d13_yearly": f"with {DAILY_SQL}, {_EXACT_SQL}, y as (select symbol, year(ts)::int as year, \"column\", count(*) as bars, {_MOMENTS_SQL}, count(*) - count(value) as nulls from long group by all) select * replace (std as std), round(bars * 100.0::double / sum(bars) over (partition by symbol, \"column\"), 6) as percent from y",
    "c8_validate_aggregate": f"""with {BARS_SQL}, l as (select symbol, date_trunc('day', ts)::date as date, arg_max(close, ts)::double as close, sum(volume)::bigint as volume from bars group by 1, 2),
      v as (select symbol, date, case when day(date) % 5 = 0 then close * 1.01::double else close end as close, case when day(date) % 7 = 0 then volume + 1 else volume end as volume from l where day(date) % 11 <> 0),
      j as (select l.symbol, l.date, v.date is null as gone, abs(l.close - v.close) > 1e-5 * case when (abs(l.close) + abs(v.close)) / 2 = 0 then 1 else (abs(l.close) + abs(v.close)) / 2 end as c, l.volume <> v.volume as vol from l left join v on v.symbol = l.symbol and v.date = l.date)
      select symbol, date_diff('day', date '1970-01-01', date)::int as day, concat_ws(',', case when gone then 'missing_venue' end, case when c then 'close' end, case when vol then 'volume' end) as offenders, not (gone or coalesce(c, false) or coalesce(vol, false)) as passed from j""",
    "e1_classify_gaps": f"with {DAILY_SQL}, m as (select *, {_LAG} as p from daily) select symbol, epoch_us(ts) as ts_us, (epoch_us(ts) - epoch_us(p)) / 1e6 as delta_s, case when p is null then 'none' when isodow(ts) in (7, 1) and isodow(p) in (5, 6) and epoch_us(ts) - epoch_us(p) >= 172800000000 then 'weekend' when epoch_us(ts) - epoch_us(p) <= 86400000000 then 'on_schedule' else 'gap' end as gap from m",
    "e2_detect_gaps": f"with {BARS_SQL}, m as (select symbol, ts, {_LEAD} as n from bars) select symbol, epoch_us(ts) as ts_us, epoch_us(n) as next_us from m where epoch_us(n) - epoch_us(ts) > 300000000",
    "e3_pct_move": f"with {BARS_SQL} select symbol, epoch_us(ts) as ts_us, round(close::double / nullif(lag(close::double) over (partition by symbol order by ts), 0) - 1, 6) as move from bars",
    "e4_internal_gaps": f"with {DAILY_SQL}, m as (select *, {_LAG} as p from daily) select symbol, epoch_us(p) + 86400000000 as gap_start_us, greatest(epoch_us(p) + 86400000000, epoch_us(ts) - 86400000000) as gap_end_us from m where epoch_us(ts) - epoch_us(p) > 1.1 * 86400000000 and not (isodow(p) in (5, 6) and isodow(ts) in (7, 1) and epoch_us(ts) - epoch_us(p) between 172800000000 and 259200000000)",
    "e5_is_monotonic": "with m as (select event_type as symbol, ts < lag(ts) over (partition by event_type order by event_id % 1000 + event_id) as back from events) select symbol, not bool_or(coalesce(back, false)) as is_monotonic from m group by symbol",
    "e6_has_duplicates": "with m as (select 'S' || l_suppkey as symbol, l_shipdate, count(*) as n from lineitem group by 1, 2) select symbol, bool_or(n > 1) as has_duplicates from m group by symbol",
    "e7_normalize_hourly": f"""with {BARS_SQL}, h as (select symbol, date_trunc('hour', ts) as ts, arg_min(open, ts)::double as open, max(high)::double as high, min(low)::double as low, arg_max(close, ts)::double as close, sum(volume)::bigint as volume from bars group by 1, 2),
      g as (select symbol, unnest(generate_series(min(ts), max(ts), interval 1 hour)) as ts from h group by symbol),
      j as (select g.symbol, g.ts, open, high, low, close, volume, last_value(close ignore nulls) over (partition by g.symbol order by g.ts rows between unbounded preceding and current row) as c from g left join h on h.symbol = g.symbol and h.ts = g.ts)
      select symbol, epoch_us(ts) as ts_us, coalesce(open, c) as open, coalesce(high, c) as high, coalesce(low, c) as low, coalesce(close, c) as close, coalesce(volume, 0)::bigint as volume, close is null as is_synthetic_bar from j""",
    "d20_gap_policy": f"with {BARS_SQL}, m as (select symbol, (epoch_us(ts) - epoch_us({_LAG})) / 60000000 as gap from bars) select symbol, count(*) filter (gap > 60) as gap_count, coalesce(floor(max(gap) filter (gap > 60)), 0)::bigint as max_gap_minutes, count(*) filter (gap > 4320) as oversized_gaps, count(*) filter (gap > 4320) = 0 as within_limit from m group by symbol",
    "a6_read_latest": f"with {BARS_SQL} select {_ALL} from bars qualify row_number() over (partition by symbol order by ts desc) <= 5",
    "b6_filter_day": f"with {BARS_SQL} select {_ALL} from bars where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11'",
    "f2_first_gaps": f"with {BARS_SQL}, m as (select symbol, ts, {_LEAD} as n from bars) select symbol, epoch_us(ts) as ts_us, epoch_us(n) as next_us from m where epoch_us(n) - epoch_us(ts) > 300000000 order by ts, symbol limit 10",
    "f4_dedup_bars": f"with {BARS_SQL} select symbol, epoch_us(ts) as ts_us, open::double as open, high::double as high, low::double as low, close::double as close, (volume + case when minute(ts) % 2 = 0 then 100 else 0 end)::bigint as volume from bars",
}
