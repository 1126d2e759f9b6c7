"""Queries over coverage, universes, membership, symbology and fundamentals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import coverage, fundamentals, universe
from tidemark.plans import views
from tidemark.plans.views import BARS_SQL, CHANGES_SQL, COVERAGE_SQL, FACTS_SQL, SNAPSHOTS_SQL, SYMBOLOGY_SQL, us

FROM, TO = "1996-01-01", "2000-01-01"
_DAY = lambda c, name: F.datediff(c, F.lit("1970-01-01").cast("date")).alias(name)


def _symbols(spark, d):
    return views.table(spark, d, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("symbol"))


def _gaps(spark, d):
    return coverage.per_symbol_gaps(_symbols(spark, d), views.coverage(spark, d), FROM, TO)


def e8(spark, d):
    return coverage.merge_ranges(views.coverage(spark, d)).select("symbol", us("start_ts", "start_us"), us("end_ts", "end_us"), us("fetched_at", "fetched_us"), "batch_job_id")


def d15(spark, d):
    out = coverage.group_by_gap_pattern(_symbols(spark, d), _gaps(spark, d))
    return out.select("pattern", F.size("gaps").alias("n_gaps"), "n_symbols", "first_symbol")


def d16(spark, d):
    out = coverage.coverage_observation(views.bars_1m(spark, d), "2024-01-05", "2024-01-20")
    return out.select("symbol", *[F.col(c).cast("long").alias(c) for c in ("rows", "unique_rows", "duplicate_rows", "outside_window")], us("first"), us("last"), "sha256")


def k1_inside(spark, d):
    rows = views.table(spark, d, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.col("o_orderdate").cast("timestamp").alias("timestamp"), "o_orderkey")
    gaps = coverage.coverage_gaps(views.coverage(spark, d).where(F.col("batch_job_id") != "J0"), FROM, TO)
    return coverage.inside_any(rows, gaps).select("symbol", "o_orderkey", us("timestamp", "ts_us"))


def e11(spark, d):
    r = views.coverage(spark, d).groupBy("symbol").agg(F.to_date(F.min("start_ts")).alias("first_date"), F.to_date(F.max("start_ts")).alias("last_date"))
    return coverage.edge_gaps(r, FROM, TO, "1d").select("symbol", _DAY("gap_start", "gap_start"), _DAY("gap_end", "gap_end"))


def _asked(spark, d):
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "elsewhere").otherwise("orders")  # urgent ones ask a source that there is not
    return views.table(spark, d, "orders").select(source.alias("source"), F.add_months(F.col("o_orderdate").cast("date"), 1).alias("as_of")).distinct()


def c3(spark, d):
    """The members at every date, counted and hashed in order."""
    out = universe.members_asof(views.snapshots(spark, d), _asked(spark, d)).groupBy("source", "as_of", "found").agg(F.sort_array(F.collect_list("symbol")).alias("members"))
    return out.select("source", _DAY("as_of", "as_of"), "found", F.size("members").alias("n"), F.sha2(F.array_join("members", ",").cast("binary"), 256).alias("members_sha256"))


def c4(spark, d):
    keys = views.table(spark, d, "lineitem").select(F.concat(F.lit("C"), F.col("l_suppkey") * 3 % 1500).alias("raw_symbol"), F.col("l_shipdate").cast("date").alias("date")).distinct()
    return universe.resolve_symbol(keys, views.symbology(spark, d)).select("raw_symbol", _DAY("date", "day"), "instrument_id")


def _deltas(spark, d):
    return universe.member_deltas(views.members(spark, d))


def g4(spark, d):
    r = views.reference(spark, d)
    cheap, big = universe.filter_universe(r, "price < 950"), universe.filter_universe(r, "dollar_volume_20d > 30000")
    named = r.where("exchange = 'Brand#11'").select("symbol", F.lit(False).alias("pit"))
    out = universe.set_op_universe("union", [universe.set_op_universe("exclude", [cheap, big]), named])
    return out


def _rich(spark, d):
    return views.table(spark, d, "customer").where("c_acctbal > 0").select(F.concat(F.lit("C"), "c_custkey").alias("symbol"))


def d17(spark, d):
    out = universe.audit_survivorship(views.snapshots(spark, d), _rich(spark, d), FROM, TO)
    return out.select(*[c for c in out.columns if not c.endswith("ratio")], F.round("coverage_ratio", 6).alias("coverage_ratio"), F.round("delisted_coverage_ratio", 6).alias("delisted_coverage_ratio"))


def c12(spark, d):
    t = views.table(spark, d, "supplier").select(F.concat(F.lit("S-"), F.col("s_suppkey") % 70).alias("ticker"), F.lpad(F.col("s_nationkey").cast("string"), 10, "0").alias("cik"))
    s = views.table(spark, d, "supplier").select(F.concat(F.lit("s."), F.col("s_suppkey") % 90).alias("symbol")).distinct()
    return universe.resolve_cik(s, t)


def a17(spark, d):
    rec = views.table(spark, d, "orders").select((F.col("o_orderkey") * 2 % 30000).alias("instrument_id"), "o_orderkey")
    return universe.attach_symbol(rec, views.symbology(spark, d), "NONE").select("o_orderkey", "instrument_id", "symbol")


def b12(spark, d):
    said = F.element_at(F.lit(["acquired by ", "filed for Bankruptcy ", "Spun off from ", "Market cap below ", "merger, delisted "]), (F.col("doc_id") % 5 + 1).cast("int"))
    text = F.coalesce(F.col("text"), F.lit(""))
    df = views.table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.concat(said, text)).otherwise(text).alias("reason"))
    return df.select("doc_id", universe.classify_removal_reason(F.col("reason")).alias("reason_class"))


AS_OF = "2000-06-30"


def _snapshot(spark, d):
    return fundamentals.with_fundamental_metrics(fundamentals.build_snapshot(views.facts(spark, d), AS_OF))


def e14(spark, d):
    out = _snapshot(spark, d)
    return out.select("cik", F.col("fiscal_year").alias("fiscal_year"), _DAY("filed", "filed_day"), *[F.round(c, 2).alias(c) for c in ("revenue", "operating_income", "cfo", "capex", "interest_expense", "sbc", "inventory")])


#: Dates on, between and long after the days on which facts are filed.
AS_OF_DATES = [f"{y}-{day}" for y in range(1993, 2001) for day in ("03-01", "03-02", "06-30")]


def e14_dates(spark, d):
    out = fundamentals.build_snapshots(views.facts(spark, d), AS_OF_DATES)
    return out.select(_DAY("as_of", "as_of_day"), "cik", "fiscal_year", _DAY("filed", "filed_day"), *[F.round(c, 2).alias(c) for c in ("revenue", "operating_income", "cfo", "capex", "interest_expense", "sbc", "inventory")])


def d24_dates(spark, d):
    f = views.facts(spark, d).withColumn("accn", F.lpad(F.col("pos").cast("string"), 10, "0"))
    return fundamentals.common_shares_at(f, AS_OF_DATES).select(_DAY("cutoff", "cutoff_day"), "cik", _DAY("filed", "filed_day"), "accn", "val", "form")


def b19(spark, d):
    return _snapshot(spark, d).select("cik", "fiscal_year", F.round("fcf", 2).alias("fcf"), F.round("interest_coverage", 6).alias("interest_coverage"), F.round("sbc_to_fcf", 6).alias("sbc_to_fcf"), "ebitda", "total_debt", "net_debt")


def b20(spark, d):
    out = fundamentals.missing_concepts(_snapshot(spark, d))
    return out.select("cik", "fiscal_year", F.array_join("missing", ",").alias("missing"))


def e16(spark, d):
    return fundamentals.inventory_vs_sales(_snapshot(spark, d)).select("cik", F.round("inventory_vs_sales", 6).alias("inventory_vs_sales"))


def e15(spark, d):
    shares = _snapshot(spark, d).withColumn("diluted_shares", F.col("revenue"))
    return fundamentals.share_growth(shares).select("cik", F.round("diluted_share_growth", 6).alias("diluted_share_growth"))


def d24(spark, d):
    f = views.facts(spark, d).withColumn("accn", F.lpad(F.col("pos").cast("string"), 10, "0"))
    out = fundamentals.pit_common_shares(f, AS_OF)
    return out.select("cik", _DAY("filed", "filed_day"), "accn", "val", "form")


QUERIES = {
    "e8_merge_ranges": e8,
    "e10_coverage_gaps": lambda s, d: coverage.coverage_gaps(views.coverage(s, d), FROM, TO).select("symbol", us("gap_start"), us("gap_end")),
    "c13_per_symbol_gaps": lambda s, d: _gaps(s, d).select("symbol", us("gap_start"), us("gap_end")),
    "e11_edge_gaps": e11,
    "d14_coverage_summary": lambda s, d: coverage.coverage_summary(_symbols(s, d), _gaps(s, d), FROM, TO),
    "d15_gap_patterns": d15, "d15_pattern_members": lambda s, d: coverage.gap_pattern_members(_symbols(s, d), _gaps(s, d)).select("symbol", "pattern"), "d16_observation": d16, "k1_rows_inside_gaps": k1_inside,
    "a7_date_range": lambda s, d: coverage.date_range(views.bars_1m(s, d)).select("symbol", us("first"), us("last")),
    "b7_filter_universe": lambda s, d: universe.filter_universe(views.reference(s, d), "price > 950 and exchange <> 'Brand#11'"),
    "g1_explicit_universe": lambda s, d: universe.explicit_universe(s, ["p1", " P2", "P1", "p900000000"]).join(views.reference(s, d).select("symbol"), "symbol", "left_semi"),
    "g3_composite_universe": lambda s, d: universe.composite_universe(views.snapshots(s, d), "orders", "1997-05-15", False),
    "g4_set_op_universe": g4, "c3_members_asof": c3, "c4_resolve_symbol": c4, "a17_attach_symbol": a17, "c12_resolve_cik": c12,
    "e9_membership_deltas": lambda s, d: _deltas(s, d).select(_DAY("date", "day"), "symbol", "action", _DAY("prev_snapshot_date", "prev_day")),
    "c5_cross_check": lambda s, d: universe.cross_check_deltas(_deltas(s, d), views.changes(s, d)).withColumn("match_rate", F.round("match_rate", 6)),
    "c7_annotate_deltas": lambda s, d: universe.annotate_deltas(_deltas(s, d), views.changes(s, d)).select(_DAY("date", "day"), "symbol", "action", "status"),
    "d17_survivorship": d17, "d17_missing_members": lambda s, d: universe.missing_members(views.snapshots(s, d), _rich(s, d), FROM, TO),
    "d18_ever_members": lambda s, d: universe.ever_members(views.snapshots(s, d), FROM, TO),
    "d19_current_members": lambda s, d: universe.current_members(views.snapshots(s, d), TO),
    "b12_removal_reason": b12,
    "e12_annual_facts": lambda s, d: fundamentals.annual_facts(views.facts(s, d), AS_OF).select("cik", "tag", _DAY("end", "end_day"), _DAY("filed", "filed_day"), "val"),
    "e13_resolve_concepts": lambda s, d: fundamentals.resolve_concepts(fundamentals.annual_facts(views.facts(s, d), AS_OF)).select("cik", "concept", "tag", _DAY("end", "end_day"), "val"),
    "e14_snapshot": e14, "b19_metrics": b19, "b20_missing": b20, "e15_share_growth": e15, "e16_inventory_vs_sales": e16, "d24_common_shares": d24, "e14_snapshots_by_date": e14_dates, "d24_common_shares_by_date": d24_dates,
    "d23_fcf_positive": lambda s, d: fundamentals.fcf_positive_count(_snapshot(s, d)),
}

_C = f"with {COVERAGE_SQL}, w as (select timestamp '{FROM}' as lo, timestamp '{TO}' as hi)"
_GAP_PARTS = """
inside as (select symbol, greatest(start_ts, lo) as s, least(end_ts, hi) as e from {cov}, w where end_ts > lo and start_ts < hi union all select distinct symbol, hi, hi from {cov}, w),
gaps as (select symbol, gap_start, s as gap_end from (select symbol, s, coalesce(max(e) over (partition by symbol order by s, e rows between unbounded preceding and 1 preceding), lo) as gap_start from inside, w) where s > gap_start)"""
_GAP = _GAP_PARTS.format(cov="coverage")
_ALLGAP = _GAP + ", syms as (select 'C' || c_custkey as symbol from customer), allgaps as (select gaps.* from gaps join syms using (symbol) union all select symbol, lo, hi from syms, w where symbol not in (select symbol from coverage))"
_PATTERN = "p as (select s.symbol, coalesce(string_agg(epoch_us(gap_start) || '-' || epoch_us(gap_end), ',' order by gap_start), '') as gaps, count(gap_start) as n from syms s left join allgaps g on g.symbol = s.symbol group by s.symbol)"
_DELTA = f"with {SNAPSHOTS_SQL}, l as (select date, tickers, lag(tickers) over (order by date) as was, lag(date) over (order by date) as prev from snapshots), deltas as (select date, unnest(list_filter(tickers, lambda x: not list_contains(was, x))) as symbol, 'added' as action, prev from l where prev is not null union all select date, unnest(list_filter(was, lambda x: not list_contains(tickers, x))), 'removed', prev from l where prev is not null), {CHANGES_SQL}"
_DAYS = lambda c, name: f"date_diff('day', date '1970-01-01', {c})::int as {name}"
_ANNUAL = f"with {FACTS_SQL}, annual as (select * from facts where val is not null and filed <= date '{AS_OF}' and \"end\" - start between 330 and 400 qualify row_number() over (partition by cik, tag, \"end\" order by filed desc, pos) = 1)"
_CONCEPT = [(c, t, i) for c, tags in fundamentals.CONCEPTS.items() for i, t in enumerate(tags)]
_RESOLVED = _ANNUAL + ", concepts(concept, tag, prio) as (values " + ", ".join(f"('{c}', '{t}', {i})" for c, t, i in _CONCEPT if c != "diluted_shares") + """),
reach as (select a.*, concept, prio, max("end") over (partition by cik, concept, a.tag) as reach from annual a join concepts using (tag)),
resolved as (select * from reach qualify prio = first_value(prio) over (partition by cik, concept order by reach desc, prio))"""
_SNAP = _RESOLVED + ", snap as (select cik, \"end\", year(\"end\")::int as fiscal_year, max(filed) as filed, " + ", ".join(f"max(val) filter (concept = '{c}') as {c}" for c in fundamentals.CONCEPTS) + " from resolved group by cik, \"end\" qualify row_number() over (partition by cik order by \"end\" desc) <= 6), metrics as (select *, cfo - capex as fcf from snap)"
_ASKED = "asked(as_of) as (values " + ", ".join(f"(date '{d}')" for d in AS_OF_DATES) + ")"
_BY_DATE = f"""with {FACTS_SQL}, {_ASKED}, annual as (select * from facts cross join asked where val is not null and filed <= as_of and "end" - start between 330 and 400 qualify row_number() over (partition by as_of, cik, tag, "end" order by filed desc, pos) = 1), concepts(concept, tag, prio) as (values """ + ", ".join(f"('{c}', '{t}', {i})" for c, t, i in _CONCEPT if c != "diluted_shares") + """),
reach as (select a.*, concept, prio, max("end") over (partition by as_of, cik, concept, a.tag) as reach from annual a join concepts using (tag)),
resolved as (select * from reach qualify prio = first_value(prio) over (partition by as_of, cik, concept order by reach desc, prio)),
snap as (select as_of, cik, year("end")::int as fiscal_year, max(filed) as filed, """ + ", ".join(f"max(val) filter (concept = '{c}') as {c}" for c in fundamentals.CONCEPTS) + """ from resolved group by as_of, cik, "end" qualify row_number() over (partition by as_of, cik order by "end" desc) <= 6)"""
ORACLE_SQL = {
    "e8_merge_ranges": f"""with {COVERAGE_SQL}, m as (select *, case when start_ts > max(end_ts) over (partition by symbol order by start_ts, end_ts rows between unbounded preceding and 1 preceding) then 1 when row_number() over (partition by symbol order by start_ts, end_ts) = 1 then 1 else 0 end as new from coverage),
      i as (select *, sum(new) over (partition by symbol order by start_ts, end_ts rows between unbounded preceding and current row) as island from m)
      select symbol, epoch_us(min(start_ts)) as start_us, epoch_us(max(end_ts)) as end_us, epoch_us(max(fetched_at)) as fetched_us, case when count(distinct batch_job_id) = 1 then min(batch_job_id) end as batch_job_id from i group by symbol, island""",
    "e10_coverage_gaps": f"{_C}, {_GAP} select symbol, epoch_us(gap_start) as gap_start_us, epoch_us(gap_end) as gap_end_us from gaps",
    "c13_per_symbol_gaps": f"{_C}, {_ALLGAP} select symbol, epoch_us(gap_start) as gap_start_us, epoch_us(gap_end) as gap_end_us from allgaps",
    "e11_edge_gaps": f"with {COVERAGE_SQL}, r as (select symbol, min(start_ts)::date as f, max(start_ts)::date as l, date '{FROM}' as lo, date '{TO}' as hi from coverage group by symbol) select symbol, {_DAYS('lo', 'gap_start')}, {_DAYS('least(f - 1, hi)', 'gap_end')} from r where f > lo and lo <= least(f - 1, hi) union all select symbol, {_DAYS('greatest(l + 1, lo)', 'a')}, {_DAYS('hi', 'b')} from r where l < hi and greatest(l + 1, lo) <= hi",
    "d14_coverage_summary": f"{_C}, {_ALLGAP}, e as (select symbol, count(*) as n, bool_or(gap_start = lo and gap_end = hi) as whole, sum(epoch(gap_end) - epoch(gap_start)) as s from allgaps, w group by symbol) select count(*) as n_total, count(*) filter (n is null) as n_covered, count(*) filter (n is not null and not (n = 1 and whole)) as n_partial, count(*) filter (n = 1 and whole) as n_missing, round(coalesce(sum(s), 0)::double / 86400, 2) as gap_symbol_days from syms left join e using (symbol)",
    "d15_gap_patterns": f"{_C}, {_ALLGAP}, {_PATTERN} select sha256(gaps) as pattern, any_value(n)::int as n_gaps, count(*) as n_symbols, min(symbol) as first_symbol from p group by gaps",
    "d15_pattern_members": f"{_C}, {_ALLGAP}, {_PATTERN} select symbol, sha256(gaps) as pattern from p",
    "d16_observation": f"with {BARS_SQL} select symbol, count(*) as rows, count(distinct ts) as unique_rows, 0::bigint as duplicate_rows, count(*) filter (ts < timestamp '2024-01-05' or ts >= timestamp '2024-01-20') as outside_window, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us, sha256(string_agg(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), chr(10) order by ts)) as sha256 from bars group by symbol",
    "k1_rows_inside_gaps": f"with {COVERAGE_SQL}, w as (select timestamp '{FROM}' as lo, timestamp '{TO}' as hi), part as (select * from coverage where batch_job_id <> 'J0'), {_GAP_PARTS.format(cov='part')} select 'C' || o_custkey as symbol, o_orderkey, epoch_us(o_orderdate) as ts_us from orders where exists (select 1 from gaps g where g.symbol = 'C' || o_custkey and o_orderdate >= gap_start and o_orderdate < gap_end)",
    "a7_date_range": f"with {BARS_SQL} select symbol, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us from bars group by symbol",
    "b7_filter_universe": "select distinct 'P' || p_partkey as symbol, true as pit from part where p_retailprice > 950 and p_brand <> 'Brand#11'",
    "g1_explicit_universe": "select distinct 'P' || p_partkey as symbol, true as pit from part where p_partkey in (1, 2, 900000000)",
    "g3_composite_universe": f"with {SNAPSHOTS_SQL} select distinct unnest(tickers) as symbol, false as pit from (select tickers from snapshots where date <= date '1997-05-15' order by date desc limit 1)",
    "g4_set_op_universe": "select symbol, false as pit from (select 'P' || p_partkey as symbol from part where (p_retailprice < 950 and not p_size * p_retailprice > 30000) or p_brand = 'Brand#11') group by symbol",
    "c3_members_asof": f"""with {SNAPSHOTS_SQL}, a as (select distinct case when o_orderpriority = '1-URGENT' then 'elsewhere' else 'orders' end as source, (o_orderdate + interval 1 month)::date as as_of from orders), c as (select a.source, a.as_of, s.tickers from a asof left join snapshots s on a.source = s.source and a.as_of >= s.date)
      select source, {_DAYS('as_of', 'as_of')}, tickers is not null as found, coalesce(len(tickers), 0)::int as n, sha256(coalesce(array_to_string(tickers, ','), '')) as members_sha256 from c""",
    "c4_resolve_symbol": f"with {SYMBOLOGY_SQL}, k as (select distinct 'C' || (l_suppkey * 3 % 1500) as raw_symbol, l_shipdate::date as date from lineitem) select k.raw_symbol, {_DAYS('k.date', 'day')}, s.instrument_id from k left join symbology s on s.raw_symbol = k.raw_symbol and k.date >= s.valid_from and (s.valid_to is null or k.date <= s.valid_to)",
    "a17_attach_symbol": f"with {SYMBOLOGY_SQL}, n as (select instrument_id, arg_max(raw_symbol, valid_from) as raw from symbology group by 1) select o_orderkey, o_orderkey * 2 % 30000 as instrument_id, coalesce(upper(replace(raw, '-', '.')), 'NONE') as symbol from orders left join n on n.instrument_id = o_orderkey * 2 % 30000",
    "c12_resolve_cik": "with t as (select 'S-' || (s_suppkey % 70) as a, lpad(s_nationkey::varchar, 10, '0') as cik from supplier), o as (select a, min(cik) as cik from t group by a having min(cik) = max(cik)), s as (select distinct 's.' || (s_suppkey % 90) as symbol from supplier) select symbol, cik from s left join o on o.a = upper(replace(symbol, '.', '-'))",
    "e9_membership_deltas": f"{_DELTA} select {_DAYS('date', 'day')}, symbol, action, {_DAYS('prev', 'prev_day')} from deltas",
    "c5_cross_check": f"{_DELTA}, j as (select c.*, exists (select 1 from deltas d where d.symbol = c.symbol and d.action = c.action and abs(date_diff('day', d.date, c.date)) <= 7) as matched from changes c where c.date between (select min(date) from deltas) - 7 and (select max(date) from deltas) + 7) select count(*) as n_in_window, count(*) filter (matched) as n_matched, count(*) filter (not matched) as n_unmatched, round(count(*) filter (matched) / count(*), 6) as match_rate from j",
    "c7_annotate_deltas": f"{_DELTA} select {_DAYS('d.date', 'day')}, symbol, action, case when exists (select 1 from changes c where c.symbol = d.symbol and c.action = d.action and abs(date_diff('day', d.date, c.date)) <= 7) then 'confirmed' else 'not_in_change_window' end as status from deltas d",
    "d17_survivorship": f"""with {SNAPSHOTS_SQL}, ever as (select distinct unnest(tickers) as symbol from snapshots where date between date '{FROM}' and date '{TO}'), now as (select unnest(tickers) as symbol from (select tickers from snapshots where date <= date '{TO}' order by date desc limit 1)),
      j as (select symbol, symbol in (select symbol from now) as cur, symbol in (select 'C' || c_custkey from customer where c_acctbal > 0) as data from ever)
      select count(*) as n_ever, count(*) filter (cur) as n_current, count(*) filter (data) as n_with_data, count(*) filter (not cur) as n_delisted, count(*) filter (not cur and data) as n_delisted_with_data, round(count(*) filter (data) / count(*), 6) as coverage_ratio,
      round(count(*) filter (not cur and data) / count(*) filter (not cur), 6) as delisted_coverage_ratio, count(*) filter (not data) as n_missing from j""",
    "d17_missing_members": f"""with {SNAPSHOTS_SQL}, ever as (select distinct unnest(tickers) as symbol from snapshots where date between date '{FROM}' and date '{TO}'), now as (select unnest(tickers) as symbol from (select tickers from snapshots where date <= date '{TO}' order by date desc limit 1))
      select symbol, symbol not in (select symbol from now) as delisted from ever where symbol not in (select 'C' || c_custkey from customer where c_acctbal > 0)""",
    "d18_ever_members": f"with {SNAPSHOTS_SQL} select distinct unnest(tickers) as symbol from snapshots where date between date '{FROM}' and date '{TO}'",
    "d19_current_members": f"with {SNAPSHOTS_SQL} select unnest(tickers) as symbol from (select tickers from snapshots where date <= date '{TO}' order by date desc limit 1)",
    "b12_removal_reason": "with r as (select doc_id, case when doc_id % 7 <> 0 then ['acquired by ', 'filed for Bankruptcy ', 'Spun off from ', 'Market cap below ', 'merger, delisted '][1 + doc_id % 5] || coalesce(text, '') else coalesce(text, '') end as reason from documents) select doc_id, case when regexp_matches(lower(reason), 'acqui|merg|bought|takeover') then 'm_and_a' when regexp_matches(lower(reason), 'delist|bankrupt|chapter 11') then 'delisting' when regexp_matches(lower(reason), 'spun off|spin-off|spinoff|spun out') then 'spinoff' when regexp_matches(lower(reason), 'market cap|ranking') then 'ranking' else 'other' end as reason_class from r",
    "e12_annual_facts": f"{_ANNUAL} select cik, tag, {_DAYS(chr(34) + 'end' + chr(34), 'end_day')}, {_DAYS('filed', 'filed_day')}, val from annual",
    "e13_resolve_concepts": f"{_RESOLVED} select cik, concept, tag, {_DAYS(chr(34) + 'end' + chr(34), 'end_day')}, val from resolved",
    "e14_snapshot": f"{_SNAP} select cik, fiscal_year, {_DAYS('filed', 'filed_day')}, round(revenue, 2) as revenue, round(operating_income, 2) as operating_income, round(cfo, 2) as cfo, round(capex, 2) as capex, round(interest_expense, 2) as interest_expense, round(sbc, 2) as sbc, round(inventory, 2) as inventory from snap",
    "b19_metrics": f"{_SNAP} select cik, fiscal_year, round(fcf, 2) as fcf, round(case when interest_expense > 0 then operating_income / interest_expense end, 6) as interest_coverage, round(case when fcf > 0 then sbc / fcf end, 6) as sbc_to_fcf, null::double as ebitda, null::double as total_debt, null::double as net_debt from metrics",
    "b20_missing": f"{_SNAP} select cik, fiscal_year, concat_ws(',', " + ", ".join(f"case when {c} is null then '{c}' end" for c in fundamentals.LATEST_FIELDS) + ") as missing from snap",
    "e15_share_growth": f"{_SNAP}, r as (select cik, revenue, row_number() over (partition by cik order by \"end\" desc) as k from snap where revenue is not null), p as (select cik, max(revenue) filter (k = 1) as a, max(revenue) filter (k = 2) as b from r where k <= 2 group by cik) select cik, round(case when b > 0 then a / b - 1 end, 6) as diluted_share_growth from p",
    "e16_inventory_vs_sales": f"{_SNAP}, r as (select *, row_number() over (partition by cik order by \"end\" desc) as k from snap), p as (select cik, max(inventory) filter (k = 1) as i1, max(inventory) filter (k = 2) as i0, max(revenue) filter (k = 1) as r1, max(revenue) filter (k = 2) as r0 from r where k <= 2 group by cik) select cik, round(case when i0 > 0 and r0 > 0 then (i1 / i0 - 1) - (r1 / r0 - 1) end, 6) as inventory_vs_sales from p",
    "d23_fcf_positive": f"{_SNAP}, r as (select *, row_number() over (partition by cik order by \"end\" desc) as k from metrics) select cik, count(*) filter (fcf > 0) as positive, count(fcf) as computable from r where k <= 5 group by cik",
    "d24_common_shares": f"with {FACTS_SQL}, k as (select *, lpad(pos::varchar, 10, '0') as accn from facts where val > 0 and filed <= date '{AS_OF}' and \"end\" <= date '{AS_OF}') select cik, {_DAYS('filed', 'filed_day')}, accn, val, form from k qualify row_number() over (partition by cik order by filed desc, \"end\" desc, accn desc) = 1",
    "e14_snapshots_by_date": f"{_BY_DATE} select {_DAYS('as_of', 'as_of_day')}, cik, fiscal_year, {_DAYS('filed', 'filed_day')}, round(revenue, 2) as revenue, round(operating_income, 2) as operating_income, round(cfo, 2) as cfo, round(capex, 2) as capex, round(interest_expense, 2) as interest_expense, round(sbc, 2) as sbc, round(inventory, 2) as inventory from snap",
    "d24_common_shares_by_date": f"with {FACTS_SQL}, {_ASKED}, k as (select *, lpad(pos::varchar, 10, '0') as accn from facts cross join asked where val > 0 and filed <= as_of and \"end\" <= as_of) select {_DAYS('as_of', 'cutoff_day')}, cik, {_DAYS('filed', 'filed_day')}, accn, val, form from k qualify row_number() over (partition by as_of, cik order by filed desc, \"end\" desc, accn desc) = 1",
}
