"""Literal cases: small inputs with known results, properties, plans."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import calendar, coverage, filings, fundamentals, governance, ingest, options, quality, rollup, universe
from tidemark.schemas import minutes
from tidemark.sources import payloads, tables
from tidemark.streaming import bars as streams

BAR = "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double"


def bars(spark, times, symbol="A", close=1.0):
    return spark.createDataFrame([(symbol, t, close, close + 1, close - 1, close + i / 10, 10.0) for i, t in enumerate(times)], BAR)


def at(*x):
    return datetime(*x)


@pytest.mark.parametrize("frame", ["5m", "15m", "1h", "4h", "12h", "1d", "7m"])
def test_one_bucket_keeps_volume(spark, frame):
    out = rollup.aggregate_bars(bars(spark, [at(2024, 1, 1, 0, m) for m in range(5)]), frame).collect()
    assert [(r.timestamp, r.volume, r.open) for r in out] == [(at(2024, 1, 1), 50.0, 1.0)]


def test_two_buckets_and_rejected_frames(spark):
    assert rollup.aggregate_bars(bars(spark, [at(2024, 1, 1, 0, m) for m in (2, 3, 4, 5)]), "5m").count() == 2
    with pytest.raises(ValueError):
        rollup.aggregate_bars(bars(spark, [at(2024, 1, 1)]), "2d")
    with pytest.raises(ValueError):
        minutes("x")


def test_gap_rules(spark):
    three = bars(spark, [at(2024, 1, 1, 0, 0), at(2024, 1, 1, 0, 1), at(2024, 1, 1, 0, 10)])
    assert [r.gap for r in quality.classify_gaps(three, 1).orderBy("timestamp").collect()] == ["none", "on_schedule", "gap"]
    one = quality.detect_internal_gaps(bars(spark, [at(2024, 1, 1, 10, m) for m in (0, 1, 4, 5)]), "1m").collect()
    assert [(r.gap_start, r.gap_end) for r in one] == [(at(2024, 1, 1, 10, 2), at(2024, 1, 1, 10, 3))]
    assert quality.detect_internal_gaps(bars(spark, [at(2024, 1, 1, 10, m) for m in (0, 3, 4, 8)]), "1m").count() == 2


def test_weekend_is_no_gap(spark):
    friday = bars(spark, [at(2024, 1, 5), at(2024, 1, 8)])
    assert quality.detect_internal_gaps(friday, "1d").count() == 1
    assert quality.detect_internal_gaps(friday, "1d", skip_weekends=True).count() == 0
    assert [r.gap for r in quality.classify_gaps(friday, 1440).orderBy("timestamp").collect()] == ["none", "weekend"]


def test_hourly_grid(spark):
    hourly, rejected = quality.normalize_hourly(bars(spark, [at(2024, 1, 1, 0), at(2024, 1, 1, 2)]), 180)
    rows = hourly.orderBy("timestamp").collect()
    assert [r.is_synthetic_bar for r in rows] == [False, True, False] and rows[1].close == rows[1].high == rows[0].close and rows[1].volume == 0
    assert rejected.count() == 0
    wide, rejected = quality.normalize_hourly(bars(spark, [at(2024, 1, 1), at(2024, 1, 5, 4)]))
    assert wide.count() == 0 and rejected.count() == 1


def test_zero_close_gives_no_move(spark):
    df = spark.createDataFrame([("A", at(2024, 1, 1, 0, i), 0.0, 1.0, 0.0, c, 1.0) for i, c in enumerate((0.0, 5.0))], BAR)
    assert [r.m for r in quality.pct_move(df, "m").orderBy("timestamp").collect()] == [None, None]


@pytest.mark.parametrize("broken", [dict(high=0.5), dict(low=9.0), dict(volume=-1.0)])
def test_broken_rules_are_reported(spark, broken):
    row = dict(symbol="A", timestamp=at(2024, 1, 1), open=2.0, high=3.0, low=1.0, close=2.0, volume=1.0) | broken
    df = spark.createDataFrame([tuple(row.values())], BAR)
    assert quality.validate_ohlc(df).first().errors
    with pytest.raises(Exception, match="OHLC"):
        quality.validate_ohlc(df, strict=True).collect()


def ranges(spark, *spans):
    return spark.createDataFrame([("A", at(2025, 1, a), at(2025, 1, b), at(2025, 1, b), "j") for a, b in spans], "symbol string, start_ts timestamp, end_ts timestamp, fetched_at timestamp, batch_job_id string")


@pytest.mark.parametrize("spans, merged", [(((1, 2), (5, 6)), 2), (((1, 5), (4, 7)), 1), (((1, 5), (5, 8)), 1)])
def test_ranges_merge(spark, spans, merged):
    assert coverage.merge_ranges(ranges(spark, *spans)).count() == merged


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 27), st.integers(1, 8)), min_size=1, max_size=8))
def test_covered_and_gaps_make_up_the_window(spark, spans):
    spans = [(a, min(28, a + n)) for a, n in spans]
    gaps = coverage.coverage_gaps(ranges(spark, *spans), "2025-01-01 00:00:00", "2025-01-28 00:00:00").collect()
    days = [d for g in gaps for d in range(g.gap_start.day, g.gap_end.day)]
    assert len(days) == len(set(days)) and set(days) == {d for d in range(1, 28) if not any(a <= d < b for a, b in spans)}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**18), min_size=1, max_size=20))
def test_q9_is_exact(spark, values):
    got = [r.q for r in spark.createDataFrame([(v,) for v in values], "v long").select(options.q9(F.col("v")).alias("q")).collect()]
    assert got == [(Decimal(v) / Decimal(10**9)).quantize(Decimal("1e-8"), rounding="ROUND_HALF_EVEN") for v in values]


def test_record_without_a_price_is_excluded(spark):
    rec = [("A", 1, 10**18, 10**9, payloads.NO_PRICE, 10**9, 10**9, 5), ("A", 1, 10**18, 10**9, 10**9, 10**9, 10**9, 5)]
    good, gone = payloads.normalize_q9(spark.createDataFrame(rec, "symbol string, instrument_id int, ts_event long, open long, high long, low long, close long, volume long"))
    assert good.count() == 1 and gone.first().excluded == 1


def test_sessions(spark):
    cal = calendar.sessions(spark, "2024-01-01", "2024-12-31").collect()
    closes = {r.session_date: r.close_ts for r in cal}
    assert len(cal) == 252 and closes[date(2024, 11, 29)] == at(2024, 11, 29, 18) and date(2024, 3, 29) not in closes and date(2024, 6, 19) not in closes
    opens = {r.session_date: r.open_ts for r in cal}
    assert opens[date(2024, 3, 8)] == at(2024, 3, 8, 14, 30) and opens[date(2024, 3, 11)] == at(2024, 3, 11, 13, 30)


@pytest.mark.parametrize("end, n, start", [(at(2024, 6, 3, 20), 390, at(2024, 6, 3, 13, 30)), (at(2024, 6, 3, 13, 35), 30, at(2024, 5, 31, 19, 35)), (at(2024, 11, 29, 18), 210, at(2024, 11, 29, 14, 30)), (at(2024, 3, 11, 20), 390, at(2024, 3, 11, 13, 30))])
def test_trading_minutes(spark, end, n, start):
    cal = calendar.sessions(spark, "2024-01-01", "2024-12-31")
    assert calendar.trading_minutes_window(spark.createDataFrame([(end, n)], "end timestamp, n long"), cal).first().start == start


@pytest.mark.parametrize("close, opened, kind", [
    (at(2024, 1, 9, 21), at(2024, 1, 10, 14, 30), "weeknight"), (at(2024, 1, 5, 21), at(2024, 1, 8, 14, 30), "weekend"), (at(2024, 1, 12, 21), at(2024, 1, 16, 14, 30), "long_holiday"),
    (at(2024, 6, 18, 20), at(2024, 6, 20, 13, 30), "pre_holiday"), (at(2024, 1, 9, 16), at(2024, 1, 9, 16, 30), "halt_reopen"),
])
def test_closed_gap(spark, close, opened, kind):
    cal = calendar.sessions(spark, "2024-01-01", "2024-12-31")
    df = spark.createDataFrame([(close, opened)], "close_ts timestamp, open_ts timestamp")
    assert calendar.classify_closed_gap(df, cal).first().gap_class == kind


def test_event_clock_after_an_early_close(spark):
    cal = calendar.sessions(spark, "2024-11-01", "2024-12-31")
    r = calendar.event_clock(spark.createDataFrame([(at(2024, 11, 29, 18, 30),)], "accepted_ts timestamp"), cal).first()
    assert (r.session_bucket, r.event_time, len(r.decision_times)) == ("after_close", at(2024, 12, 2, 14, 30), 3)


def test_short_interest_dates(spark):
    cal = calendar.sessions(spark, "2026-01-01", "2026-03-31")
    df = spark.createDataFrame([(date(2026, 1, 15),), (date(2026, 1, 30),)], "settlement_date date")
    got = {r.settlement_date: r.dissemination_date for r in calendar.dissemination_date(df, cal).collect()}
    assert got == {date(2026, 1, 15): date(2026, 1, 27), date(2026, 1, 30): date(2026, 2, 10)}
    days = [r.settlement_date for r in calendar.settlement_dates(cal, "2026-01-01", "2026-03-31").orderBy("settlement_date").collect()]
    assert days == [date(2026, 1, 15), date(2026, 1, 30), date(2026, 2, 13), date(2026, 2, 27), date(2026, 3, 13), date(2026, 3, 31)]


def test_fomc(spark):
    out = calendar.fomc(spark, "2022-03-01", "2022-06-30").orderBy("announcement_date").collect()
    assert [r.announcement_utc for r in out] == [at(2022, 3, 16, 18), at(2022, 5, 4, 18), at(2022, 6, 15, 18)]


def snapshots(spark):
    return spark.createDataFrame([("s", date(2020, 1, 1), ["AAA", "BBB", "DEAD1"]), ("s", date(2021, 1, 1), ["AAA", "BBB", "DEAD2"]), ("s", date(2022, 1, 1), ["AAA", "BBB", "NEW1"])], "source string, date date, tickers array<string>")


def test_membership(spark):
    s = snapshots(spark)
    assert universe.ever_members(s, "2020-01-01", "2022-12-31").count() == 5 and universe.current_members(s, "2022-12-31").count() == 3
    assert {(r.symbol, r.action) for r in universe.membership_deltas(s).collect()} == {("DEAD2", "added"), ("DEAD1", "removed"), ("NEW1", "added"), ("DEAD2", "removed")}
    early = universe.members_asof(s, spark.createDataFrame([("s", date(2019, 1, 1)), ("s", date(2021, 6, 1))], "source string, as_of date")).collect()
    assert {(r.as_of.year, r.symbol, r.found) for r in early} == {(2019, None, False), (2021, "AAA", True), (2021, "BBB", True), (2021, "DEAD2", True)}
    with pytest.raises(Exception, match="no snapshot"):
        universe.composite_universe(s, "s", "2019-01-01").collect()
    audit = universe.audit_survivorship(s, spark.createDataFrame([("aaa",), ("DEAD1",)], "symbol string"), "2020-01-01", "2022-12-31").first()
    assert (audit.n_ever, audit.n_delisted, audit.n_delisted_with_data, audit.n_missing) == (5, 2, 1, 3)
    gone = universe.missing_members(s, spark.createDataFrame([("aaa",), ("DEAD1",)], "symbol string"), "2020-01-01", "2022-12-31").collect()
    assert {(r.symbol, r.delisted) for r in gone} == {("BBB", False), ("DEAD2", True), ("NEW1", False)}


def test_symbology_rename(spark):
    m = spark.createDataFrame([("FB", 1001, date(2022, 1, 1), date(2022, 6, 8)), ("META", 2002, date(2022, 6, 9), None)], "raw_symbol string, instrument_id long, valid_from date, valid_to date")
    k = spark.createDataFrame([("FB", date(2022, 6, 8)), ("FB", date(2022, 6, 9)), ("META", date(2030, 1, 1))], "raw_symbol string, date date")
    assert {(r.raw_symbol, r.date.year, r.date.day): r.instrument_id for r in universe.resolve_symbol(k, m).collect()} == {("FB", 2022, 8): 1001, ("FB", 2022, 9): None, ("META", 2030, 1): 2002}


def test_futures_prefix_needs_the_asset_class(spark):
    one = spark.createDataFrame([("cl",)], "s string")
    pick = lambda c: one.select(payloads.normalize_symbol(F.col("s"), "tradestation", c)).first()[0]
    assert (pick("future"), pick("stocks")) == ("@CL", "CL")


def test_malformed_candle(spark):
    bad = spark.createDataFrame([("A", '{"candles":[{"complete":true,"time":"2024-01-01T00:00:00.5Z","mid":{"o":"1","h":"2","l":"x","c":"1"}}]}')], "symbol string, payload string")
    with pytest.raises(Exception, match="malformed bar"):
        payloads.normalize_oanda(bad).collect()
    assert payloads.normalize_oanda(bad, strict=False).first().quarantine == "low"


def test_short_interest_file(spark, tmp_path):
    head = "|".join(tables.SHORT_INTEREST_COLUMNS)
    (tmp_path / "f.csv").write_text(f"{head}\nA|Agilent|NYSE|100|90|10|N/A||bad|10\n")
    r = tables.normalize_short_interest(spark, str(tmp_path / "f.csv"), "2024-12-31", "2025-01-10").first()
    assert (r.short_interest, r.days_to_cover, r.change_pct, len(r.source_sha256)) == (100, None, None, 64)


def test_bars_table_round_trip(spark, tmp_path):
    b = bars(spark, [at(2024, 1, 1, 0, m) for m in range(3)]).withColumns({"provider": F.lit("p"), "timeframe": F.lit("1m")})
    path = f"file://{tmp_path}/bars"
    tables.write_bars(b, path, f"file://{tmp_path}/s1")
    tables.write_bars(b.withColumn("volume", F.lit(7.0)).limit(1), path, f"file://{tmp_path}/s2")
    got = tables.read_bars(spark, path, "p", "A", "1m", columns=["timestamp", "volume"]).orderBy("timestamp").collect()
    assert [float(r.volume) for r in got] == [7.0, 10.0, 10.0]
    assert tables.write_bars(b.withColumn("high", F.lit(0.0)), path, f"file://{tmp_path}/s3").count() == 1
    with pytest.raises(KeyError):
        tables.read_bars(spark, path, "p", "B", "1m")
    keys = spark.createDataFrame([("p", "A", "1m")], "provider string, symbol string, timeframe string")
    assert tables.delete_series(spark, path, keys) == 3


def test_sync_is_idempotent(spark):
    u = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    landing = spark.createDataFrame([("A", at(2025, 1, 2), False), ("B", at(2025, 1, 2), False), ("C", at(2025, 1, 2), True)], "symbol string, timestamp timestamp, no_data boolean")
    cov = ranges(spark, (1, 5)).select("symbol", "start_ts", "end_ts")
    rows, claims, report = ingest.sync(u, landing, cov, "2025-01-01", "2025-01-03")
    assert [r.symbol for r in rows.collect()] == ["B"] and {(r.symbol, r.status) for r in report.collect()} == {("A", "ok"), ("B", "ok"), ("C", "skipped")}
    after = ingest.commit(claims, cov)
    assert ingest.sync(u, landing, after, "2025-01-01", "2025-01-03")[0].count() == 0


def test_fundamentals_choose_the_tag_that_reaches_furthest(spark):
    row = lambda tag, year, val: ("c", tag, "USD", 0, date(year, 1, 1), date(year, 12, 31), float(val), date(year + 1, 2, 1), "10-K", "FY")
    facts = spark.createDataFrame([row("Revenues", 2020, 1), row("SalesRevenueNet", 2020, 2), row("SalesRevenueNet", 2021, 3)], "cik string, tag string, unit string, pos int, start date, end date, val double, filed date, form string, fp string")
    assert {(r.fiscal_year, r.revenue) for r in fundamentals.build_snapshot(facts, "2023-01-01").collect()} == {(2020, 2.0), (2021, 3.0)}
    assert fundamentals.build_snapshot(facts, "2021-12-31").first().revenue == 1.0


def test_snapshots_of_many_dates_are_those_of_each(spark):
    """24 dates in one pass against 24 single ones, with restatements, facts filed on one day and a count filed before its period ends."""
    import random

    draw, rows = random.Random(3), []
    for pos in range(400):
        year = draw.randint(2010, 2014)
        filed = date(year + draw.randint(0, 2), draw.randint(1, 12), draw.choice([1, 1, 15]))
        rows.append((draw.choice("abc"), draw.choice(["Revenues", "SalesRevenueNet", "InventoryNet"]), "USD", pos, date(year, 1, 1) if draw.random() < 0.9 else None, date(year, 12, 31), float(draw.randint(-3, 9)), filed, draw.choice(["10-K", "10-K/A", "10-Q"]), draw.choice(["FY", "FY", "Q1"]), f"n{pos:03}"))
    facts = spark.createDataFrame(rows, "cik string, tag string, unit string, pos int, start date, end date, val double, filed date, form string, fp string, accn string").cache()
    asked = [f"{y}-{m:02}-01" for y in range(2010, 2017) for m in (1, 4, 7, 11)][:24]
    one = ["fiscal_year_end", "filed", "revenue", "inventory"]
    key = lambda t: tuple((x is None, x) for x in t)
    single = [(d, r.cik, *[r[c] for c in one]) for d in asked for r in fundamentals.build_snapshot(facts, d, 3).collect()]
    got = [(str(r.as_of), r.cik, *[r[c] for c in one]) for r in fundamentals.build_snapshots(facts, [*asked, asked[5]], 3).collect()]
    assert sorted(got, key=key) == sorted(single, key=key) and len(got) > 50
    single = [(d, r.cik, r.filed, r.end, r.accn, r.val, r.form) for d in asked for r in fundamentals.pit_common_shares(facts, d).collect()]
    got = [(str(r.cutoff), r.cik, r.filed, r.end, r.accn, r.val, r.form) for r in fundamentals.common_shares_at(facts, asked).collect()]
    assert sorted(got) == sorted(single) and len(got) > 40
    assert fundamentals.build_snapshots(facts, []).count() == fundamentals.common_shares_at(facts, []).count() == fundamentals.build_snapshots(facts.limit(0), asked).count() == 0


def test_reads_are_decided(spark):
    row = lambda purpose, a, b, final=False: (1, "oanda", "EUR_USD", None, "1d", "bars", a, b, purpose, "arm", final, "s", at(2025, 1, 1))
    asked = [row("discovery", date(2020, 1, 1), date(2024, 12, 31)), row("discovery", date(2019, 1, 1), date(2020, 1, 1)), row("discovery", date(2020, 1, 1), date(2026, 1, 1)), row("discovery", date(2026, 1, 1), date(2026, 2, 1), True), row("dev_smoke", date(2026, 1, 1), date(2026, 2, 1))]
    df = spark.createDataFrame(asked, "request_id long, provider string, symbol string, asset_class string, timeframe string, data_kind string, start date, end date, purpose string, arm_id string, final_portfolio_review boolean, session_id string, ts timestamp")
    assert [r.reason for r in governance.decide_reads(df, governance.campaign_ledger(spark)).collect()] == ["allowed", "outside_window", "lockbox", "allowed", "allowed"]


def test_interrupted_writes_can_be_repeated(spark, tmp_path, monkeypatch):
    """A crash between staging and replacing, and one between moving months aside and deleting them, lose nothing."""
    b = bars(spark, [at(2024, m, 1, 0, k) for m in (1, 2, 3) for k in range(3)]).withColumns({"provider": F.lit("p"), "timeframe": F.lit("1m")})
    path, other = f"file://{tmp_path}/bars", b.withColumn("symbol", F.lit("B/2 x"))
    tables.write_bars(b.unionByName(other), path, f"file://{tmp_path}/s1")
    with monkeypatch.context() as m:
        m.setattr(tables, "_write", lambda *x: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.write_bars(b.withColumn("volume", F.lit(7.0)), path, f"file://{tmp_path}/s2")
    assert spark.read.parquet(path).where("volume = 10").count() == 18
    tables.write_bars(b.withColumn("volume", F.lit(7.0)), path, f"file://{tmp_path}/s2")
    assert spark.read.parquet(path).where("volume = 7").count() == 9
    tables.write_bars(b.where("month(timestamp) = 2"), path, f"file://{tmp_path}/s3", mode="overwrite")
    assert spark.read.parquet(path).groupBy("symbol").count().orderBy("symbol").collect() == [("A", 3), ("B/2 x", 9)]
    assert tables.delete_series(spark, path, other.select("provider", "symbol", "timeframe")) == 9
    assert spark.read.parquet(path).count() == 3 and tables.delete_series(spark, path, other.select("provider", "symbol", "timeframe")) == 0


def test_text_of_html(spark):
    """Against the standard library's parser."""
    from html.parser import HTMLParser

    class Parser(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts = []

        def handle_data(self, data):
            self.parts.append(data)

    cases = ["a<b>c</b>d", "x &amp;lt; y &#8217;s &#x2019; &mdash;&nbsp;&rsquo;", "&#160;&#150;&#0;&#xD800;&#1114112;&copy 1 &notit; &unknown; & b &#;", "<p>1 < 2</p>", "<script>if (a<b) '<p>&amp;</p>'</script>after", "<style>p{}</style><p title=x>t</p>", "<!-- <p>no</p> -->yes", "&Aacute;&aacute&ldquo;&hellip;", "plain", ""]
    got = {r.t: r.x for r in spark.createDataFrame([(c,) for c in cases], "t string").select("t", filings.html_to_text(F.col("t")).alias("x")).collect()}
    for c in cases:
        parser = Parser()
        parser.feed(c)
        parser.close()
        assert got[c] == " ".join(" ".join(parser.parts).split()), c
    with pytest.raises(Exception, match="marked section"):
        spark.createDataFrame([("<![weird[x]]>",)], "t string").select(filings.html_to_text(F.col("t"))).collect()


def test_markup_is_read_token_by_token(spark):
    """1,000 random documents against the standard library's parser, and long tags, which must need no stack."""
    import random
    from html.parser import HTMLParser

    class Parser(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts = []

        def handle_data(self, data):
            self.parts.append(data)

    pieces = ["one ", "two", " & ", "&amp;", "&lt;p&gt;", "<p>", "</p>", "<br/>", "<p title='a>b'>", '<a href="x>y" class=z>', "<p title=it's>", "<a b = 'c' d>", "<!-- c <p> ' -->", "<!-- <script> -->", "<!DOCTYPE html>", "<?pi x?>", "1 < 2 ", "<script>if (a<b) x('<p>&amp;');</script>", "<script><!-- kept --></script>", "<style media='x>y'>p{} <!-- k --></style>", "<script src='a>b'></script>", "<script/>", '<td data-x="<b>">', "<![CDATA[ no ]]>", "<![if x]>", "<![endif]>"]
    draw = random.Random(7)
    cases = ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 14))) for _ in range(1000)]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string").select("i", filings.html_to_text(F.col("t")).alias("x"))
    for r in rows.collect():
        parser = Parser()
        parser.feed(cases[r.i])
        parser.close()
        assert r.x == " ".join(" ".join(parser.parts).split()), cases[r.i]
    long = [f"a<p {'k=v ' * 200_000}>b", f"a<p t='{'>' * 500_000}'>b", f"a<!--{'- ' * 300_000}-->b", f"<script>{'x<' * 300_000}</script>", "a<!-- never ended", "a<p never ended", None]
    got = [r.x for r in spark.createDataFrame(list(enumerate(long)), "i int, t string").select("i", filings.html_to_text(F.col("t")).alias("x")).orderBy("i").collect()]
    assert got == ["a b", "a b", "a b", "x<" * 300_000, "a", "a", None]


def test_texts_are_read_once(spark):
    """Plans of corporate actions hold each costly expression once; texts with the marks inside, empty and null ones give what they announce."""
    docs = [("a", "8-K", None, 0, "<p>A TWENTY - for - 3 reverse stock split</p>"), ("b", "8-K", "x", 1, "\uFDD0\uFDD1cash dividend of $2 per share"), ("c", "8-K", "x", 0, ""), ("d", "8-K", "x", 0, None), ("e", "8-K", "x", 0, "a split was discussed")]
    out = filings.corporate_actions(spark.createDataFrame(docs, "accession string, document_type string, filename string, document_no int, document string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--") == 1 and plan.count("ex[-\\s]?dividend date") == 1
    assert sorted((r.accession, r.corporate_action_type, r.split_ratio_to, r.split_ratio_from, r.cash_amount) for r in out.collect()) == [("a", "stock_split", 20, 3, None), ("b", "cash_dividend", None, None, "2")]


def test_record_dates_lie_behind_their_words(spark):
    """The first date that lies wholly in the 240 characters behind a mention, of the first mention that has one."""
    far, date_ = "x " * 118, "May 3, 2021"
    texts = {"near": f"cash dividend to holders; stockholders of record on {date_}", "cut": f"cash dividend, shareholders of record {far}{date_}", "second": f"cash dividend, shareholder of record {far}{far} stockholders of record {date_}", "bad": "cash dividend to shareholders of record on February 31, 2021", "two": "a cash dividend of $1 per share and $2.50 per share. A quarterly cash dividend of $3 per share"}
    out = filings.extract_actions(spark.createDataFrame(list(texts.items()), "k string, plain string")).collect()
    assert {r.k: r.record_date for r in out if r.k != "two"} == {"near": "2021-05-03", "cut": None, "second": "2021-05-03", "bad": None}
    assert [r.cash_amount for r in out if r.k == "two"] == ["2.50", "3"]


def test_stream_reports_and_last_buckets(spark, tmp_path):
    b = bars(spark, [at(2024, 1, 1, h, m) for h in (0, 1) for m in (0, 30)])
    b.withColumn("high", F.when(F.minute("timestamp") == 30, F.lit(-5.0)).otherwise(F.col("high"))).write.parquet(f"{tmp_path}/in")
    source = lambda: spark.readStream.schema(b.schema).parquet(f"{tmp_path}/in")
    log = []
    streams.run(streams.refused(source()), lambda df, n: log.extend(r.errors for r in df.collect()), f"{tmp_path}/s1")
    assert log == [["high_lt_low", "high_lt_open_close"]] * 2
    streams.run(streams.roll_up(streams.valid(source()), "1h"), lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/log/batch={n}"), f"{tmp_path}/s2", "update")
    assert {r.timestamp for r in streams.latest(spark.read.parquet(f"{tmp_path}/log")).collect()} == {at(2024, 1, 1, 0), at(2024, 1, 1, 1)}


def test_filings_are_ordered(spark):
    df = spark.createDataFrame([("1", "8-K", date(2020, 1, d), f"a{k}") for d, k in ((1, 5), (2, 9), (2, 3), (2, 3))], "cik string, form string, filing_date date, accession string")
    assert [(r.ordinal, r.accession) for r in filings.filing_index(df, None, "2020-01-01", "2020-12-31").orderBy("ordinal").collect()] == [(1, "a3"), (2, "a9"), (3, "a5")]


def test_split_announcement(spark):
    text = "The board approved a 4-for-1 stock split. Shares will be distributed on August 24, 2020 to stockholders of record as of Monday, August 17, 2020; trading will begin on a split-adjusted basis on August 31, 2020."
    r = filings.extract_actions(spark.createDataFrame([("a", text)], "accession string, plain string")).first()
    assert (r.split_ratio_to, r.split_ratio_from, r.effective_date, r.record_date, r.distribution_date) == (4, 1, "2020-08-31", "2020-08-17", "2020-08-24")


def test_stream_drops_repeats(spark, tmp_path):
    b = bars(spark, [at(2024, 1, 1, 0, m) for m in range(3)])
    b.union(b).write.parquet(f"{tmp_path}/in")
    got = []
    streams.run(streams.ingest(spark.readStream.schema(b.schema).parquet(f"{tmp_path}/in")), lambda df, n: got.append(df.count()), f"{tmp_path}/state")
    assert sum(got) == 3


def test_no_nested_loops(spark, sf_dir):
    from tidemark.plans import catalog

    for name in ("k1_sync", "c4_resolve_symbol", "c3_members_asof", "c7_annotate_deltas", "e10_coverage_gaps", "c9_event_clock", "c10_closed_gap", "h1_trading_minutes", "h2_extended_minutes", "h3_sessions_back", "h5_dissemination", "h4_fomc", "i8_corporate_actions", "i9_html_to_text"):
        plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan, name
