"""Order within series by segments: plain versions, edges, plans, skew."""

import re
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import coverage, quality, segments

SERIES = "symbol string, timestamp timestamp, seq long, close double"
DAY = timedelta(days=1)


def at(days):
    return datetime(2024, 1, 1) + timedelta(days=days)


def plain_neighbours(rows):
    """{seq: (close before, close after)} of rows (symbol, timestamp, seq, close) with distinct times."""
    out = {}
    for s in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == s), key=lambda r: r[1])
        for i, r in enumerate(own):
            out[r[2]] = (own[i - 1][3] if i else None, own[i + 1][3] if i + 1 < len(own) else None)
    return out


closes = st.one_of(st.none(), st.floats(-5, 5))
series = st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.integers(0, 400), closes), max_size=40, unique_by=lambda r: r[:2])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(series)
def test_neighbours_and_carried_like_plain_ones(spark, rows):
    rows = [(s, at(d), i, c) for i, (s, d, c) in enumerate(rows)]
    df = spark.createDataFrame(rows, SERIES)
    got = segments.neighbours(df, ["symbol"], {"before": "close"}, {"after": "close"})
    assert got.columns == [*df.columns, "before", "after"]
    assert {r.seq: (r.before, r.after) for r in got.collect()} == plain_neighbours(rows)
    last = {}
    for s in {r[0] for r in rows}:
        held = None
        for r in sorted((r for r in rows if r[0] == s), key=lambda r: r[1]):
            held = r[3] if r[3] is not None else held
            last[r[2]] = held
    assert {r.seq: r.held for r in segments.carried(df, ["symbol"], "close", "held").collect()} == last


def test_edges_between_segments(spark):
    """The last row of a month is the one before the first of the next month that has rows, however many are empty."""
    days = [30, 31, 150, 366]  # 31 January, 1 February, end of May, next January
    df = spark.createDataFrame([("A", at(d), i, float(i)) for i, d in enumerate(days)], SERIES)
    rows = segments.neighbours(df, ["symbol"], {"before": "seq", "since": "timestamp"}, {"after": "seq"}).orderBy("seq").collect()
    assert [(r.before, r.after) for r in rows] == [(None, 1), (0, 2), (1, 3), (2, None)]
    assert [r.since for r in rows] == [None, *[at(d) for d in days[:3]]]
    numbers = spark.createDataFrame([("A", at(0), n, 0.0) for n in (0, segments.SPAN - 1, segments.SPAN, 5 * segments.SPAN)], SERIES)
    rows = segments.neighbours(numbers, ["symbol"], {"before": "seq"}, by="seq").orderBy("seq").collect()
    assert [r.before for r in rows] == [None, 0, segments.SPAN - 1, segments.SPAN]
    with pytest.raises(ValueError):
        segments.segment(df, "symbol")


def test_nulls_ties_and_nothing(spark):
    df = spark.createDataFrame([("A", None, 0, 1.0), ("A", at(0), 1, 2.0), ("A", at(0), 2, 3.0), (None, at(0), 3, 4.0)], SERIES)
    assert {r.seq: r.before for r in segments.neighbours(df, ["symbol"], {"before": "close"}).collect()} == {0: None, 1: 1.0, 2: 2.0, 3: None}
    assert segments.neighbours(df.limit(0), ["symbol"], {"before": "close"}).count() == 0
    assert quality.classify_gaps(df.limit(0), 1).count() == 0


def test_gaps_and_moves_over_edges(spark):
    times = [datetime(2024, 1, 31, 23, 58), datetime(2024, 1, 31, 23, 59), datetime(2024, 2, 1), datetime(2024, 2, 1, 0, 5)]
    df = spark.createDataFrame([("A", t, 1.0, 2.0, 0.5, c, 1.0) for t, c in zip(times, (1.0, 1.0, 1.5, 1.5), strict=True)], "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double")
    assert [(r.timestamp, r.next_ts) for r in quality.detect_gaps(df, 1).collect()] == [(times[2], times[3])]
    qa = quality.run_bar_qa(df).first()
    assert qa.extreme_moves == 1 and qa.non_monotonic_ts == 0
    assert quality.validate_ohlc(df).first().warnings == ["price_spike"]
    report = quality.audit(df, "1m").first()
    assert (report.bars, report.gap_count, len(report.first_gaps)) == (4, 1, 1)
    hourly, rejected = quality.normalize_hourly(spark.createDataFrame([("A", datetime(2024, 1, 31, 22), 1.0, 1.0, 1.0, 7.0, 1.0), ("A", datetime(2024, 2, 1, 2), 1.0, 1.0, 1.0, 9.0, 1.0)], df.schema))
    assert [r.close for r in hourly.orderBy("timestamp").collect()] == [7.0, 7.0, 7.0, 7.0, 9.0] and rejected.count() == 0


def minute_bars(spark, n):
    """One series of n one-minute bars from 2000 on."""
    c = (F.col("id") % 97).cast("double")
    return spark.range(0, n, 1, 8).select(F.lit("A").alias("symbol"), F.timestamp_seconds(F.lit(946684800) + F.col("id") * 60).alias("timestamp"), c.alias("open"), (c + 1).alias("high"), c.alias("low"), c.alias("close"), F.lit(1.0).alias("volume"), F.col("id").alias("seq"))


def windows(df):
    """The partition columns of each window of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x).split(", ") for x in re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)]


def test_no_window_has_a_whole_series(spark):
    df = minute_bars(spark, 10)
    cov = spark.createDataFrame([("A", at(0), at(1))], "symbol string, start_ts timestamp, end_ts timestamp")
    plans = {
        "qa": quality.run_bar_qa(df, seq="seq"), "ohlc": quality.validate_ohlc(df), "series": quality.validate_series(df), "issues": quality.validation_issues(df, "1m", seq="seq"), "gaps": quality.detect_gaps(df, 1), "audit": quality.audit(df, "1m"),
        "classes": quality.classify_gaps(df, 1), "internal": quality.detect_internal_gaps(df, "1m"), "monotonic": quality.is_monotonic(df, "seq"), "policy": quality.detect_gap_policy(df), "hourly": quality.normalize_hourly(df)[0], "move": quality.pct_move(df, "m"),
        "merged": coverage.merge_ranges(cov), "uncovered": coverage.coverage_gaps(cov, "2024-01-01", "2024-02-01"), "inside": coverage.inside_any(df, cov, "start_ts", "end_ts"),
    }
    for name, df in plans.items():
        found = windows(df)
        assert found and all("_segment" in w or "timestamp" in w for w in found), (name, found)


def test_one_long_series_is_many_tasks(spark):
    n = 1_000_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = segments.neighbours(minute_bars(spark, n), ["symbol"], {"before": "seq"}).withColumn("part", F.spark_partition_id())
        rows = out.groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("before") == F.col("seq") - 1).alias("good")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in rows) == n and sum(r.good for r in rows) == n - 1 and max(r.n for r in rows) < 0.6 * n


spans = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 300), st.integers(0, 60)), max_size=30)
COVERAGE = "symbol string, start_ts timestamp, end_ts timestamp"


def plain_merge(ranges):
    out = []
    for s, a, b in sorted(ranges):
        if out and out[-1][0] == s and a <= out[-1][2]:
            out[-1] = (s, out[-1][1], max(out[-1][2], b))
        else:
            out.append((s, a, b))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(spans, st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(-10, 370)), max_size=30))
def test_interval_sets_like_plain_ones(spark, ranges, points):
    ranges = [(s, a, a + n) for s, a, n in ranges]
    cov = spark.createDataFrame([(s, at(a), at(b)) for s, a, b in ranges], COVERAGE)
    merged = plain_merge(ranges)
    assert sorted(tuple(r) for r in coverage.merge_ranges(cov).collect()) == sorted((s, at(a), at(b)) for s, a, b in merged)
    lo, hi = 50, 280
    bare = {(s, d) for s in {r[0] for r in ranges} for d in range(lo, hi)} - {(s, d) for s, a, b in ranges for d in range(a, b)}
    gaps = [(r.symbol, (r.gap_start - at(0)) // DAY, (r.gap_end - at(0)) // DAY) for r in coverage.coverage_gaps(cov, str(at(lo)), str(at(hi))).collect()]
    found = [(s, d) for s, a, b in gaps for d in range(a, b)]
    assert len(found) == len(set(found)) and set(found) == bare
    rows = spark.createDataFrame([(s, at(d), i) for i, (s, d) in enumerate(points)], "symbol string, timestamp timestamp, n long")
    inside = coverage.inside_any(rows, cov, "start_ts", "end_ts")
    assert inside.columns == rows.columns
    assert sorted(r.n for r in inside.collect()) == [i for i, (s, d) in enumerate(points) if any(s == x and a <= d < b for x, a, b in ranges)]


def test_a_million_ranges_of_one_symbol(spark):
    n = 1_000_000
    start = F.timestamp_seconds(F.lit(0) + F.col("id") * 3600)
    hours = F.when(F.col("id") % 1000 == 999, 1).otherwise(2)  # the last of each thousand leaves no gap behind it, the next but one starts apart
    cov = spark.range(0, n, 1, 8).where("id % 1000 != 500").select(F.lit("A").alias("symbol"), start.alias("start_ts"), (start + F.make_interval(hours=hours)).alias("end_ts"))
    out = coverage.merge_ranges(cov).agg(F.count("*"), F.min("start_ts"), F.max("end_ts")).first()
    assert out[0] == 1  # a range of two hours reaches over the missing one
    narrow = cov.withColumn("end_ts", F.col("start_ts") + F.expr("interval 1 hour"))
    assert coverage.merge_ranges(narrow).count() == 1001


def test_a_long_gap_is_one_row(spark):
    gap = spark.createDataFrame([("A", datetime(1800, 1, 1), datetime(2200, 1, 1))], "symbol string, gap_start timestamp, gap_end timestamp")
    rows = minute_bars(spark, 1000)
    inside = coverage.inside_any(rows, gap)
    assert inside.count() == 1000 and "Generate explode" not in inside._jdf.queryExecution().executedPlan().toString()


def test_digest_of_timestamps_in_order(spark):
    """Against the digest of one text; repeated and missing times, null series, and a long series in small batches."""
    import hashlib

    rows = [("A", at(d), i, 0.0) for i, d in enumerate((3, 1, 1, 40, 2))] + [("A", None, 9, 0.0), (None, at(5), 10, 0.0), ("B", None, 11, 0.0)]
    got = {r.symbol: r for r in coverage.coverage_observation(spark.createDataFrame(rows, SERIES), "2024-01-03", "2024-01-31").collect()}
    digest = lambda *days: hashlib.sha256("\n".join(at(d).isoformat(timespec="microseconds") for d in days).encode()).hexdigest()
    assert tuple(got["A"])[1:] == (6, 5, 1, 3, at(1), at(40), digest(1, 1, 2, 3, 40))
    assert got[None].sha256 == digest(5) and tuple(got["B"])[1:] == (1, 1, 0, 0, None, None, digest())
    assert coverage.coverage_observation(spark.createDataFrame([], SERIES), "2024-01-03", "2024-01-31").count() == 0
    n = 300_000
    long = coverage.coverage_observation(minute_bars(spark, n), "2000-01-01", "2000-01-02").first()
    whole = hashlib.sha256("\n".join((datetime(2000, 1, 1) + timedelta(minutes=k)).isoformat(timespec="microseconds") for k in range(n)).encode()).hexdigest()
    assert (long.rows, long.outside_window, long.sha256) == (n, n - 1440, whole)
