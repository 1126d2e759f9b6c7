"""What the findings of round 3 were about."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.plans import catalog


def same(spark, same_as_sql, name, folder):
    same_as_sql(catalog.queries()[name], catalog.oracle_sql()[name], folder)


def folder_of(spark, tmp_path, sf_dir, **tables):
    """A copy of the test tables in which some are replaced."""
    import os

    for t in os.listdir(sf_dir):
        os.symlink(f"{sf_dir}/{t}", f"{tmp_path}/{t}")
    for name, df in tables.items():
        pdf = df.toPandas()
        os.unlink(f"{tmp_path}/{name}.parquet")
        pdf.to_parquet(f"{tmp_path}/{name}.parquet", index=False, coerce_timestamps="us")
    return str(tmp_path)


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_audit_of_a_series_without_gaps(spark, tmp_path, sf_dir, same_as_sql):
    """a series that has every minute, one with a gap and one of a single bar."""
    rows = [(m, datetime(2024, 1, 1, 0, m), 1, "click", 1.0, "") for m in range(5)] + [(10 + m, datetime(2024, 1, 1, 0, m), 1, "view", 1.0, "") for m in (0, 1, 7)] + [(20, datetime(2024, 1, 1), 1, "cart", 1.0, "")]
    same(spark, same_as_sql, "d9_audit", folder_of(spark, tmp_path, sf_dir, events=events(spark, rows)))


def test_pages_cut_inside_a_reference(spark, tmp_path, sf_dir, same_as_sql):
    """the query keeps references without a semicolon, as its SQL does; the operator replaces them unless it is told not to."""
    from tidemark.operators.filings import html_to_text

    html = ["<title>one&amp;&amp</title><p>two &copy; &quot;three&quot;</p>", "<title>&am</title>", "<p>a &amp</p><p>b &middot c</p>"]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    same(spark, same_as_sql, "i9_html_to_text", folder_of(spark, tmp_path, sf_dir, pages=pages))
    one = spark.createDataFrame([("a&amp &#38 &#38; &lt;",)], "t string").select(html_to_text(F.col("t")).alias("html"), html_to_text(F.col("t"), ended=True).alias("ended")).first()
    assert (one.html, one.ended) == ("a& & & <", "a&amp &#38 & <")


def test_ticks_of_one_series_and_time(spark, tmp_path, sf_dir, same_as_sql):
    """ticks with the same time, of equal and of different prices, are all kept."""
    at = datetime(2024, 1, 1, 10)
    rows = [(1, at, 1, "click", 1.0, ""), (2, at, 1, "click", 2.0, ""), (3, at, 2, "click", 2.0, ""), (4, at, 1, "view", 1.0, ""), (5, datetime(2024, 1, 2), 1, "view", 1.0, "")]
    same(spark, same_as_sql, "k8_stream_ingest", folder_of(spark, tmp_path, sf_dir, events=events(spark, rows)))


def test_a_tick_that_comes_again(spark, tmp_path):
    """a repeated event is one tick, within a batch, over batches and in the table."""
    from tidemark.sources import tables
    from tidemark.streaming import bars as streams

    at = datetime(2024, 1, 1, 10)
    kind = "symbol string, timestamp timestamp, event_id long, open double, high double, low double, close double, volume long"
    tick = lambda i, p: ("A", at, i, p, p, p, p, 1)
    for k, rows in enumerate(([tick(1, 5.0), tick(2, 5.0), tick(1, 5.0)], [tick(2, 5.0), tick(3, 6.0)])):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.ingest(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), keys=("symbol", "event_id"))
        streams.run(stream, streams.bar_sink(f"file://{tmp_path}/bars", f"file://{tmp_path}/s{k}", "t", {"provider": "p", "timeframe": "tick"}, ["event_id"]), f"file://{tmp_path}/checkpoint")
    assert sorted((r.event_id, float(r.close)) for r in tables.bar_table(spark, f"file://{tmp_path}/bars", ["event_id"]).collect()) == [(1, 5.0), (2, 5.0), (3, 6.0)]


def test_actions_of_repeated_documents(spark):
    """a document's type is read once, actions are shuffled once, and the first by document and excerpt stays."""
    from tidemark.operators import filings

    two = "A two-for-one stock split. Cash  \t dividend.  A two-for-one stock split; trading will begin on a split-adjusted basis on May 3,\n 2021. Cash dividend of $1 per share. cash dividend of $1 per share, again"
    docs = spark.createDataFrame([("a", "8-K", "x", n, two) for n in (1, 0)], "accession string, document_type string, filename string, document_no int, document string")
    out = filings.corporate_actions(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    raw = spark.createDataFrame([("a", "")], "accession string, text string")
    assert filings.corporate_actions(filings.split_documents(raw))._jdf.queryExecution().optimizedPlan().toString().count("<TYPE>") == 1
    got = sorted((r.corporate_action_type, r.document_no, str(r.effective_date), str(r.cash_amount), r.excerpt.strip()) for r in out.collect())
    dated = "two-for-one stock split; trading will begin on a split-adjusted basis on May 3, 2021."
    assert got == [("cash_dividend", 0, "None", "1", "Cash dividend of $1 per share."), ("cash_dividend", 0, "None", "None", "Cash dividend. A"), ("stock_split", 0, "2021-05-03", "None", dated)]


def test_blanks_become_one_space(spark):
    """runs of blanks of all kinds, at the ends too, as one pattern of all blanks would make them."""
    import re

    from tidemark.operators import filings

    cases = ["a  b", " a\tb ", "\t a  　b\n", "a \x1c\x1fb\x85", "   a", "a b c", "  ", "\t"]
    got = [r.x for r in spark.createDataFrame(list(enumerate(cases)), "i int, t string").select("i", filings.html_to_text(F.col("t")).alias("x")).orderBy("i").collect()]
    assert got == [re.sub(r"\s+", " ", c).strip(" ") for c in cases]


def test_a_sync_makes_each_step_from_the_staged_ones(spark, tmp_path, monkeypatch):
    """F5, F6, F8, F12: gaps are worked out for the claims only, and a first append stages its rows once."""
    from tidemark.operators import ingest
    from tidemark.sources import tables

    seen, step = {}, ingest._step
    monkeypatch.setattr(ingest, "_step", lambda s, path, make: step(s, path, lambda: seen.setdefault(path.rsplit("/", 1)[-1], make())))
    staged, replace = [], tables._replace
    monkeypatch.setattr(tables, "_replace", lambda s, path, staging, make: replace(s, path, staging, lambda: (out := make(), staged.append((out[0] is None, tables.exists(s, f"{staging}/new"))))[0]))
    kind = "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double"
    landing = spark.createDataFrame([("A", datetime(2025, 1, d), 1.0, 1.0, 1.0, 1.0, 1.0) for d in (1, 2, 3, 9)], kind)
    root = f"file://{tmp_path}"
    ingest.run_sync(spark.createDataFrame([("A",), ("B",)], "symbol string"), landing, root, "one", "2025-01-02", "2025-01-03", "p", "1d")
    for name in ("rows", "report"):
        assert "coverage-before" not in " ".join(seen[name].inputFiles()), name
    assert staged == [(True, False)]
    assert sorted(r.timestamp.day for r in tables.bar_table(spark, f"{root}/bars").collect()) == [2, 3]


def test_deltas_hold_no_list_of_members(spark, sf_dir):
    """no plan of membership changes gathers members or puts them into one window; results are those of arrays."""
    from tidemark.operators import universe

    for name in ("c5_cross_check", "c7_annotate_deltas", "e9_membership_deltas"):
        assert "collect_" not in catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString(), name
    days = [datetime(2025, m, 1).date() for m in range(1, 7)]
    lists = {"x": [["A", "B"], ["B", "C", "C", None], [], ["A"], None, ["A", "D"]], None: [["A"], ["A"], ["B"]]}
    rows = [(source, day, tickers) for source, each in lists.items() for day, tickers in zip(days, each, strict=False)]
    got = sorted((str(r.source), r.date.month, str(r.symbol), r.action, r.prev_snapshot_date.month) for r in universe.membership_deltas(spark.createDataFrame(rows, "source string, date date, tickers array<string>")).collect())
    want = [("x", 2, "C", "added", 1), ("x", 2, "None", "added", 1), ("x", 2, "A", "removed", 1), *[("x", 3, s, "removed", 2) for s in ("B", "C", "None")], ("x", 4, "A", "added", 3), ("None", 3, "B", "added", 2), ("None", 3, "A", "removed", 2)]
    assert got == sorted(want)


def test_ticks_are_summed_up_before_they_reach_the_state(spark, monkeypatch):
    """a row per bucket of what a task holds, equal to plain sums whenever it is emptied; closing rows go."""
    import random
    from decimal import Decimal

    import pyarrow as pa

    from tidemark.streaming import bars as streams

    r, price = random.Random(9), pa.decimal128(18, 8)
    ticks = [(r.choice(["A", "B", None]), 3600 * r.randrange(4), 10 * r.randrange(30), Decimal(r.randrange(900)) / 8, r.randrange(5)) for _ in range(2000)]
    schema = pa.schema([("symbol", pa.string()), pa.field("bucket", pa.int64(), False), ("open_at", pa.int64()), *[(c, price) for c in ("open", "high", "low")], ("close_at", pa.int64()), ("close", price), pa.field("volume", pa.int64(), False), ("closing", pa.bool_())])
    row = lambda s, b, t, p, v, closing=False: dict(symbol=s, bucket=b, open_at=t, open=p, high=p + 1, low=p - 1, close_at=t, close=p, volume=v, closing=closing)
    batches = pa.Table.from_pylist([row(*t) for t in ticks] + [row("Z", 0, 0, Decimal(1), 1, True)], schema).to_batches(max_chunksize=100)
    want = {}
    for s, b, t, p, v in ticks:
        o, h, lo, c, n = want.get((s, b), ((t, p), p, p, (t, p), 0))
        want[s, b] = (min(o, (t, p)), max(h, p), min(lo, p), max(c, (t, p)), n + v)
    for held, emptied in ((10**6, False), (300, False), (8, True)):
        monkeypatch.setattr(streams, "HELD", held)
        out = pa.Table.from_batches(streams._sum_up(["symbol", "bucket"])(iter(batches)), schema.remove(9)).to_pylist()
        assert len(out) > len(want) if emptied else len(out) == len(want)
        got = {}
        for x in out:
            o, h, lo, c, n = got.get(key := (x["symbol"], x["bucket"]), ((x["open_at"], x["open"]), x["high"], x["low"], (x["close_at"], x["close"]), 0))
            got[key] = (min(o, (x["open_at"], x["open"])), max(h, x["high"]), min(lo, x["low"]), max(c, (x["close_at"], x["close"])), n + x["volume"])
        assert {k: (o, h - 1, lo + 1, c, n) for k, (o, h, lo, c, n) in got.items()} == want


def test_a_batch_is_worked_through_once(spark, tmp_path):
    """rows are summed up before the shuffle to the state; a batch that is merged into bars updates each page of it once.

    A bucket takes rows, in any tasks, until the watermark has passed its end.
    """
    from decimal import Decimal

    from tidemark.sources import tables
    from tidemark.streaming import bars as streams

    kind = "symbol string, timestamp timestamp, open decimal(18,8), high decimal(18,8), low decimal(18,8), close decimal(18,8), volume long, closing boolean"
    tick = lambda s, h, m, p: (s, datetime(2024, 1, 1, h, m), *[Decimal(p)] * 4, 1, False)
    bars, sink = f"file://{tmp_path}/bars", streams.bar_sink(f"file://{tmp_path}/bars", f"file://{tmp_path}/staging", "t", {"provider": "p", "timeframe": "1h"})

    def run(*rows, tasks=1):
        df = spark.createDataFrame(rows, kind) if rows else streams.closing(spark, spark.createDataFrame([], kind).schema)
        df.repartition(tasks).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.corrected_roll_up(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), "1h", corrections="2 hours")
        query = streams.run(stream, sink, f"file://{tmp_path}/checkpoint")
        return query, [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]

    query, updated = run(*[tick(s, 0, m, m + 1) for s in "AB" for m in range(1, 60)], tick("A", 2, 30, 5))
    assert updated == [2]  # the pages of A and B
    plan = query._jsq.explainInternal(False)
    assert plan.index("TransformWithState") < plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")
    run(tick("A", 0, 0, 9), tick("A", 0, 40, 8), tick("A", 0, 59, 70), tasks=3)  # the watermark is 0:30
    run()
    assert sorted((r.symbol, r.timestamp.hour, *map(float, (r.open, r.high, r.low, r.close, r.volume))) for r in tables.bar_table(spark, bars).collect()) == [("A", 0, 9.0, 70.0, 2.0, 70.0, 62.0), ("A", 2, 5.0, 5.0, 5.0, 5.0, 1.0), ("B", 0, 2.0, 60.0, 2.0, 60.0, 59.0)]
