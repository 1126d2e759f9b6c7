"""Runs that stop half way: synchronisation, cached roll-ups, deletions, streams."""

import shutil
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ingest, rollup
from tidemark.sources import tables
from tidemark.streaming import bars as streams

LANDING = "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double"


def at(*x):
    return datetime(*x)


def day(symbol, d, close, volume=1.0):
    return (symbol, at(2025, 1, d), close, close, close, close, volume)


def stored(spark, root):
    return sorted((r.symbol, r.timestamp.day, float(r.close)) for r in tables.bar_table(spark, f"{root}/bars").collect())


def covered(spark, root):
    return sorted((r.symbol, r.start_ts.day, r.end_ts.day) for r in ingest.read_coverage(spark, root).collect())


@pytest.fixture
def landing(spark):
    rows = [day(s, d, float(d)) for s in ("A", "B") for d in range(1, 11)] + [day("C", 3, 3.0, -1.0)]
    return spark.createDataFrame(rows, LANDING)


@pytest.fixture
def universe(spark):
    return spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "symbol string")


def sync(universe, landing, root, run, first, last, **how):
    report = ingest.run_sync(universe, landing, root, run, f"2025-01-{first:02}", f"2025-01-{last:02}", "p", "1d", **how)
    return sorted(tuple(r) for r in report.select("symbol", "status", "rows", "gaps").collect())


def test_sync_writes_bars_and_then_coverage(spark, tmp_path, universe, landing):
    root = f"file://{tmp_path}"
    assert sync(universe, landing, root, "one", 3, 5) == [("A", "ok", 3, 1), ("B", "ok", 3, 1), ("C", "failed", 0, 1), ("D", "ok", 0, 1)]
    assert stored(spark, root) == [(s, d, float(d)) for s in "AB" for d in (3, 4, 5)]
    assert covered(spark, root) == [("A", 3, 6), ("B", 3, 6), ("D", 3, 6)]
    # only what is missing is loaded; the refused symbol is asked for again
    assert sync(universe, landing, root, "two", 1, 7) == [("A", "ok", 4, 2), ("B", "ok", 4, 2), ("C", "failed", 0, 1), ("D", "ok", 0, 2)]
    assert stored(spark, root) == [(s, d, float(d)) for s in "AB" for d in range(1, 8)]
    # a finished run returns its report and does nothing, even if the landing table has changed
    assert sync(universe, landing.where("symbol = 'A'").withColumn("close", F.lit(9.0)), root, "two", 1, 7)[1] == ("B", "ok", 4, 2)
    assert covered(spark, root) == [("A", 1, 8), ("B", 1, 8), ("D", 1, 8)]


def test_a_forced_sync_replaces_bars_and_their_coverage(spark, tmp_path, universe, landing):
    root = f"file://{tmp_path}"
    sync(universe, landing, root, "one", 1, 7)
    raised = landing.where("symbol = 'A'").withColumns({c: F.col(c) + 1 for c in ("open", "high", "low", "close")})
    assert sync(universe.where("symbol = 'A'"), raised, root, "two", 2, 3, force=True) == [("A", "ok", 2, 1)]
    assert stored(spark, root) == [("A", 2, 3.0), ("A", 3, 4.0)] + [("B", d, float(d)) for d in range(1, 8)]
    assert covered(spark, root) == [("A", 2, 4), ("B", 1, 8), ("D", 1, 8)]


@pytest.fixture(scope="module")
def synced(spark, tmp_path_factory):
    """A root in which one run has finished."""
    folder = tmp_path_factory.mktemp("synced")
    u = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "symbol string")
    sync(u, spark.createDataFrame([day(s, d, float(d)) for s in ("A", "B") for d in range(1, 11)], LANDING), f"file://{folder}", "one", 3, 4)
    return folder


@pytest.mark.parametrize("step", range(6))
def test_sync_stops_after_any_step_and_goes_on(spark, tmp_path, universe, landing, monkeypatch, synced, step):
    """Before each step, and in the write of bars between staging and replacing; coverage never claims what is not stored."""
    shutil.copytree(synced, tmp_path / "copy")
    root = f"file://{tmp_path}/copy"
    with monkeypatch.context() as m:
        calls, make = [], ingest._step

        def stops(spark_, path, table):
            calls.append(path)
            if len(calls) > step:
                raise OSError("stopped")
            return make(spark_, path, table)

        if step == 5:
            m.setattr(tables, "_write", lambda *x: (_ for _ in ()).throw(OSError("stopped")))
        else:
            m.setattr(ingest, "_step", stops)
        with pytest.raises(OSError):
            sync(universe, landing, root, "two", 1, 6)
    held = {(s, d) for s, d, _ in stored(spark, root)}
    assert all((s, d) in held for s, a, b in covered(spark, root) if s in "AB" for d in range(a, b))
    assert sync(universe, landing, root, "two", 1, 6) == [("A", "ok", 4, 2), ("B", "ok", 4, 2), ("C", "ok", 0, 2), ("D", "ok", 0, 2)]
    assert stored(spark, root) == [(s, d, float(d)) for s in "AB" for d in range(1, 7)]
    assert covered(spark, root) == [("A", 1, 7), ("B", 1, 7), ("C", 1, 7), ("D", 1, 7)]


def test_an_interrupted_replacement_takes_what_was_staged(spark, tmp_path, landing, monkeypatch):
    """A folder that was lost between its removal and its replacement is written from the staged rows."""
    path, series = f"file://{tmp_path}/bars", {"provider": F.lit("p"), "timeframe": F.lit("1d")}
    b = landing.where("symbol = 'A'").withColumns(series)
    tables.write_bars(b.where("day(timestamp) < 6"), path, f"file://{tmp_path}/s1")

    def lose(df, where):
        fs = tables.exists_in(spark, where)
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{where}/provider=p"), True)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "_write", lose)
        with pytest.raises(OSError):
            tables.write_bars(b.where("day(timestamp) >= 6"), path, f"file://{tmp_path}/s2")
    assert not tables.has_bars(spark, path)
    tables.write_bars(b.where("day(timestamp) >= 6"), path, f"file://{tmp_path}/s2")
    assert tables.bar_table(spark, path).count() == 10


def test_a_table_has_few_folders_however_many_series(spark, tmp_path):
    path = f"file://{tmp_path}/bars"
    b = spark.range(500).select(F.concat(F.lit("S/"), F.col("id") % 250).alias("symbol"), F.timestamp_seconds(F.col("id") * 86400).alias("timestamp"), *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")], F.lit("p").alias("provider"), F.lit("1d").alias("timeframe"))
    tables.write_bars(b, path, f"file://{tmp_path}/s")
    folders = tables.bar_table(spark, path).select(*tables.PARTS).distinct().count()
    assert folders <= 2 * tables.BUCKETS
    keys = b.where("symbol like '%1'").select("provider", "symbol", "timeframe")
    assert tables.delete_series(spark, path, keys) == b.where("symbol like '%1'").count()
    left = tables.bar_table(spark, path)
    assert left.count() == b.where("symbol not like '%1'").count() and tables.list_series(left).count() == 225
    assert tables.read_bars(spark, path, "p", "S/7", "1d", "1970-01-01", "1970-12-31").count() == 2
    n = left.count()
    assert tables.delete_series(spark, path, tables.list_series(left)) == n and tables.bar_table(spark, path).count() == 0


def test_a_cached_roll_up_is_gone_on_with(spark, tmp_path):
    path = f"file://{tmp_path}/bars"
    minute = spark.range(0, 1200).select(F.lit("A").alias("symbol"), F.timestamp_seconds(1704067200 + F.col("id") * 60).alias("timestamp"), *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close")], F.lit(1.0).alias("volume"), F.lit("p").alias("provider"), F.lit("1m").alias("timeframe"))
    calls = iter(range(100))
    hours = lambda: tables.cached_rollup(spark, path, f"file://{tmp_path}/h{next(calls)}", "p", "1h")
    tables.write_bars(minute.where("hour(timestamp) < 5 or hour(timestamp) = 5 and minute(timestamp) < 30"), path, f"file://{tmp_path}/1")
    assert hours()[1] == 1 and hours()[1] == 0
    tables.write_bars(minute, path, f"file://{tmp_path}/2")
    out, n = hours()
    assert n == 1 and hours()[1] == 0
    want = rollup.aggregate_bars(minute, "1h", ("symbol", "provider"))
    row = lambda r: (r.symbol, r.timestamp, float(r.open), float(r.close), float(r.volume))
    assert sorted(map(row, out.collect())) == sorted(map(row, want.collect()))


TICKS = "symbol string, timestamp timestamp, open decimal(18,8), high decimal(18,8), low decimal(18,8), close decimal(18,8), volume long, closing boolean"


class Source:
    """A folder that a stream reads, a batch per file, and what it has emitted."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.log = spark, folder, []

    def add(self, *rows):
        row = lambda s, h, m, p: (s, at(2024, 1, 1, h, m), Decimal(p), Decimal(p + 1), Decimal(p - 1), Decimal(p), 1, False)
        self.write(self.spark.createDataFrame([row(*r) for r in rows], TICKS))

    def close(self):
        self.write(streams.closing(self.spark, self.spark.createDataFrame([], TICKS).schema))

    def write(self, df):
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def stream(self):
        return self.spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")

    def run(self, **how):
        streams.run(streams.corrected_roll_up(self.stream(), "1h", **how), lambda df, n: self.log.extend((r.symbol, r.timestamp.hour, int(r.open), int(r.high), int(r.low), int(r.close), r.volume, r.version) for r in df.collect()), f"file://{self.folder}/state")

    def states(self):
        return self.spark.read.format("statestore").option("stateVarName", "page").load(f"file://{self.folder}/state").count()


def test_a_stream_corrects_its_bars_and_ends_empty(spark, tmp_path):
    s = Source(spark, tmp_path)
    s.add(("A", 0, 5, 1), ("A", 0, 30, 5), ("B", 0, 59, 4))
    s.run()
    assert s.log == [] and s.states() == 2
    s.add(("A", 1, 20, 7))  # ten minutes past the hour, so it is whole
    s.run()
    assert sorted(s.log) == [("A", 0, 1, 6, 0, 5, 2, 0), ("B", 0, 4, 5, 3, 4, 1, 0)]
    s.add(("A", 0, 1, 9), ("A", 0, 2, 3))  # late: one correction for both
    s.run()
    assert s.log[2:] == [("A", 0, 9, 10, 0, 5, 4, 1)]
    s.close()
    s.run()
    assert s.log[3:] == [("A", 1, 7, 8, 6, 7, 1, 0)] and s.states() == 0


def test_rows_beyond_corrections_are_dropped(spark, tmp_path):
    s = Source(spark, tmp_path)
    s.add(("A", 0, 5, 1))
    s.run(corrections="2 hours")
    s.add(("A", 9, 0, 2))
    s.run(corrections="2 hours")
    s.add(("A", 0, 6, 7))
    s.close()
    s.run(corrections="2 hours")
    assert sorted(s.log) == [("A", 0, 1, 2, 0, 1, 1, 0), ("A", 9, 2, 3, 1, 2, 1, 0)] and s.states() == 0


def test_a_restarted_stream_emits_the_same(spark, tmp_path):
    """One run over all files, and a run for each file."""
    parts = [[("A", h, 10 * k, h + k) for h in range(3)] for k in range(4)]
    once, often = Source(spark, tmp_path / "once"), Source(spark, tmp_path / "often")
    for rows in parts:
        once.add(*rows)
        often.add(*rows)
        often.run()
    for s in (once, often):
        s.close()
        s.run()
    last = lambda s: {r[:2]: r[2:7] for r in sorted(s.log, key=lambda r: r[-1])}
    assert last(once) == last(often) == {("A", h): (h, h + 4, h - 1, h + 3, 4) for h in range(3)}


def test_a_repeated_batch_is_merged_once(spark, tmp_path, monkeypatch):
    """The stream dies after its batch was written and before the checkpoint; and while it is being written."""
    b = spark.createDataFrame([("A", at(2024, 1, 1, 0, m), 1.0, 2.0, 0.5, 1.0, 1) for m in range(3)], "symbol string, timestamp timestamp, open double, high double, low double, close double, volume long")
    b.write.parquet(f"{tmp_path}/in")
    path, series = f"file://{tmp_path}/bars", {"provider": "s", "timeframe": "1m"}
    sink = streams.bar_sink(path, f"file://{tmp_path}/staging", "ticks", series)
    go = lambda f: streams.run(spark.readStream.schema(b.schema).parquet(f"{tmp_path}/in"), f, f"file://{tmp_path}/state")

    def dies(df, n):
        sink(df, n)
        raise OSError("died")

    with monkeypatch.context() as m:
        m.setattr(tables, "_write", lambda *x: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(Exception, match="died"):
            go(sink)
    with pytest.raises(Exception, match="died"):
        go(dies)
    assert tables.bar_table(spark, path).count() == 3
    writes = []
    monkeypatch.setattr(tables, "write_bars", lambda *x: writes.append(x))
    go(sink)
    assert tables.bar_table(spark, path).count() == 3 and not writes
    sink(b, 1)
    assert len(writes) == 1


def test_gaps_of_an_update_are_counted(spark):
    series = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "symbol string")
    rows = lambda *x: spark.createDataFrame([(s, at(2025, 1, d)) for s, d in x], "symbol string, timestamp timestamp")
    landing = rows(("A", 2), ("B", 2), ("C", 2)).withColumn("quarantine", F.when(F.col("symbol") == "C", "close"))
    have = rows(*[("A", d) for d in (2, 3, 6, 8)], ("B", 4))
    got = {r.symbol: (r.status, r.rows, r.gaps) for r in ingest.update_many(series, landing, "2025-01-01", "2025-01-09", have).collect()}
    assert got == {"A": ("ok", 1, 4), "B": ("ok", 1, 1), "C": ("failed", 0, 0), "D": ("skipped", 0, 0)}
