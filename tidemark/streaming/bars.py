"""Structured streams of bars."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.schemas import OHLC, minutes
from tidemark.sources import tables

#: The time of the row that closes an input, later than all others; workers hold times as nanoseconds, which end in 2262.
CLOSING = "2261-01-01"


def broken_rules() -> Column:
    """The OHLC rules that a row breaks, and nulls that keep them from being tested."""
    c = F.col
    rules = {"null_value": F.greatest(*[c(x).isNull() for x in (*OHLC, "volume", "timestamp")]), "high_lt_low": c("high") < c("low"), "high_lt_open_close": c("high") < F.greatest("open", "close"), "low_gt_open_close": c("low") > F.least("open", "close"), "negative_volume": c("volume") < 0}
    return F.array_compact(F.array(*[F.when(broken, name) for name, broken in rules.items()]))


def valid(bars: DataFrame) -> DataFrame:
    """Rows that keep the OHLC rules; refused() has the others."""
    return bars.where(F.size(broken_rules()) == 0)


def refused(bars: DataFrame) -> DataFrame:
    """Rows that valid() leaves out, with errors: a report that a stream of its own writes."""
    return bars.withColumn("errors", broken_rules()).where(F.size("errors") > 0)


def ingest(source: DataFrame, late: str = "1 day", keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Valid rows of a stream, the first per series and time; state is dropped once rows are later than late.

    Ticks may have a series and time in common: with their identifier among the keys each is kept once.
    """
    return valid(source).withWatermark("timestamp", late).dropDuplicatesWithinWatermark([*keys, "timestamp"])


def roll_up(source: DataFrame, timeframe: str, late: str = "10 minutes", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Bars of a coarser timeframe from a stream of bars, without Python.

    In append mode a bucket is emitted once, when the watermark has passed it, so that the last ones stay open. In update
    mode every batch emits the buckets that it changed, open ones too; latest() takes the last version of each.
    corrected_roll_up() closes the last ones itself and needs no pass afterwards.
    """
    window = F.window("timestamp", f"{minutes(timeframe)} minutes")
    out = source.withWatermark("timestamp", late).groupBy(*keys, window.alias("w")).agg(F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "timestamp").alias("close"), F.sum("volume").alias("volume"))
    return out.select(*keys, F.col("w.start").alias("timestamp"), *OHLC, "volume")


def latest(log: DataFrame, keys: Sequence[str] = ("symbol",), batch: str = "batch") -> DataFrame:
    """The last version of each bucket of a log of update batches: what the stream holds once its input has ended."""
    values = [c for c in log.columns if c not in (*keys, "timestamp", batch)]
    return log.groupBy(*keys, "timestamp").agg(F.max_by(F.struct(*values), batch).alias("v")).select(*keys, "timestamp", "v.*")


#: Buckets that share a key of the state; a long series is many keys.
PAGE = 64
#: Rows that a task holds while it sums up what it reads.
HELD = 500_000


def _summed(rows: pa.Table, by: list[str]) -> pa.Table:
    """A row per bucket: its first open and last close by time (then price, the least and the greatest), extremes and volume."""
    schema = rows.schema
    order = {c: pc.sort_indices(rows, sort_keys=[(f"{c}_at", "ascending"), (c, "ascending")]).to_numpy() for c in ("open", "close")}
    for c, places in order.items():
        rank = np.empty(len(places), "int64")
        rank[places] = np.arange(len(places))
        rows = rows.append_column(f"{c}_rank", pa.array(rank))
    out = rows.group_by(by).aggregate([("open_rank", "min"), ("close_rank", "max"), ("high", "max"), ("low", "min"), ("volume", "sum")])
    opens, closes = rows.take(order["open"][out["open_rank_min"].to_numpy()]), rows.take(order["close"][out["close_rank_max"].to_numpy()])
    columns = {"open_at": opens["open_at"], "open": opens["open"], "high": out["high_max"], "low": out["low_min"], "close_at": closes["close_at"], "close": closes["close"], "volume": out["volume_sum"]}
    return pa.Table.from_arrays([(out[f.name] if f.name in by else columns[f.name]).cast(f.type) for f in schema], schema=schema)


def _sum_up(by: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums up the rows of a task by bucket, so that few rows reach the state, in memory for HELD of them. Closing rows go."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]).filter(pc.invert(batch["closing"])).drop_columns("closing"))
            n += len(held[-1])
            if n >= HELD:
                held = [_summed(pa.concat_tables(held), by)]
                n = len(held[0])
                if n >= HELD // 2:  # many buckets: the next rows are unlikely to meet them
                    yield from held.pop().to_batches()
                    n = 0
        if n:
            yield from _summed(pa.concat_tables(held), by).to_batches()

    return sums


class Buckets(StatefulProcessor):
    """State of PAGE buckets of a series: the bar of each so far, the times of its open and close, and how often it was emitted.

    Its input are sums of rows by bucket (_sum_up), as Spark hands rows to it one by one. Sums of a bucket that the watermark
    has passed are left out. A timer waits for the first bucket that is not emitted; when it passes, all that are due are. Rows that come later, but
    before the page's last timer, emit a bucket again as a correction; that timer drops the page.
    """

    def __init__(self, state: T.StructType, keys: Sequence[str], step_ms: int, wait_ms: int):
        self.state, self.keys, self.step_ms, self.wait_ms = state, list(keys), step_ms, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.page = handle, handle.getValueState("page", self.state)

    def _emitted(self, key: tuple, bars: dict[int, tuple], which: list[int]) -> pd.DataFrame:
        rows = []
        for bucket in which:
            _, opened, high, low, _, close, volume, version = bars[bucket]
            rows.append((*key[:-1], bucket, opened, high, low, close, volume, version))
            bars[bucket] = (*bars[bucket][:-1], version + 1)
        return pd.DataFrame(rows, columns=[*self.keys, "bucket", *OHLC, "volume", "version"])

    def _wait(self, bars: dict[int, tuple]) -> None:
        waiting = [b for b, bar in bars.items() if not bar[-1]]
        if waiting:
            self.handle.registerTimer(min(waiting) * 1000 + self.wait_ms)

    def _load(self) -> dict[int, tuple]:
        return {b[0]: tuple(b)[1:] for b in self.page.get()[0]} if self.page.exists() else {}

    def _store(self, bars: dict[int, tuple]) -> None:
        self.page.update(([(b, *bar) for b, bar in sorted(bars.items())],))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old, bars, changed, now = None, {}, set(), timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            for r in pdf[(pdf["bucket"] * 1000 + self.step_ms) > now].itertuples(index=False):
                if old is None:
                    old = self._load()
                    bars = dict(old)
                new, bar = (r.open_at, r.open, r.high, r.low, r.close_at, r.close, r.volume, 0), bars.get(r.bucket)
                if bar is not None:
                    new = (*min(bar[:2], new[:2]), max(bar[2], new[2]), min(bar[3], new[3]), *max(bar[4:6], new[4:6]), bar[6] + new[6], bar[7])
                bars[r.bucket] = new
                changed.add(r.bucket)
        if old is None:
            return
        late = sorted(b for b in changed if bars[b][-1])
        if late:
            yield self._emitted(key, bars, late)
        if not old:
            self.handle.registerTimer((key[-1] + 1) * PAGE * self.step_ms)
        self._wait(bars)
        self._store(bars)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bars, now = self._load(), timerValues.getCurrentWatermarkInMs()
        due = sorted(b for b, bar in bars.items() if not bar[-1] and b * 1000 + self.wait_ms <= now)
        if due:
            yield self._emitted(key, bars, due)
        if expiredTimerInfo.getExpiryTimeInMs() >= (key[-1] + 1) * PAGE * self.step_ms:
            self.page.clear()
        elif due:
            self._wait(bars)
            self._store(bars)

    def close(self) -> None:
        pass


def corrected_roll_up(source: DataFrame, timeframe: str, wait: str = "10 minutes", corrections: str = "1 day", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Bars of a coarser timeframe from a stream of bars, with version: 0, then 1, 2, ... for corrections.

    A bucket is emitted when the stream's times have passed its end by wait. Later rows emit it again, once a batch, until the
    times of earlier batches have passed its end by corrections; then its rows are dropped, as is the state of a page of
    buckets once no row can reach it. Each task sums up its rows by bucket before they are shuffled. A stream
    whose input has ended is closed by a row of closing(): its time is later than all others, so that every open bucket is
    emitted and no state stays. The last version of a bucket is its bar; a sink that merges by series and time (bar_sink)
    holds just these. Prices must not be null (see valid); a null volume counts as 0.
    """
    ms = lambda text: source.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp_millis(0) + interval {text})")).first()[0]
    seconds = minutes(timeframe) * 60
    kinds = {f.name: f.dataType for f in source.schema}
    field = T.StructField
    bar = T.StructType([field("bucket", T.LongType()), field("open_at", T.LongType()), *[field(c, kinds[c]) for c in ("open", "high", "low")], field("close_at", T.LongType()), field("close", kinds["close"]), field("volume", kinds["volume"]), field("version", T.IntegerType())])
    result = T.StructType([*[source.schema[k] for k in keys], field("bucket", T.LongType()), *[field(c, kinds[c]) for c in (*OHLC, "volume")], field("version", T.IntegerType())])
    end_row = F.coalesce(F.col("closing"), F.lit(False)) if "closing" in source.columns else F.lit(False)
    number = F.floor(F.unix_seconds("timestamp") / seconds)
    at = F.unix_micros("timestamp")
    rows = source.withWatermark("timestamp", corrections).select(*keys, (number * seconds).alias("bucket"), at.alias("open_at"), *OHLC[:3], at.alias("close_at"), "close", F.coalesce("volume", F.lit(0).cast(kinds["volume"])).alias("volume"), end_row.alias("closing"))
    # closing rows are dropped in there: a filter would be pushed below the watermark, which they have to move
    sums = rows.mapInArrow(_sum_up([*keys, "bucket"]), rows.drop("closing").schema).withColumn("page", F.floor(F.col("bucket") / (seconds * PAGE)))
    # a timer passes when the watermark does, which is behind the newest time by corrections
    processor = Buckets(T.StructType([field("bars", T.ArrayType(bar))]), keys, seconds * 1000, seconds * 1000 + ms(wait) - ms(corrections))
    bars = sums.groupBy(*keys, "page").transformWithStateInPandas(processor, result, "Append", "EventTime")
    return bars.select(*keys, F.timestamp_seconds("bucket").alias("timestamp"), *OHLC, "volume", "version")


def closing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The row that closes a stream of this schema, which needs a column closing; write it to the stream's input last."""
    row = {"timestamp": F.lit(CLOSING).cast("timestamp"), "closing": F.lit(True)}
    return spark.range(1).select(*[row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def bar_sink(path: str, staging: str, name: str, series: dict[str, str] | None = None, ids: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A sink that merges each batch into the bar table at path (see tables.write_bars) and repeats none.

    series gives the values of series columns that the stream lacks. Of rows with one series and time the one with the
    greatest version, of a later batch, counts. The batches of the stream name that are in the table are kept with it; a
    batch that comes again, because the stream died before its checkpoint, is left out. One that died half way is merged
    again, with the same result. ids are identifiers of ticks, which may have a series and time in common. A batch is staged
    before it is merged: the merge reads it more than once, and each time the stream's state would be worked through again.
    """

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        fs, kind = tables.exists_in(spark, path), spark._jvm.org.apache.hadoop.fs.Path
        done = kind(f"{path}/_batches/{name}/{batch}")
        if fs.exists(done):
            return
        rows = df.withColumns({c: F.lit(v) for c, v in (series or {}).items()})
        if "version" in rows.columns:
            rows = rows.withColumnRenamed("version", "ingest_seq")
        own = f"{staging}/{name}-{batch}"
        rows.write.mode("overwrite").parquet(f"{own}/batch")
        staged = spark.read.schema(rows.schema).parquet(f"{own}/batch")
        if staged.isEmpty():
            fs.delete(kind(own), True)
        else:
            tables.write_bars(staged, path, own, "append", ids)
        fs.mkdirs(done.getParent())
        fs.create(done, True).close()

    return write


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop; sink must accept a repeated batch. State lies in RocksDB, with a checkpoint in the shared folder."""
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
        query.awaitTermination()
    finally:
        conf.unset(name) if before is None else conf.set(name, before)
    return query
