"""Universes, index membership and symbology at a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a removal reason must contain, in the order of priority.
REASONS = (
    ("m_and_a", ("acqui", "merg", "bought", "takeover")),
    ("delisting", ("delist", "bankrupt", "chapter 11")),
    ("spinoff", ("spun off", "spin-off", "spinoff", "spun out")),
    ("ranking", ("market cap", "market capitalization", "ranking")),
)


def explicit_universe(spark: SparkSession, symbols: Sequence[str]) -> DataFrame:
    """The given symbols in upper case, once each, point in time."""
    return spark.createDataFrame([(s,) for s in symbols], "symbol string").select(F.upper(F.trim("symbol")).alias("symbol")).distinct().withColumn("pit", F.lit(True))


def filter_universe(reference: DataFrame, predicate: str) -> DataFrame:
    """Symbols of reference rows that a SQL predicate accepts. A predicate that does not parse is an error."""
    if "symbol" not in reference.columns:
        raise ValueError("reference data must have a symbol")
    return reference.where(F.expr(predicate)).select("symbol").distinct().withColumn("pit", F.lit(True))


def set_op_universe(op: str, inputs: Sequence[DataFrame]) -> DataFrame:
    """union, intersect or exclude of universes from left to right; point in time if all inputs are."""
    ops = {"union": lambda a, b: a.union(b).distinct(), "intersect": lambda a, b: a.intersect(b), "exclude": lambda a, b: a.subtract(b)}
    if op not in ops or not inputs:
        raise ValueError(f"unknown set operation {op}" if op not in ops else "no inputs")
    symbols = reduce(ops[op], [d.select("symbol") for d in inputs])
    flags = reduce(DataFrame.unionAll, [d.agg(F.coalesce(F.bool_and("pit"), F.lit(True)).alias("pit")) for d in inputs]).agg(F.bool_and("pit").alias("pit"))
    return symbols.distinct().crossJoin(F.broadcast(flags))  # flags is one row


def snapshot_intervals(snapshots: DataFrame) -> DataFrame:
    """Each snapshot with the dates [date, next) at which it holds."""
    return snapshots.withColumn("until", F.lead("date").over(Window.partitionBy("source").orderBy("date")))


def snapshots_asof(snapshots: DataFrame, as_of: DataFrame) -> DataFrame:
    """as_of(source, as_of), distinct, with date and tickers of the latest snapshot on or before it; null before the first or for an unknown source.

    A source's snapshot dates, of which there are few, are one array that each date looks itself up in; tickers are joined
    afterwards by source and date.
    """
    dates = snapshots.groupBy("source").agg(F.collect_set("date").alias("_dates"))
    asked = as_of.select("source", "as_of").distinct().join(dates, "source", "left")
    found = asked.select("source", "as_of", F.array_max(F.filter("_dates", lambda d: d <= F.col("as_of"))).alias("date"))
    return found.join(snapshots.select("source", "date", "tickers"), ["source", "date"], "left").select("source", "as_of", "date", "tickers")


def members_asof(snapshots: DataFrame, as_of: DataFrame) -> DataFrame:
    """Members at each as_of(source, as_of): those of the latest snapshot on or before it.

    A date before the source's first snapshot or an unknown source gives one row with a null symbol and found false.
    """
    held = snapshots_asof(snapshots, as_of)
    return held.select("source", "as_of", F.explode_outer("tickers").alias("symbol"), F.col("date").isNotNull().alias("found"))


def composite_universe(snapshots: DataFrame, source: str, as_of: str, pit: bool = True) -> DataFrame:
    """The members of a declared source at a date; an error if there is no snapshot by then."""
    own = snapshots.where((F.col("source") == source) & (F.col("date") <= F.lit(as_of).cast("date")))
    latest = own.agg(F.max_by("tickers", "date").alias("tickers"))
    checked = latest.select(F.when(F.col("tickers").isNull(), F.raise_error(F.lit(f"no snapshot of {source} by {as_of}"))).otherwise(F.col("tickers")).alias("tickers"))
    return checked.select(F.explode("tickers").alias("symbol")).distinct().withColumn("pit", F.lit(pit))


def membership_deltas(snapshots: DataFrame) -> DataFrame:
    """Symbols added and removed from one snapshot to the next: source, date, symbol, action, prev_snapshot_date.

    A snapshot whose tickers are null tells nothing of itself and of the next one.
    """
    dates = snapshots.select("source", "date", F.col("tickers").isNotNull().alias("_known"))
    return member_deltas(snapshots.select("source", "date", F.explode("tickers").alias("symbol")), dates)


def member_deltas(members: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """membership_deltas of members(source, date, symbol), a row each, repeated ones count once.

    dates(source, date, _known) are the snapshots, default those that have members; of them there are few. A member is one
    row at its date and one at the next, and what has only one of both has changed, so that no list of members is in one task.
    """
    w = Window.partitionBy("source").orderBy("date")
    own = (members.select("source", "date", F.lit(True).alias("_known")) if dates is None else dates).groupBy("source", "date").agg(F.bool_and("_known").alias("_known"))
    near = lambda f: F.when(F.col("_known") & f("_known").over(w), f("date").over(w))
    own = own.select("source", "date", near(F.lag).alias("_prev"), near(F.lead).alias("_next"))
    both = members.alias("m").join(own.alias("d"), F.col("m.source").eqNullSafe(F.col("d.source")) & F.col("m.date").eqNullSafe(F.col("d.date")))
    at = lambda date, prev, here: F.struct(F.col(date).alias("date"), F.col(prev).alias("prev_snapshot_date"), F.lit(here).alias("_here"))
    rows = both.select("m.source", "m.symbol", F.inline(F.array(at("m.date", "_prev", True), at("_next", "m.date", False)))).where("date is not null and prev_snapshot_date is not null")
    out = rows.groupBy("source", "date", "symbol", "prev_snapshot_date").agg(F.bool_or("_here").alias("_is"), F.bool_and("_here").alias("_new"))
    return out.where(~F.col("_is") | F.col("_new")).select("source", "date", "symbol", F.when(F.col("_new"), "added").otherwise("removed").alias("action"), "prev_snapshot_date")


def _near(deltas: DataFrame, changes: DataFrame, window_days: int) -> DataFrame:
    """Changes that a delta of the same symbol and action lies within window_days of.

    Days are cut into periods that are as long as the window, so a delta falls into one and is looked for in two at most.
    """
    day, length = F.unix_date(F.col("date")), 2 * window_days + 1
    period = lambda d: F.floor(d / F.lit(length))
    spread = deltas.select(F.upper("symbol").alias("_symbol"), "action", day.alias("_day"), F.explode(F.array_distinct(F.array(period(day - window_days), period(day + window_days)))).alias("_period")).distinct()
    own = changes.withColumns({"_symbol": F.upper("symbol"), "_period": period(day)})
    a, b = own.alias("a"), spread.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_symbol", "action", "_period")] + [F.abs(F.unix_date(F.col("a.date")) - F.col("b._day")) <= window_days]
    return a.join(b, on, "left_semi").drop("_symbol", "_period")


def judged_changes(deltas: DataFrame, changes: DataFrame, window_days: int = 7) -> DataFrame:
    """Changes between the first and last delta, widened by window_days, with matched."""
    span = deltas.agg(F.date_sub(F.min("date"), window_days).alias("_lo"), F.date_add(F.max("date"), window_days).alias("_hi"))
    judged = changes.select("date", "symbol", "action").join(F.broadcast(span), F.col("date").between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    hit = _near(deltas, judged.distinct(), window_days).withColumn("_hit", F.lit(True))
    return judged.join(hit, ["date", "symbol", "action"], "left").withColumn("matched", F.coalesce("_hit", F.lit(False))).drop("_hit")


def cross_check_deltas(deltas: DataFrame, changes: DataFrame, window_days: int = 7) -> DataFrame:
    """n_in_window, n_matched, n_unmatched, match_rate (0 without rows) of judged_changes."""
    out = judged_changes(deltas, changes, window_days).agg(F.count("*").alias("n_in_window"), F.count_if("matched").alias("n_matched"), F.count_if(~F.col("matched")).alias("n_unmatched"))
    return out.withColumn("match_rate", F.coalesce(F.try_divide("n_matched", "n_in_window"), F.lit(0.0)))


def annotate_deltas(deltas: DataFrame, changes: DataFrame, window_days: int = 7) -> DataFrame:
    """deltas with status: confirmed if a change of the same symbol and action is within window_days, else not_in_change_window."""
    hit = _near(changes, deltas.select("date", "symbol", "action").distinct(), window_days).withColumn("_hit", F.lit(True))
    return deltas.join(hit, ["date", "symbol", "action"], "left").withColumn("status", F.when(F.col("_hit"), "confirmed").otherwise("not_in_change_window")).drop("_hit")


def ever_members(snapshots: DataFrame, start: str, end: str) -> DataFrame:
    """Upper-cased symbols of any snapshot in the window; an empty window is an error."""
    if start > end:
        raise ValueError("the window is empty")
    return snapshots.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(F.explode(F.transform("tickers", lambda t: F.upper(t))).alias("symbol")).distinct()


def current_members(snapshots: DataFrame, end: str) -> DataFrame:
    """Upper-cased symbols of the latest snapshot on or before end."""
    return snapshots.where(F.col("date") <= F.lit(end).cast("date")).agg(F.max_by("tickers", "date").alias("t")).select(F.explode(F.transform("t", lambda x: F.upper(x))).alias("symbol")).distinct()


def _survivors(snapshots: DataFrame, available: DataFrame, start: str, end: str) -> DataFrame:
    """symbol, now (a current member) and data (is available) of all that were members in the window."""
    ever, now = ever_members(snapshots, start, end), current_members(snapshots, end).withColumn("now", F.lit(True))
    data = available.select(F.upper("symbol").alias("symbol")).distinct().withColumn("data", F.lit(True))
    return ever.join(now, "symbol", "left").join(data, "symbol", "left").select("symbol", F.coalesce("now", F.lit(False)).alias("now"), F.coalesce("data", F.lit(False)).alias("data"))


def audit_survivorship(snapshots: DataFrame, available: DataFrame, start: str, end: str) -> DataFrame:
    """Counts of ever, current, delisted members, of those with data and of those without, and ratios (1 if nothing is asked). missing_members() names those without."""
    gone = ~F.col("now")
    out = _survivors(snapshots, available, start, end).agg(F.count("*").alias("n_ever"), F.count_if("now").alias("n_current"), F.count_if("data").alias("n_with_data"), F.count_if(gone).alias("n_delisted"), F.count_if(gone & F.col("data")).alias("n_delisted_with_data"), F.count_if(~F.col("data")).alias("n_missing"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(1.0))
    return out.withColumns({"coverage_ratio": share("n_with_data", "n_ever"), "delisted_coverage_ratio": share("n_delisted_with_data", "n_delisted")})


def missing_members(snapshots: DataFrame, available: DataFrame, start: str, end: str) -> DataFrame:
    """The members of the window without data, a row each, and whether they are delisted."""
    return _survivors(snapshots, available, start, end).where(~F.col("data")).select("symbol", (~F.col("now")).alias("delisted"))


def classify_removal_reason(reason: Column) -> Column:
    """The first class of REASONS that the reason mentions, else other."""
    r, out = F.lower(F.coalesce(reason, F.lit(""))), None
    for name, words in REASONS:
        said = r.rlike("|".join(words))
        out = F.when(said, name) if out is None else out.when(said, name)
    return out.otherwise("other")


def resolve_symbol(keys: DataFrame, symbology: DataFrame) -> DataFrame:
    """keys(raw_symbol, date) with instrument_id of the mapping that holds at the date, both bounds inclusive, null bounds open.

    Of several the one that began last wins, then the largest identifier. No mapping gives null. Keys are joined once, by
    symbol and year: a mapping is a row for each year of the asked dates that it reaches into.
    """
    own = keys.select("raw_symbol", "date").distinct()
    span = own.agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    lo, hi = span.first()
    m = symbology.select("raw_symbol", "instrument_id", F.coalesce("valid_from", F.lit("0001-01-01").cast("date")).alias("_f"), F.coalesce("valid_to", F.lit("9999-12-31").cast("date")).alias("_t"))
    m = m.where((F.col("_f") <= F.lit(hi)) & (F.col("_t") >= F.lit(lo)) & (F.col("_f") <= F.col("_t")))
    m = m.withColumn("_year", F.explode(F.sequence(F.year(F.greatest("_f", F.lit(lo))), F.year(F.least("_t", F.lit(hi))))))
    met = own.withColumn("_year", F.year("date")).join(m, ["raw_symbol", "_year"]).where(F.col("date").between(F.col("_f"), F.col("_t")))
    hit = met.groupBy("raw_symbol", "date").agg(F.max(F.struct("_f", "instrument_id"))["instrument_id"].alias("instrument_id"))
    return keys.join(hit, ["raw_symbol", "date"], "left")


def attach_symbol(records: DataFrame, symbology: DataFrame, fallback: Column | str) -> DataFrame:
    """records(instrument_id, …) with symbol: the mapping's, share-class hyphens as points and in upper case, else fallback."""
    names = symbology.groupBy("instrument_id").agg(F.max_by("raw_symbol", F.coalesce("valid_from", F.lit("0001-01-01").cast("date"))).alias("_raw"))
    named = F.upper(F.translate("_raw", "-", "."))
    return records.join(names, "instrument_id", "left").withColumn("symbol", F.coalesce(named, fallback if isinstance(fallback, Column) else F.lit(fallback))).drop("_raw")


def resolve_cik(symbols: DataFrame, tickers: DataFrame) -> DataFrame:
    """symbols(symbol) with cik: that of its ticker or its spelling with a point for the hyphen, if that is one; else null."""
    alias = lambda c: F.upper(F.translate(c, ".", "-"))
    one = tickers.groupBy(alias("ticker").alias("_alias")).agg(F.min("cik").alias("lo"), F.max("cik").alias("hi")).where("lo = hi").select("_alias", F.col("lo").alias("cik"))
    return symbols.withColumn("_alias", alias("symbol")).join(one, "_alias", "left").drop("_alias")
