"""Exchange sessions and what is looked up in them, FX sessions, scheduled announcements."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NEW_YORK, LONDON = "America/New_York", "Europe/London"
#: Days on which the exchange stayed shut for one occasion.
CLOSED_ONCE = (
    date(2001, 9, 11), date(2001, 9, 12), date(2001, 9, 13), date(2001, 9, 14), date(2004, 6, 11), date(2007, 1, 2), date(2012, 10, 29), date(2012, 10, 30), date(2018, 12, 5), date(2025, 1, 9),
)
#: Days of scheduled FOMC statements, at 14:00 in New York; each meeting began the day before.
FOMC = """
2015-01-28 2015-03-18 2015-04-29 2015-06-17 2015-07-29 2015-09-17 2015-10-28 2015-12-16
2016-01-27 2016-03-16 2016-04-27 2016-06-15 2016-07-27 2016-09-21 2016-11-02 2016-12-14
2017-02-01 2017-03-15 2017-05-03 2017-06-14 2017-07-26 2017-09-20 2017-11-01 2017-12-13
2018-01-31 2018-03-21 2018-05-02 2018-06-13 2018-08-01 2018-09-26 2018-11-08 2018-12-19
2019-01-30 2019-03-20 2019-05-01 2019-06-19 2019-07-31 2019-09-18 2019-10-30 2019-12-11
2020-01-29 2020-04-29 2020-06-10 2020-07-29 2020-09-16 2020-11-05 2020-12-16
2021-01-27 2021-03-17 2021-04-28 2021-06-16 2021-07-28 2021-09-22 2021-11-03 2021-12-15
2022-01-26 2022-03-16 2022-05-04 2022-06-15 2022-07-27 2022-09-21 2022-11-02 2022-12-14
""".split()
#: First minutes after the London open that count as its window.
OPEN_MINUTES = 15


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th weekday of a month, from the end if n is negative."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
    return last - timedelta(days=(last.weekday() - weekday) % 7 + 7 * (-n - 1))


def _easter(year: int) -> date:
    """Gregorian Easter Sunday."""
    golden, century = year % 19, year // 100
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    moon = epact - (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    sunday = moon - (year + year // 4 + moon + 2 - century + century // 4) % 7
    month = 3 + (sunday + 40) // 44
    return date(year, month, sunday + 28 - 31 * (month // 4))


def _observed(day: date) -> date:
    return day - timedelta(days=1) if day.weekday() == 5 else day + timedelta(days=1) if day.weekday() == 6 else day


def holidays(year: int) -> set[date]:
    """Weekdays on which the exchange is shut."""
    days = {_nth(year, 1, 0, 3), _nth(year, 2, 0, 3), _easter(year) - timedelta(days=2), _nth(year, 5, 0, -1), _nth(year, 9, 0, 1), _nth(year, 11, 3, 4), _observed(date(year, 7, 4)), _observed(date(year, 12, 25))}
    if date(year, 1, 1).weekday() != 5:  # a Saturday is not made up for
        days.add(_observed(date(year, 1, 1)))
    if year >= 2022:
        days.add(_observed(date(year, 6, 19)))
    return days | {d for d in CLOSED_ONCE if d.year == year}


def early_closes(year: int) -> set[date]:
    """Days that end at 13:00: after Thanksgiving, before Independence Day and Christmas."""
    days = {_nth(year, 11, 3, 4) + timedelta(days=1), date(year, 7, 3), date(year, 12, 24)}
    return {d for d in days if d.weekday() < 5} - holidays(year)


def sessions(spark: SparkSession, start: str, end: str) -> DataFrame:
    """session_date, open_ts, close_ts and session_no of regular sessions from 09:30 to 16:00 in New York; a dimension of some 250 rows a year."""
    years = range(int(start[:4]), int(end[:4]) + 1)
    shut = [d for y in years for d in holidays(y)]
    early = [d for y in years for d in early_closes(y)]
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("session_date"))
    days = days.where((F.weekday("session_date") < 5) & ~F.col("session_date").isin(shut))
    close = F.when(F.col("session_date").isin(early), F.lit(13 * 60)).otherwise(F.lit(16 * 60))
    at = lambda minute: F.to_utc_timestamp(F.timestamp_seconds(F.unix_seconds(F.col("session_date").cast("timestamp")) + minute * 60), NEW_YORK)
    return days.select("session_date", at(F.lit(9 * 60 + 30)).alias("open_ts"), at(close).alias("close_ts"), (F.row_number().over(Window.orderBy("session_date")) - 1).alias("session_no"))


def fomc(spark: SparkSession, start: str, end: str) -> DataFrame:
    """meeting_start_date, announcement_date and announcement_utc of scheduled statements in [start, end]."""
    df = spark.createDataFrame([(d,) for d in FOMC if start <= d <= end], "d string").select(F.to_date("d").alias("announcement_date"))
    at = F.to_utc_timestamp(F.timestamp_seconds(F.unix_seconds(F.col("announcement_date").cast("timestamp")) + 14 * 3600), NEW_YORK)
    return df.select(F.date_sub("announcement_date", 1).alias("meeting_start_date"), "announcement_date", at.alias("announcement_utc"))


def _session_index(calendar: DataFrame) -> DataFrame:
    """Per calendar date from the first to the last session: the last session on or before it and the first on or after it.

    As-of lookups in the calendar become equi-joins on the date.
    """
    span = calendar.agg(F.min("session_date").alias("a"), F.max("session_date").alias("b")).select(F.explode(F.sequence("a", "b")).alias("day"))
    df = span.join(calendar.select(F.col("session_date").alias("day"), "session_no"), "day", "left")
    w = Window.orderBy("day")
    upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    day_kind = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).over(upto)
    weekend = F.weekday("day") >= 5
    return df.select("day", F.last("session_no", ignorenulls=True).over(upto).alias("last_no"), F.first("session_no", ignorenulls=True).over(onward).alias("next_no"), day_kind(weekend).alias("weekends"), day_kind(~weekend & F.col("session_no").isNull()).alias("holidays"))


def _numbered(calendar: DataFrame, prefix: str) -> DataFrame:
    return F.broadcast(calendar.select(*[F.col(c).alias(f"{prefix}{c}") for c in ("session_no", "session_date", "open_ts", "close_ts")]))


def event_clock(events: DataFrame, calendar: DataFrame, at: str = "accepted_ts", reaction: int = 5, latencies: Sequence[int] = (0, 2, 5)) -> DataFrame:
    """events with their session, session_bucket, event_time, reaction_end and decision_times.

    In hours an event keeps its time; before the open, after the close and on other days it moves to the next open. The
    calendar is a small dimension, so it is broadcast; its own lookups are equi-joins on date and number.
    """
    if reaction <= 0 or not latencies or min(latencies) < 0 or len(set(latencies)) < len(latencies):
        raise ValueError("reaction must be positive, latencies distinct and not negative")
    day = F.to_date(F.from_utc_timestamp(F.col(at).cast("timestamp"), NEW_YORK))
    df = events.withColumn("_day", day).join(F.broadcast(_session_index(calendar).select(F.col("day").alias("_day"), "last_no", "next_no")), "_day", "left")
    df = df.join(_numbered(calendar, "_n_"), F.col("next_no") == F.col("_n_session_no"), "left").join(_numbered(calendar, "_a_"), F.col("next_no") + 1 == F.col("_a_session_no"), "left")
    t = F.col(at).cast("timestamp")
    own = F.col("last_no") == F.col("next_no")
    bucket = F.when(~own, "non_session").when(t < F.col("_n_open_ts"), "before_open").when(t < F.col("_n_close_ts"), "in_hours").otherwise("after_close")
    df = df.withColumn("session_bucket", bucket)
    later = F.col("session_bucket") == "after_close"
    pick = lambda c: F.when(later, F.col(f"_a_{c}")).otherwise(F.col(f"_n_{c}"))
    df = df.withColumns({"session_date": pick("session_date"), "event_time": F.when(F.col("session_bucket") == "in_hours", t).otherwise(pick("open_ts"))})
    df = df.withColumn("reaction_end", F.col("event_time") + F.make_interval(mins=F.lit(reaction)))
    decisions = F.transform(F.array(*[F.lit(x) for x in latencies]), lambda x: F.struct(x.alias("latency"), F.timestamp_micros(F.unix_micros("reaction_end") + x.cast("long") * 60_000_000).alias("decision_time")))
    return df.select(*events.columns, "session_date", "session_bucket", "event_time", "reaction_end", decisions.alias("decision_times"))


def closed_hours(before: Column, opened: Column) -> Column:
    """Hours from a close to the next open; an open before it is an error."""
    hours = (F.unix_micros(opened) - F.unix_micros(before)) / 3.6e9
    return F.when(hours < 0, F.raise_error(F.lit("open must be at or after the previous close")).cast("double")).otherwise(hours)


def classify_closed_gap(pairs: DataFrame, calendar: DataFrame, close: str = "close_ts", opened: str = "open_ts") -> DataFrame:
    """pairs with gap_class: halt_reopen, weeknight, weekend, pre_holiday, post_holiday or long_holiday.

    The session of the close is the last that began by then, that of the open the first that ends after it. Weekend
    days and holidays between them are differences of running counts by date.
    """
    index = _session_index(calendar)
    cal = calendar.select("session_no", "session_date", "open_ts", "close_ts")
    local = lambda c: F.to_date(F.from_utc_timestamp(F.col(c).cast("timestamp"), NEW_YORK))
    side = lambda p: F.broadcast(index.select(*[F.col(c).alias(f"{p}{c}") for c in index.columns]))
    named = lambda p: F.broadcast(cal.select(*[F.col(c).alias(f"{p}{c}") for c in cal.columns]))
    df = pairs.withColumns({"_c_day": local(close), "_o_day": local(opened)}).join(side("_c_"), "_c_day").join(side("_o_"), "_o_day")
    df = df.join(named("_x_"), F.col("_c_last_no") == F.col("_x_session_no")).join(named("_y_"), F.col("_o_next_no") == F.col("_y_session_no"))
    a = F.col("_x_session_no") - (F.col(close).cast("timestamp") < F.col("_x_open_ts")).cast("int")
    b = F.col("_y_session_no") + (F.col(opened).cast("timestamp") >= F.col("_y_close_ts")).cast("int")
    df = df.withColumns({"_a": a, "_b": b}).select(*pairs.columns, "_a", "_b")
    ends = lambda p, on: F.broadcast(cal.join(index, F.col("session_date") == F.col("day")).select(F.col("session_no").alias(on), F.col("session_date").alias(f"{p}d"), F.col("weekends").alias(f"{p}w"), F.col("holidays").alias(f"{p}h")))
    df = df.join(ends("_p", "_a"), "_a").join(ends("_q", "_b"), "_b")
    after = F.broadcast(index.select(F.date_sub("day", 1).alias("_pd"), (F.weekday("day") < 5).alias("_weekday"), (F.col("last_no") == F.col("next_no")).alias("_open")))
    df = df.join(after, "_pd", "left")
    weekends, shut, days = F.col("_qw") - F.col("_pw"), F.col("_qh") - F.col("_ph"), F.datediff("_qd", "_pd")
    kind = F.when(F.col("_a") == F.col("_b"), "halt_reopen").when(days == 1, "weeknight").when(F.col("_b") - F.col("_a") > 1, "long_holiday").when((weekends > 0) & (shut > 0), "long_holiday").when(weekends > 0, "weekend")
    return df.select(*pairs.columns, kind.when(F.col("_weekday") & ~F.col("_open"), "pre_holiday").otherwise("post_holiday").alias("gap_class"))


def trading_minutes_window(requests: DataFrame, calendar: DataFrame, open_minute: int | None = None, close_minute: int | None = None) -> DataFrame:
    """requests(end, n) with start: n trading minutes before end, null if the calendar does not reach back so far.

    Sessions count [open, close), or [open_minute, close_minute) of New York's day if given. Minutes are numbered by a
    running sum over sessions, so that both ends are looked up by number and no minute is a row: equi-joins on the
    date, the session's number and the hour of the running sum.
    """
    cal = calendar
    if open_minute is not None:
        at = lambda m: F.to_utc_timestamp(F.timestamp_seconds(F.unix_seconds(F.col("session_date").cast("timestamp")) + m * 60), NEW_YORK)
        cal = cal.withColumns({"open_ts": at(open_minute), "close_ts": at(close_minute)})
    length = ((F.unix_seconds("close_ts") - F.unix_seconds("open_ts")) / 60).cast("long")
    w = Window.orderBy("session_no")
    cal = cal.withColumn("_n", length).withColumns({"_before": F.sum("_n").over(w) - F.col("_n")})
    end = F.date_trunc("minute", F.col("end").cast("timestamp"))
    last_day = calendar.agg(F.max("session_date")).first()[0]
    index = F.broadcast(_session_index(calendar).select(F.col("day").alias("_day"), "last_no"))
    opens = F.broadcast(cal.select(F.col("session_no").alias("last_no"), F.col("open_ts").alias("_o")))
    bounds = F.broadcast(cal.select(F.col("session_no").alias("_no"), "open_ts", "_before", "_n"))
    day = F.least(F.to_date(F.from_utc_timestamp(end, NEW_YORK)), F.lit(last_day))
    df = requests.withColumn("_day", day).join(index, "_day", "left").join(opens, "last_no", "left")
    df = df.withColumn("_no", F.col("last_no") - (end <= F.col("_o")).cast("int")).join(bounds, "_no", "left")
    number = F.col("_before") + F.least(F.col("_n"), ((F.unix_seconds(end) - F.unix_seconds("open_ts")) / 60).cast("long")) - F.col("n")
    df = df.select(*requests.columns, number.alias("_number"), F.floor(number / 60).alias("_hour"))
    starts = cal.select(F.col("open_ts").alias("_open"), F.col("_before").alias("_from"), (F.col("_before") + F.col("_n")).alias("_to"))
    starts = starts.withColumn("_hour", F.explode(F.sequence(F.floor(F.col("_from") / 60), F.floor((F.col("_to") - 1) / 60))))
    df = df.join(F.broadcast(starts), (df["_hour"] == starts["_hour"]) & (F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_to")), "left")
    return df.select(*requests.columns, F.timestamp_seconds(F.unix_seconds("_open") + (F.col("_number") - F.col("_from")) * 60).alias("start"))


def extended_minutes_window(requests: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same with hours from 04:00 to 20:00 in New York."""
    return trading_minutes_window(requests, calendar, 4 * 60, 20 * 60)


def sessions_window(requests: DataFrame, calendar: DataFrame) -> DataFrame:
    """requests(end, n) with start: the open of the n-th session back from the last that opened by end."""
    day = F.to_date(F.from_utc_timestamp(F.col("end").cast("timestamp"), NEW_YORK))
    df = requests.withColumn("_day", day).join(F.broadcast(_session_index(calendar).select(F.col("day").alias("_day"), "last_no")), "_day", "left")
    df = df.join(_numbered(calendar, "_l_"), F.col("last_no") == F.col("_l_session_no"), "left")
    last = F.col("last_no") - (F.col("end").cast("timestamp") <= F.col("_l_open_ts")).cast("int")
    df = df.withColumn("_want", last - F.col("n") + 1).join(_numbered(calendar, "_w_"), F.col("_want") == F.col("_w_session_no"), "left")
    return df.select(*requests.columns, F.col("_w_open_ts").alias("start"))


def dissemination_date(df: DataFrame, calendar: DataFrame, settlement: str = "settlement_date", after: int = 7) -> DataFrame:
    """df with dissemination_date: the 7th session after settlement."""
    index = F.broadcast(_session_index(calendar).select(F.col("day").alias(settlement), (F.col("last_no") + after).alias("_no")))
    days = F.broadcast(calendar.select(F.col("session_no").alias("_no"), F.col("session_date").alias("dissemination_date")))
    return df.join(index, settlement, "left").join(days, "_no", "left").drop("_no")


def settlement_dates(calendar: DataFrame, start: str, end: str) -> DataFrame:
    """Last sessions on or before the 15th and the end of each month, in [start, end]."""
    month = F.trunc("session_date", "month")
    df = calendar.groupBy(month.alias("m")).agg(F.max(F.when(F.dayofmonth("session_date") <= 15, F.col("session_date"))).alias("mid"), F.max("session_date").alias("last"))
    out = df.select(F.explode(F.array("mid", "last")).alias("settlement_date")).where(F.col("settlement_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).distinct()
    return out


def tag_fx_sessions(bars: DataFrame) -> DataFrame:
    """bars with London's session_date, in_asian_window [00:00, 08:00), in_london_open_window (its first 15 minutes) and is_post_open."""
    local = F.from_utc_timestamp(F.col("timestamp").cast("timestamp"), LONDON)
    minute = F.hour(local) * 60 + F.minute(local)
    return bars.withColumns({"session_date": F.to_date(local), "in_asian_window": minute < 480, "in_london_open_window": (minute >= 480) & (minute < 480 + OPEN_MINUTES), "is_post_open": minute >= 480})


def is_fx_trading_week(ts: Column) -> Column:
    """Whether a time is in [Sunday 17:00, Friday 17:00) of New York."""
    local = F.from_utc_timestamp(ts.cast("timestamp"), NEW_YORK)
    day, hour = F.weekday(local), F.hour(local)
    return F.when(day == 5, False).when(day == 6, hour >= 17).when(day == 4, hour < 17).otherwise(True)


def fx_windows(dates: DataFrame, first_minutes: int = OPEN_MINUTES) -> DataFrame:
    """dates(session_date) with asian_start, london_open and window_end in UTC."""
    if first_minutes <= 0:
        raise ValueError("minutes must be positive")
    at = lambda m: F.to_utc_timestamp(F.timestamp_seconds(F.unix_seconds(F.col("session_date").cast("timestamp")) + m * 60), LONDON)
    return dates.withColumns({"asian_start": at(0), "london_open": at(480), "window_end": at(480 + first_minutes)})


def fx_session_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), LONDON))
