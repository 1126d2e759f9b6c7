"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE, VOLUME = T.DecimalType(38, 8), T.DecimalType(38, 2)
#: Arithmetic happens in this type: Spark lowers the scale of results of wider decimals.
CALC = T.DecimalType(18, 8)
SERIES = ["provider", "symbol", "timeframe"]
OHLC = ["open", "high", "low", "close"]

BARS = T.StructType([T.StructField("timestamp", T.TimestampType())] + [T.StructField(c, PRICE) for c in OHLC] + [T.StructField("volume", VOLUME)])

#: Bar intervals in minutes.
MINUTES = {"1m": 1, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "4h": 240, "12h": 720, "1d": 1440}


def minutes(timeframe: str) -> int:
    """Minutes of a timeframe such as 5m, 4h or 2d."""
    if timeframe in MINUTES:
        return MINUTES[timeframe]
    unit = {"m": 1, "h": 60, "d": 1440}.get(timeframe[-1:])
    if not unit or not timeframe[:-1].isdigit() or int(timeframe[:-1]) <= 0:
        raise ValueError(f"not a timeframe: {timeframe}")
    return int(timeframe[:-1]) * unit
