"""Vendor payloads, landed as a string column, as typed bars, catalogs and reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.options import q9
from tidemark.schemas import OHLC, PRICE, VOLUME

#: Fixed value: what a vendor's integer price holds where there is none.
NO_PRICE = 2**63 - 1
#: Continuous futures that get a prefix, if the asset class says that they are futures.
FUTURES = ("ES", "NQ", "CL", "GC", "SI", "ZB", "ZN", "ZS", "ZC", "ZW")


def _bars(df: DataFrame, keys: list[str], ts: Column, prices: list[Column], volume: Column, strict: bool) -> DataFrame:
    """The bar columns; a row that lacks one raises if strict, else it goes with a null in its place and a quarantine reason."""
    typed = [p.try_cast(PRICE).alias(n) for n, p in zip(OHLC, prices, strict=True)]
    out = df.select(*keys, ts.alias("timestamp"), *typed, volume.try_cast(VOLUME).alias("volume"))
    broken = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("timestamp", *OHLC, "volume")]))
    out = out.withColumn("quarantine", F.when(F.size(broken) > 0, F.array_join(broken, ",")))
    if strict:
        return out.where(F.when(F.col("quarantine").isNotNull(), F.raise_error(F.concat(F.lit("malformed bar: "), "quarantine")).cast("boolean")).otherwise(F.lit(True))).drop("quarantine")
    return out


def _parsed(payloads: DataFrame, schema: str, strict: bool) -> DataFrame:
    keys = [c for c in payloads.columns if c != "payload"]
    df = payloads.select(*keys, F.from_json("payload", schema).alias("p"))
    return df.where(F.when(F.col("p").isNull(), F.raise_error(F.lit("malformed payload")).cast("boolean")).otherwise(F.lit(True))) if strict else df.where("p is not null")


def _keys(payloads: DataFrame) -> list[str]:
    return [c for c in payloads.columns if c != "payload"]


def normalize_oanda(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """Complete candles with mid prices; fractions of a second are cut off."""
    df = _parsed(payloads, "candles array<struct<complete:boolean,time:string,volume:string,mid:struct<o:string,h:string,l:string,c:string>>>", strict)
    df = df.select(*_keys(payloads), F.explode("p.candles").alias("x")).where(F.coalesce("x.complete", F.lit(True)))
    ts = F.try_to_timestamp(F.concat(F.substring("x.time", 1, 19), F.lit("Z")))
    return _bars(df, _keys(payloads), ts, [F.col(f"x.mid.{c}") for c in "ohlc"], F.coalesce("x.volume", F.lit("0")), strict)


def normalize_binance(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """Arrays of milliseconds, open, high, low, close, volume, …"""
    df = _parsed(payloads.select(*_keys(payloads), F.concat(F.lit('{"k":'), "payload", F.lit("}")).alias("payload")), "k array<array<string>>", strict)
    df = df.select(*_keys(payloads), F.explode("p.k").alias("x"))
    return _bars(df, _keys(payloads), F.timestamp_millis(F.get("x", 0).try_cast("long")), [F.get("x", i) for i in (1, 2, 3, 4)], F.get("x", 5), strict)


def normalize_coinbase(payloads: DataFrame, start: str, end: str, strict: bool = True) -> DataFrame:
    """Arrays of seconds, low, high, open, close, volume; rows outside [start, end] are dropped."""
    df = _parsed(payloads.select(*_keys(payloads), F.concat(F.lit('{"k":'), "payload", F.lit("}")).alias("payload")), "k array<array<string>>", strict)
    df = df.select(*_keys(payloads), F.explode("p.k").alias("x")).withColumn("_ts", F.timestamp_seconds(F.get("x", 0).try_cast("long")))
    df = df.where(F.col("_ts").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return _bars(df, _keys(payloads), F.col("_ts"), [F.get("x", i) for i in (3, 2, 1, 4)], F.get("x", 5), strict)


def normalize_polygon(payloads: DataFrame, strict: bool = True) -> DataFrame:
    df = _parsed(payloads, "results array<struct<t:long,o:string,h:string,l:string,c:string,v:string>>", strict)
    df = df.select(*_keys(payloads), F.explode("p.results").alias("x"))
    return _bars(df, _keys(payloads), F.timestamp_millis("x.t"), [F.col(f"x.{c}") for c in "ohlc"], F.col("x.v"), strict)


def normalize_alpaca(payloads: DataFrame, strict: bool = True) -> DataFrame:
    df = _parsed(payloads, "bars array<struct<t:string,o:string,h:string,l:string,c:string,v:string>>", strict)
    df = df.select(*_keys(payloads), F.explode("p.bars").alias("x"))
    return _bars(df, _keys(payloads), F.try_to_timestamp("x.t"), [F.col(f"x.{c}") for c in "ohlc"], F.col("x.v"), strict)


def normalize_tradestation(payloads: DataFrame, start: str | None = None, strict: bool = True) -> DataFrame:
    """Bars from start on; a missing volume is 0."""
    df = _parsed(payloads, "Bars array<struct<TimeStamp:string,Open:string,High:string,Low:string,Close:string,TotalVolume:string>>", strict)
    df = df.select(*_keys(payloads), F.explode("p.Bars").alias("x")).withColumn("_ts", F.try_to_timestamp("x.TimeStamp"))
    df = df.where(F.col("_ts") >= F.lit(start).cast("timestamp")) if start else df
    return _bars(df, _keys(payloads), F.col("_ts"), [F.col(f"x.{c.capitalize()}") for c in OHLC], F.coalesce("x.TotalVolume", F.lit("0")), strict)


def normalize_fred(observations: DataFrame) -> DataFrame:
    """(series, date, value) as bars of one price and no volume; NaN and null observations are dropped."""
    rows = observations.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return rows.select("series", F.col("date").cast("timestamp").alias("timestamp"), *[F.col("value").cast(PRICE).alias(c) for c in OHLC], F.lit(0).cast(VOLUME).alias("volume"))


def normalize_q9(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars, number of excluded records by symbol) of integer prices and nanoseconds; a record without one of its prices is excluded, never filled."""
    gone = F.greatest(*[F.col(c) for c in OHLC]) == NO_PRICE
    bars = records.where(~gone).select("symbol", "instrument_id", F.timestamp_micros(F.floor(F.col("ts_event") / 1000)).alias("timestamp"), *[q9(F.col(c)).alias(c) for c in OHLC], F.col("volume").cast(VOLUME).alias("volume"))
    return bars, records.where(gone).groupBy("symbol").agg(F.count("*").alias("excluded"))


def flatten_symbology(payloads: DataFrame) -> DataFrame:
    """raw_symbol, instrument_id, valid_from, valid_to of mappings, nested under mappings or not; identifiers that are no integers are skipped."""
    entry = "map<string,array<struct<d0:string,d1:string,s:string>>>"
    m = F.coalesce(F.from_json("payload", f"mappings {entry}")["mappings"], F.from_json("payload", entry))
    df = payloads.select(F.explode(m).alias("raw_symbol", "v")).select("raw_symbol", F.explode("v").alias("v"))
    day = lambda c: F.try_to_date(F.nullif(F.col(c), F.lit("")), "yyyy-MM-dd")
    out = df.select("raw_symbol", F.col("v.s").try_cast("long").alias("instrument_id"), day("v.d0").alias("valid_from"), day("v.d1").alias("valid_to"))
    return out.where("instrument_id is not null")


def normalize_quotes(payloads: DataFrame) -> DataFrame:
    """Quote snapshots; those without numeric last, high, low and previous close are skipped."""
    df = payloads.select(F.explode(F.from_json("payload", "Quotes array<struct<Symbol:string,Last:string,High:string,Low:string,PreviousClose:string,Volume:string>>")["Quotes"]).alias("q"))
    num = lambda c: F.col(f"q.{c}").try_cast("double")
    out = df.select(F.col("q.Symbol").alias("symbol"), num("Last").alias("last"), num("High").alias("high"), num("Low").alias("low"), num("PreviousClose").alias("previous_close"), num("Volume").alias("volume"))
    return out.dropna(subset=["last", "high", "low", "previous_close"])


def _text(path: str, default: str = "") -> Column:
    return F.coalesce(F.col(path), F.lit(default))


def normalize_instruments(payloads: DataFrame, vendor: str, asset_class: str | None = None) -> DataFrame:
    """A vendor's instruments that can be traded: symbol, name, asset_class, exchange, type."""
    fields = "symbol:string,name:string,class:string,exchange:string,status:string"
    pick = {
        "alpaca": (f"a array<struct<{fields}>>", "a", F.col("x.status") == "active", ("x.symbol", "x.name", F.coalesce("x.class", F.lit("us_equity")), "x.exchange", None)),
        "binance": ("symbols array<struct<status:string,baseAsset:string,quoteAsset:string>>", "symbols", F.col("x.status") == "TRADING", None),
        "coinbase": ("a array<struct<id:string,display_name:string,status:string,trading_disabled:boolean>>", "a", ~F.coalesce("x.trading_disabled", F.lit(False)) & (F.col("x.status") == "online"), ("x.id", "x.display_name", F.lit("crypto"), F.lit("coinbase"), F.lit("spot"))),
        "oanda": ("instruments array<struct<name:string,displayName:string,type:string>>", "instruments", F.lit(True), ("x.name", F.coalesce("x.displayName", "x.name"), F.lit("forex"), None, F.coalesce("x.type", F.lit("CURRENCY")))),
        "polygon": ("results array<struct<ticker:string,name:string,market:string,primary_exchange:string,type:string,active:boolean>>", "results", F.coalesce("x.active", F.lit(True)), ("x.ticker", "x.name", F.coalesce("x.market", F.lit("stocks")), "x.primary_exchange", "x.type")),
        "tradestation": ("Symbols array<struct<Symbol:string,Description:string,AssetType:string,Exchange:string>>", "Symbols", F.lit(True), ("x.Symbol", "x.Description", F.coalesce("x.AssetType", F.lit("UNKNOWN")), "x.Exchange", F.coalesce("x.AssetType", F.lit("UNKNOWN")))),
    }
    if vendor not in pick:
        raise ValueError(f"no catalog of {vendor}")
    schema, field, keep, columns = pick[vendor]
    text = F.concat(F.lit('{"a":'), "payload", F.lit("}")) if field == "a" else F.col("payload")
    df = payloads.select(F.explode(F.from_json(text, schema)[field]).alias("x")).where(keep)
    if vendor == "tradestation" and asset_class in ("stocks", "futures"):
        df = df.where(F.col("x.AssetType") == asset_class[:-1].upper())
    if columns is None:
        base, quote = _text("x.baseAsset"), _text("x.quoteAsset")
        columns = (F.concat_ws("_", base, quote), F.concat_ws("/", base, quote), F.lit("crypto"), None, F.lit("spot"))
    value = lambda c: F.lit(None).cast("string") if c is None else _text(c) if isinstance(c, str) else c
    return df.select(*[value(c).alias(n) for c, n in zip(columns, ("symbol", "name", "asset_class", "exchange", "type"), strict=True)])


def standardize_instruments(df: DataFrame, provider: str, asset_class: str) -> DataFrame:
    """symbol, name, provider, asset_class first, then what else there is; a missing name is the symbol with its first _ as /."""
    have = set(df.columns)
    out = df if "provider" in have else df.withColumn("provider", F.lit(provider))
    out = out if "asset_class" in have else out.withColumn("asset_class", F.lit(asset_class))
    out = out if "name" in have else out.withColumn("name", F.regexp_replace("symbol", "^([^_]*)_", "$1/"))
    first = ["symbol", "name", "provider", "asset_class"]
    return out.select(*first, *[c for c in out.columns if c not in first])


def normalize_symbol(symbol: Column, vendor: str, asset_class: str | None = None) -> Column:
    """A symbol as the vendor spells it; futures get their prefix only if the asset class says that they are futures."""
    s = F.upper(symbol)
    if vendor == "coinbase":
        return F.translate(s, "_", "-")
    if vendor == "binance":
        return F.regexp_replace(s, "_", "")
    if vendor == "tradestation" and asset_class == "future":
        return F.when(s.isin(*FUTURES), F.concat(F.lit("@"), s)).otherwise(s)
    return s


def flatten_corporate_actions(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """Records by type as rows of key-value pairs; corporate_action_type is added where a record has none."""
    m = F.from_json("payload", "map<string,array<map<string,string>>>")
    df = payloads.select(m.alias("m"))
    df = df.where(F.when(F.col("m").isNull(), F.raise_error(F.lit("malformed payload")).cast("boolean")).otherwise(F.lit(True))) if strict else df.where("m is not null")
    df = df.select(F.explode("m").alias("kind", "v")).select("kind", F.explode("v").alias("record"))
    return df.select(F.coalesce(F.col("record")["corporate_action_type"], "kind").alias("corporate_action_type"), "record")


def normalize_reference(df: DataFrame, index: str, start: str, end: str) -> DataFrame:
    """Reference records with index in [start, end]: NaN as null, dates as ISO text; every revision stays."""
    out = df.where(F.col(index).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    fix = {n: F.when(~F.isnan(n), F.col(n)) for n, t in df.dtypes if t in ("double", "float")} | {n: F.date_format(n, "yyyy-MM-dd") for n, t in df.dtypes if t == "date"}
    fix |= {n: F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss") for n, t in df.dtypes if t.startswith("timestamp")}
    return out.withColumns(fix) if fix else out


def explode_companyfacts(payloads: DataFrame) -> DataFrame:
    """Facts of all taxonomies, tags and units of (cik, payload); entries without an end or a date of filing are skipped."""
    fact = "struct<start:string,end:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string>"
    df = payloads.select("cik", F.from_json("payload", f"facts map<string,map<string,struct<units:map<string,array<{fact}>>>>>")["facts"].alias("f"))
    df = df.select("cik", F.explode("f").alias("taxonomy", "tags")).select("cik", "taxonomy", F.explode("tags").alias("tag", "n")).select("cik", "taxonomy", "tag", F.explode("n.units").alias("unit", "v")).select("cik", "taxonomy", "tag", "unit", F.posexplode("v").alias("pos", "x"))
    day = lambda c: F.try_to_date(f"x.{c}", "yyyy-MM-dd")
    out = df.select("cik", "taxonomy", "tag", "unit", "pos", day("start").alias("start"), day("end").alias("end"), "x.val", "x.accn", "x.fy", "x.fp", "x.form", day("filed").alias("filed"))
    return out.where("end is not null and filed is not null and val is not null")


def explode_submissions(payloads: DataFrame) -> DataFrame:
    """(cik, payload) with parallel arrays, under filings.recent or as an archive page, as one row per filing."""
    arrays = "form array<string>,filingDate array<string>,acceptanceDateTime array<string>,accessionNumber array<string>,items array<string>"
    typed = ",".join(":".join(x.split(" ", 1)) for x in arrays.split(","))
    recent = F.coalesce(F.from_json("payload", f"filings struct<recent:struct<{typed}>>")["filings"]["recent"], F.from_json("payload", arrays))
    df = payloads.select("cik", recent.alias("r")).select("cik", F.posexplode(F.arrays_zip("r.form", "r.filingDate", "r.acceptanceDateTime", "r.accessionNumber", "r.items")).alias("pos", "x"))
    return df.select("cik", F.col("x.form").alias("form"), F.try_to_date("x.filingDate", "yyyy-MM-dd").alias("filing_date"), F.try_to_timestamp("x.acceptanceDateTime").alias("accepted_ts"), F.col("x.accessionNumber").alias("accession"), F.col("x.items").alias("items"))


def explode_tickers(payloads: DataFrame) -> DataFrame:
    """Distinct cik (ten digits) and ticker (upper case)."""
    m = F.from_json("payload", "map<string,struct<cik_str:string,ticker:string,title:string>>")
    df = payloads.select(F.explode(m).alias("k", "x"))
    return df.select(F.lpad("x.cik_str", 10, "0").alias("cik"), F.upper("x.ticker").alias("ticker")).distinct()


def maintenance_windows(payloads: DataFrame) -> DataFrame:
    """start, end and name of incidents that were started and resolved; the last update of each kind counts."""
    up = "struct<timestamp:long,code:string>"
    df = payloads.select(F.monotonically_increasing_id().alias("_row"), F.explode(F.from_json("payload", f"array<struct<incidents:array<struct<title:string,updates:array<{up}>>>>>")).alias("a"))
    df = df.select("_row", F.posexplode("a.incidents").alias("_i", "n"))
    last = lambda code: F.element_at(F.filter(F.col("n.updates"), lambda u: (u["code"] == code) & u["timestamp"].isNotNull()), -1)["timestamp"]
    some = lambda code: F.exists(F.col("n.updates"), lambda u: (u["code"] == code) & u["timestamp"].isNotNull())
    df = df.where(some("started") & some("resolved"))
    return df.select(F.timestamp_millis(last("started")).alias("start"), F.timestamp_millis(last("resolved")).alias("end"), F.coalesce("n.title", F.lit("maintenance")).alias("name"))
