"""Legacy ARC archives converted to WARC archives."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_groups, materialise, scratch

#: Payloads of fewer bytes are never replaced by a revisit record.
SMALLEST = 100
#: Bytes that are read from an archive at a time.
CHUNK = 1 << 20
#: Fields of the header line of each version, the record types and the profile of a revisit.
ARC_FIELDS = {
    "1": ("url", "ip", "date", "mime", "length"),
    "2": ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_TITLES = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SCHEMA = "key string, url string, ip string, date string, mime string, version string, headers binary, payload binary"


class _Bytes:
    """Reads an archive's bytes piece by piece; gzip, also of several members, is undone on the way."""

    def __init__(self, data: bytes):
        self.data, self.at, self.plain = memoryview(data), 0, bytearray()
        self.gzip = zlib.decompressobj(31) if bytes(self.data[:2]) == b"\x1f\x8b" else None

    def _more(self) -> bool:
        piece = self.data[self.at : self.at + CHUNK]
        if not len(piece):
            return False
        self.at += len(piece)
        if self.gzip is None:
            self.plain += piece
            return True
        self.plain += self.gzip.decompress(piece)
        while self.gzip.eof:
            rest = self.gzip.unused_data
            self.gzip = zlib.decompressobj(31)
            if not rest:
                break
            self.plain += self.gzip.decompress(rest)
        return True

    def line(self) -> bytes | None:
        """Up to and with the next line feed; None at the end."""
        looked = 0
        while (end := self.plain.find(b"\n", looked)) < 0:
            looked = len(self.plain)
            if not self._more():
                if not self.plain:
                    return None
                end = len(self.plain) - 1
                break
        out = bytes(self.plain[: end + 1])
        del self.plain[: end + 1]
        return out

    def take(self, n: int) -> bytes:
        while len(self.plain) < n and self._more():
            pass
        if len(self.plain) < n:
            raise ValueError(f"the archive ends {n - len(self.plain)} bytes early")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out


def _http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with the blank line after them, and the payload; a block without headers is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def _field(headers: bytes, name: str) -> str | None:
    for line in headers.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC archive.

    The version block says by its second line which version's header lines follow. A header line is split at spaces
    from the right, so that a URL may hold spaces; the declared length, its last field, says where the record ends.
    """
    source, fields = _Bytes(data), ARC_FIELDS["1"]
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        parts = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if parts.startswith("filedesc:"):
            block = source.take(int(parts.rsplit(" ", 1)[1]))
            version = block.split(b"\n", 1)[0].split(b" ")[0].decode()
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            fields = ARC_FIELDS[version]
            continue
        values = dict(zip(fields, parts.rsplit(" ", len(fields) - 1), strict=True))
        headers, payload = _http(source.take(int(values["length"])))
        yield {"url": values["url"], "ip": values["ip"], "date": values["date"], "mime": values["mime"], "version": "2" if len(fields) > 5 else "1", "headers": headers, "payload": payload, "key": _field(headers, "X-Record-Key")}


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the ARC archives at path, a task per group of archives: key (HTTP header X-Record-Key or null), url, ip, date, mime, version, headers, payload."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows, held = [], 0
                for r in parse_arc(data):
                    rows.append(r)
                    held += len(r["payload"])
                    if held > 8 * CHUNK:
                        yield pd.DataFrame(rows)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows)

    return _files(spark, path).mapInPandas(parse, _SCHEMA)


def write_text(records: DataFrame, path: str, end: str, compress: bool) -> None:
    """Write a string column's records, each followed by end; a partition is an archive."""
    records.write.option("lineSep", end).option("compression", "gzip" if compress else "none").text(path)


def write_arc(pages: DataFrame, path: str, key: str, url: str, html: str, date: str = "20240101000000", compress: bool = True) -> None:
    """Pages as ARC records, one archive per partition and version: pages with an even hash in version 1, others in 2."""
    body = F.coalesce(F.col(html), F.lit(""))
    length = F.octet_length(body)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Record-Key: "), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"))
    link = F.regexp_replace(F.coalesce(F.col(url), F.lit("about:blank")), r"[\r\n]", "%0A")
    size = (F.octet_length(http) + length).cast("string")
    fields = {"1": [link, F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"), size], "2": [link, F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("-"), size]}
    for version, values in fields.items():
        title = f"{version} {'0' if version == '1' else '1'} tidemark\n{ARC_TITLES[version]}\n"
        # the version block is written with each record, so that any grouping of records into files is an archive
        first = F.lit(f"filedesc://pages.arc 0.0.0.0 {date} text/plain {len(title)}\n{title}\n")
        own = pages.where(F.pmod(F.xxhash64(key), F.lit(2)) == (0 if version == "1" else 1))
        write_text(own.select(F.concat(first, F.array_join(F.array(*values), " "), F.lit("\n"), http, body)), f"{path}/v{version}", "\n", compress)


def convert(arc: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """ARC records as WARC records: key, record_id, type, url, date, payload_digest, payload_bytes, refers_to, refers_to_key, headers, payload.

    Of records whose payloads are equal and have at least smallest bytes, the one with the least key is the response
    and the others are revisits without payload; a record that has the response's key too is a response as well. Null
    keys sort last. Identifiers are name-based UUIDs of key, url, date and digest, so that a repeated task makes the
    same ones; dates become ISO 8601; digests are SHA-256. A group of equal payloads is not gathered in one task.
    """
    number = F.coalesce(F.try_to_number("key", F.lit("S9999999999999999999")).cast("decimal(20,0)"), F.lit("9" * 20).cast("decimal(20,0)"))
    df = arc.select("*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"), number.alias("_k"))
    stamp = F.date_format(F.to_timestamp("date", "yyyyMMddHHmmss"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    named = F.sha2(F.concat_ws(" ", F.coalesce("key", F.lit("-")), "url", "date", "payload_digest").cast("binary"), 256)
    ident = lambda h: F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))
    df = df.withColumns({"record_id": ident(named), "warc_date": stamp})
    narrow = df.where(F.col("payload_bytes") >= smallest).select("payload_digest", "_k", "record_id", "key")
    first = narrow.groupBy("payload_digest").agg(F.min(F.struct("_k", "record_id", "key")).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    df = join_groups(df, materialise(first, "warc-groups"), "payload_digest", "copies", "left")
    again = F.coalesce((F.col("payload_bytes") >= smallest) & (F.col("first._k") < F.col("_k")), F.lit(False))
    return df.select(
        "key", "record_id", F.when(again, "revisit").otherwise("response").alias("type"), "url", F.col("warc_date").alias("date"), "payload_digest", "payload_bytes",
        F.when(again, F.col("first.record_id")).alias("refers_to"), F.when(again, F.col("first.key")).alias("refers_to_key"), "headers", F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str, compress: bool = True) -> None:
    """Records of convert() as WARC/1.1 archives. Payloads must be UTF-8, as those that write_arc made are."""
    text = lambda c: F.coalesce(F.decode(F.col(c), "UTF-8"), F.lit(""))
    line = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c, F.lit("\r\n"))).otherwise("")
    size = F.octet_length("headers") + F.coalesce(F.octet_length("payload"), F.lit(0))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))), line("WARC-Profile", F.when(F.col("refers_to").isNotNull(), F.lit(PROFILE))), line("WARC-Refers-To", F.col("refers_to")),
        line("X-Refers-To-Key", F.col("refers_to_key")), F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"),
    )
    write_text(records.select(F.concat(head, text("headers"), text("payload"))), path, "\r\n\r\n", compress)


def parse_warc(data: bytes) -> Iterator[dict]:
    """The records of a WARC archive, by their declared lengths; digests of payloads that are there are verified."""
    source = _Bytes(data)
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := source.line()) is not None and line.strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.lower()] = value.strip()
        headers, payload = _http(source.take(int(fields["content-length"])))
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        length = len(payload)
        if fields["warc-type"] == "revisit":
            length = int(_field(headers, "Content-Length") or 0)
        elif hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} has another digest")
        yield {"key": _field(headers, "X-Record-Key"), "record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "url": fields.get("warc-target-uri"), "date": fields["warc-date"], "payload_bytes": length, "payload_digest": digest, "refers_to": fields.get("warc-refers-to"), "refers_to_key": fields.get("x-refers-to-key")}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC archives at path, without payloads."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                if rows := list(parse_warc(data)):
                    yield pd.DataFrame(rows)

    return _files(spark, path).mapInPandas(parse, "key string, record_id string, record_type string, url string, date string, payload_bytes long, payload_digest string, refers_to string, refers_to_key string")


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC archives of both versions into WARC archives, and what those hold."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(pages, arc, "page_id", "url", "html")
    write_warc(convert(read_arc(spark, f"{arc}/*")), warc)
    read = read_warc(spark, warc)
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("long")
    return read.select(number("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to_key").alias("refers_to"))

OP4_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select *, octet_length(encode(h)) as n, min(page_id) over (partition by h) as first from p)
select page_id, n::bigint as payload_bytes, sha256(h) as payload_digest,
  case when n >= 100 and page_id > first then 'revisit' else 'response' end as record_type, case when n >= 100 and page_id > first then first end as refers_to from q
"""
