"""Exact deduplication by a stateful stream."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, join_groups, materialise, scratch

#: State is kept on the executors' disks, in RocksDB, and committed to the shared checkpoint folder.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Bits of the bitmap of digests with several rows: 16 MB at most.
BITS = 1 << 27
#: What an identifier that is null sorts as.
_LAST = 2**63 - 1


def normalised(text: Column) -> Column:
    """Runs of blanks become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def stream_state(keys_path: str, schema, spark: SparkSession, checkpoint: str, log: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the files of digests at keys_path through keyed state and return the state: digest, keep_id, keep_at, group_size.

    State per digest, without expiry: the smallest identifier, the locator of its row and the number of rows seen.
    Every batch appends the states that it changed to log; counts only grow, so the last version of a state is the one
    with the largest count. A run with the same checkpoint and log goes on where the last one stopped, and a batch that
    is repeated after a failure overwrites its own part of the log.
    """
    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    first = F.min(F.struct("ident", "locator"))
    state = source.parquet(keys_path).groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))

    def append(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{log}/batch={batch}")

    with _settings(spark, STATE):
        query = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(append).start()
        query.awaitTermination()
    versions = spark.read.schema(f"digest binary, first struct<ident: bigint, locator: string>, group_size bigint, batch int").parquet(log)
    last = versions.groupBy("digest").agg(F.min("first").alias("first"), F.max("group_size").alias("group_size"))
    return last.select("digest", F.col("first.ident").alias("keep_id"), F.col("first.locator").alias("keep_at"), "group_size")


def maybe_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose binary key is in keys, and a few others: those that share a bit of a bitmap of BITS bits with one that is.

    The bitmap is made of chunks of 32,768 bits and broadcast; it has at most BITS / 8 bytes, however many keys there are.
    """
    place = F.pmod(F.xxhash64(key), F.lit(BITS)) + 1
    bitmap = keys.select(F.bitmap_bucket_number(place).alias("_chunk"), F.bitmap_bit_position(place).alias("_bit")).groupBy("_chunk").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    marked = rows.withColumns({"_chunk": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)}).join(F.broadcast(bitmap), "_chunk")
    byte = F.conv(F.hex(F.substr("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return marked.where(F.getbit(byte, F.pmod(F.col("_bit"), F.lit(8)).cast("int")) == 1).select(*rows.columns)


def dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] | None = None, files_per_batch: int | None = None) -> DataFrame:
    """One row per row of docs: ident, keep_id, group_size, kept, text_sha256, locator.

    Digests of normalised texts, identifiers and content locators (file and row) pass through a stream whose keyed
    state never expires. On hits, digests of several rows, full bytes are compared: the least and the greatest text of
    such a digest must be the same, which partial aggregates find without gathering a group in one task. Other texts stay
    where they are: a bitmap of the hits lets few of them through. If a digest holds different texts, its rows are grouped
    by the text itself.

    A null text is an empty text. A null identifier sorts last, and its row is kept only if no other row has its text.
    Repeated rows with the smallest identifier are all kept. Long texts are hashed and compared whole. An empty table gives
    no rows. Other columns are not read, whatever their names. digest: how to make the binary digest of a text, sha256
    unless given.
    """
    spark = docs.sparkSession
    make = digest or (lambda c: F.unhex(F.sha2(c, 256)))
    norm = normalised(F.col(f"`{text}`"))
    at = F.col("_metadata") if "_metadata" in docs.columns else None
    locator = F.concat_ws("#", F.input_file_name(), F.monotonically_increasing_id().cast("string")) if at is None else F.concat_ws("#", at["file_path"], at["row_index"].cast("string"))
    rows = docs.select(F.coalesce(F.col(f"`{ident}`").cast("long"), F.lit(_LAST)).alias("ident"), locator.alias("locator"), norm.alias("_norm"))
    keys = scratch(spark, "dedup-keys")
    rows.select("ident", "locator", make(F.col("_norm").cast("binary")).alias("digest"), F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256")).write.parquet(keys)
    seen = spark.read.parquet(keys)
    state = materialise(stream_state(keys, seen.schema, spark, scratch(spark, "dedup-state"), scratch(spark, "dedup-log"), files_per_batch), "dedup-groups")

    content = docs.select(norm.alias("_norm")).select(make(F.col("_norm").cast("binary")).alias("digest"), "_norm")
    content = maybe_in(content, state.where("group_size > 1").select("digest"), "digest")
    bytes_of = content.groupBy("digest").agg(F.min("_norm").alias("a"), F.max("_norm").alias("b"))
    clash = materialise(bytes_of.where("a != b").select("digest"), "dedup-clashes")

    groups = state.select("digest", "keep_id", "group_size")
    if clash.isEmpty():
        out = join_groups(seen, groups, "digest", "group_size")
    else:
        fine = seen.join(groups.join(clash, "digest", "left_anti"), "digest")
        texts = rows.withColumn("digest", make(F.col("_norm").cast("binary"))).join(clash, "digest", "left_semi")
        same = texts.groupBy("digest", "_norm").agg(F.min("ident").alias("keep_id"), F.count("*").alias("group_size"))
        apart = texts.join(same, ["digest", "_norm"]).select("digest", "ident", "locator", F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
        out = fine.unionByName(apart)
    null_if_last = lambda c: F.when(F.col(c) != F.lit(_LAST), F.col(c))
    return out.select(null_if_last("ident").alias(ident), null_if_last("keep_id").alias("keep_id"), "group_size", (F.col("ident") == F.col("keep_id")).alias("kept"), "text_sha256", "locator")


def op6_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with the row that stays for its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "_metadata")
    return dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = """
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as n from documents)
select doc_id, min(doc_id) over (partition by n) as keep_id, count(*) over (partition by n) as group_size,
  doc_id = min(doc_id) over (partition by n) as kept, sha256(n) as text_sha256 from t
"""
