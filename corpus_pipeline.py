"""A corpus from documents: language, near-duplicates, contamination, mixture, shards.

Only the columns of documents pass through; others are dropped, so that they can't clash. A text that is null or has no
letter is rejected by the first stage, so later ones see none. Of repeated rows and other copies one class is one group of
the second stage, in which the rows with the smallest identifier (null: lowest) stay; ties go the same way in every run. Long
texts are handled whole. Empty tables give an empty corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language, mixing, near_dedup, sharding
from tidemark.llm.common import count_words, materialise, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what language identification rejects, and sets lang where it is null."""
    model = language.fit(docs)
    known = language.predict(docs.select(*COLUMNS), model).where(~F.col("rejected"))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dedup.dedup(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share a window of words with a benchmark item."""
    return decontamination.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    The mix is made of narrow rows: a hash of the whole row, identifier, source and size. Texts are moved once, to the
    rows that are taken.
    """
    own = docs.select(*COLUMNS)
    row = [F.xxhash64(*COLUMNS).alias("_row"), F.xxhash64(F.lit(1), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in COLUMNS]).alias("_row2")]
    narrow = materialise(own.select(*row, "doc_id", "source", count_words(F.col("text")).alias("size")), "pipeline-sizes")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    taken = mixing.mix(materialise(mixing.quality_weight(narrow, labels), "pipeline-weights")).where("copies > 0")
    taken = materialise(taken.select("_row", "_row2", "copies"), "pipeline-taken")
    texts = own.select("*", *row).dropDuplicates(["_row", "_row2"]).hint("merge")
    return taken.join(texts, ["_row", "_row2"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def place(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and the slot in it."""
    own = docs.select(*COLUMNS).withColumn("size", sharding.byte_size(F.col("text")))
    return sharding.shard(own, F.col("size"), F.col("text"), F.col("doc_id"))


STAGES = [
    ("language", identify),
    ("near-duplicates", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixture", mix_sources),
    ("shards", place),
]
#: A nearest-centroid model and alignments are not SQL; a brute-force version in the tests checks the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared scratch folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
