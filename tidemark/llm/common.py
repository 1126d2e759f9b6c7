"""Helpers that the text operators share: scratch tables, joins to skewed groups, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words for counting, and what separates them for matching.
BLANKS = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A group with more than this share of all rows is hot; there are at most 1 / HOT_SHARE such groups.
HOT_SHARE = 0.001

_own_dirs: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir; only a local session without that setting gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_dirs.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="spark-tidemark-"))
    return f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


#: Rows and bytes of the batches that go to Python workers, which hold two of them; texts are much longer than usual values.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python workers in small batches, unless the session asks for smaller ones."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(name).rstrip("bB")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared scratch folder and read again: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of materialise() that nothing reads any more: all that was made of them has been written."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, how: str = "inner", hot_share: float = HOT_SHARE) -> DataFrame:
    """Join rows to groups, which has one row per non-null key and in count its number of rows.

    Groups with more than hot_share of all rows, of which there are at most 1 / hot_share, are broadcast, so that no
    key gathers its rows in one task; the rest are joined through a shuffle. how: inner or left.
    """
    total, largest = groups.agg(F.sum(count), F.max(count)).first()
    limit = max(1.0, (total or 0) * hot_share)
    if not total or largest <= limit:
        return rows.join(groups, key, how)
    is_hot = F.col(count) > F.lit(limit)
    hot, cold = groups.where(is_hot), groups.where(~is_hot)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    from_hot = marked.where("_hot").drop("_hot")
    rest = marked.where("_hot is null").select(*rows.columns).join(cold, key, how)
    return from_hot.unionByName(rest)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(lowered: Column) -> Column:
    """The words of a text that is in lower case: digits, a-z and all that is not ASCII; null has none."""
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), NON_WORD), "")


def count_words(text: Column) -> Column:
    """How many runs of non-blank characters a text has."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANKS)
    return F.size(F.array_remove(parts, "")).cast("long")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where df has such columns, for an operator's own columns beside those of its input."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def without(df: DataFrame, *names: str) -> list[Column]:
    """df's columns but those of the given names, in whatever case: an operator's results replace columns of their names."""
    gone = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of df as one, so that an operator's own columns can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, *results: str, name: str = "row") -> list[Column]:
    """The columns of the table df that packed() put into one, but those that results replace, and then the results."""
    gone = {n.lower() for n in results}
    return [*[F.col(name)[c].alias(c) for c in df.columns if c.lower() not in gone], *[F.col(n) for n in results]]
