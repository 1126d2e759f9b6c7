"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import count_words, documents, join_groups, materialise, packed, unpacked

#: Weights of the sources in code point order, repeating; no document is taken more often than MAX_EPOCHS.
CYCLE, MAX_EPOCHS = (5, 2, 1), 3
#: Sources up to this number are broadcast; rows of a source that one bucket of keys holds on average.
MANY_SOURCES, BUCKET_ROWS = 100_000, 500
#: Buckets whose sums are added first, so that no source's buckets are summed in one task.
GROUP_BUCKETS = 4096
#: Weights of documents by quality label.
GOOD, BAD, UNKNOWN = 2.0, 0.5, 1.0


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes(source, n, source_size) with target: shares of all sizes by weight, at most max_epochs times source_size.

    Sources are taken in the order of the ratio of their cap to their weight; those before the first that stays below
    its cap are full, and the rest share what is left by weight. One row per source.
    """
    w = F.element_at(F.lit(list(cycle)), F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(cycle))) + 1)
    df = sizes.withColumn("weight", w.cast("double")).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    df = df.withColumn("level", (F.sum("source_size").over(all_rows).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(all_rows)["level"]
    df = df.withColumn("fill", level)
    return df.select("source", "n", "source_size", F.coalesce(F.least("cap", F.col("fill") * F.col("weight")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, source: str = "source", size: str = "size", weight: str = "weight", ident: str = "doc_id", cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """docs with source_size, target and copies: how often the mix takes each row.

    A source takes floor(target / source_size) whole epochs. The rest of its target is filled in the order of
    exponential keys -ln(u) / weight, u from a hash of ident: those keys are monotonically bucketed, sums per group of
    buckets and then per bucket find the bucket in which the target falls, and only that one is sorted and prefix-summed, in
    runs of rows with the same key and size from one partition, so that a repeated row gathers in no task. The row at the
    end is taken if that brings the source nearer to its target. Weights must be positive.

    A null source is a source; null size counts as 0, null weight as 1. Rows with equal ident and size are
    interchangeable (ties), so repeated rows may be taken in part. Texts are not read. Reruns agree. An empty input gives
    an empty result. Columns of docs that are called source_size, target or copies are replaced; others may have any name.
    """
    u = (F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{ident}`").cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)
    of = lambda c: F.col(f"`{c}`")
    keyed = docs.select(packed(docs), (-F.log(u) / F.coalesce(of(weight), F.lit(1.0))).alias("_key"), F.coalesce(of(size), F.lit(0)).cast("long").alias("_size"), F.struct(of(source).isNull().alias("no"), F.coalesce(of(source), F.lit("")).alias("s")).alias("_src"))
    narrow = materialise(keyed.select("_src", "_size", "_key"), "mix-keys")
    sizes = narrow.groupBy("_src").agg(F.count("*").alias("n"), F.sum("_size").alias("source_size"))
    named = sizes.select(F.when(~F.col("_src.no"), F.col("_src.s")).alias("source"), "n", "source_size")
    plan = source_targets(named, cycle, max_epochs)
    plan = plan.select(F.struct(F.col("source").isNull().alias("no"), F.coalesce("source", F.lit("")).alias("s")).alias("_src"), "n", "source_size", "target")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = materialise(plan.withColumns({"_epochs": epochs, "_rest": F.col("target") - epochs * F.col("source_size"), "_buckets": F.ceil(F.col("n") / BUCKET_ROWS)}), "mix-plan")
    few = plan.count() <= MANY_SOURCES

    def with_plan(df: DataFrame, of: DataFrame) -> DataFrame:
        df = df.join(F.broadcast(of), "_src", "left") if few else join_groups(df, of, "_src", "n", "left")
        return df.withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * F.col("_buckets")))

    def crossing(parts: DataFrame, at: str) -> DataFrame:
        """Per source the part in which the sum of the parts so far passes _rest, and the sum before it; parts: _src, at, b, _rest, _from."""
        so_far = Window.partitionBy("_src").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
        ends = parts.withColumn("_end", F.col("_from") + F.sum("b").over(so_far)).where("_end > _rest")
        return ends.groupBy("_src").agg(F.min(F.struct(F.col(at), (F.col("_end") - F.col("b")).alias("_from"))).alias("c")).select("_src", F.col(f"c.{at}").alias(at), F.col("c._from").alias("_from"))

    sums = materialise(with_plan(narrow, plan).groupBy("_src", "_bucket").agg(F.sum("_size").alias("b"), F.first("_rest").alias("_rest")).withColumn("_group", F.floor(F.col("_bucket") / GROUP_BUCKETS)), "mix-sums")
    groups = crossing(sums.groupBy("_src", "_group").agg(F.sum("b").alias("b"), F.first("_rest").alias("_rest")).withColumn("_from", F.lit(0)), "_group")
    cross = crossing(sums.join(materialise(groups, "mix-groups"), ["_src", "_group"]), "_bucket").withColumnRenamed("_bucket", "_cross")
    plan = materialise(plan.join(cross, "_src", "left"), "mix-crossing")

    rows = with_plan(keyed, plan)
    inside = F.coalesce(F.col("_bucket") == F.col("_cross"), F.lit(False))
    clear = rows.where(~inside).withColumn("_more", F.coalesce(F.col("_bucket") < F.col("_cross"), F.lit(True)))
    cut = materialise(rows.where(inside).withColumn("_tie", F.monotonically_increasing_id()), "mix-cut").withColumn("_part", F.shiftright("_tie", 33))
    run = ["_src", "_key", "_size", "_part"]
    before = F.sum("_run").over(Window.partitionBy("_src").orderBy("_key", "_size", "_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_run")
    runs = cut.groupBy(*run).agg(F.sum("_size").alias("_run")).withColumn("_before", before).drop("_run")
    middle = F.col("_from") + F.col("_before") + F.col("_size") * (F.row_number().over(Window.partitionBy(*run).orderBy("_tie")) - 0.5)
    cut = cut.join(runs, run).withColumn("_more", middle <= F.col("_rest"))
    both = clear.unionByName(cut.select(*clear.columns))
    return both.select("row", "source_size", "target", F.least(F.col("_epochs") + F.col("_more").cast("long"), F.lit(max_epochs)).alias("copies")).select(*unpacked(docs, "source_size", "target", "copies"))


def quality_weight(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with weight: GOOD or BAD by the best quality label of its doc_id, else UNKNOWN (also for a null doc_id).

    Repeated labels count once, repeated rows have equal weights. A column weight is replaced. docs should be narrow:
    it is joined to labels by doc_id.
    """
    best = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    w = F.when(F.col("_quality") >= 1, F.lit(GOOD)).when(F.col("_quality") < 1, F.lit(BAD)).otherwise(F.lit(UNKNOWN))
    out = docs.select(packed(docs), "doc_id").join(best, "doc_id", "left").select("row", w.alias("weight"))
    return out.select(*unpacked(docs, "weight"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of all documents with as many words as they have."""
    d = documents(spark, sf_dir, "doc_id", "source", "text").select("doc_id", "source", count_words(F.col("text")).alias("size"))
    d = materialise(quality_weight(d, spark.read.parquet(f"{sf_dir}/labels.parquet")), "mix-docs")
    return mix(d).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP2_SQL = """
with docs as (
  select d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    case when q.quality >= 1 then 2.0::double when q.quality < 1 then 0.5::double else 1.0::double end as weight
  from documents d left join (select doc_id, max(quality) as quality from labels group by doc_id) q on q.doc_id = d.doc_id),
keyed as (
  select *, -ln((('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double) / weight as k
  from docs),
sizes as (
  select source, sum(size)::bigint as source_size,
    [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight
  from docs group by source),
levels as (
  select *, source_size * 3.0::double as cap,
    (sum(source_size) over ()::double - coalesce(sum(source_size * 3.0::double) over (order by source_size * 3.0::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by source_size * 3.0::double / weight, source nulls last rows between current row and unbounded following) as level
  from sizes),
targets as (
  select source, source_size, coalesce(least(cap, weight * first_value(case when level * weight <= cap then level end ignore nulls)
      over (order by cap / weight, source nulls last rows between unbounded preceding and unbounded following)), cap) as target
  from levels),
runs as (
  select k.doc_id, k.size, t.source_size, t.target, case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end as epochs,
    sum(k.size) over (partition by k.source order by k.k, k.size rows between unbounded preceding and current row) - k.size / 2.0::double as middle
  from keyed k join targets t on k.source is not distinct from t.source)
select doc_id, size, source_size, target, (size * (epochs + case when middle <= target - epochs * source_size then 1 else 0 end))::bigint as taken from runs
"""
