"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, documents, materialise, packed, unpacked, words

#: A window of SPAN words that document and item share is found; fingerprints are hashes of K words, one per SPAN - K + 1.
SPAN, K = 10, 4
#: Items are broadcast in blocks of about this many fingerprints.
BLOCK = 100_000
_POSITION_BITS = 30


def _grams(h: Column, first: Column, k: int) -> Column:
    """Hash of the k word hashes from position first (from 0)."""
    return F.xxhash64(*[F.get(h, first + i) for i in range(k)])


def _starts(h: Column, k: int) -> Column:
    """0, 1, ... for each place where k words begin."""
    n = F.size(h) - k
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def fingerprints(df: DataFrame, forms: Sequence[tuple[int, int, int]]) -> DataFrame:
    """df(h, the hashes of a text's words) with one row per fingerprint instead of h: k, more, at (from 0), gram and around.

    forms: (k, window, more). Per window of consecutive k-grams the one with the smallest (hash, position) is kept, so
    texts that share window consecutive k-grams share a fingerprint at the same place of them. around holds the k words
    there and more on either side, null beyond the text. Hash and position are one number each, and the sliding minimum is
    taken over those. Work grows with the length of a text: no step reads more of an array than it uses.
    """
    keys = [c for c in df.columns if c != "h"]
    mask = F.lit((1 << _POSITION_BITS) - 1).cast("long")

    def ranked(k: int):
        return lambda i: F.shiftleft(F.shiftrightunsigned(_grams(F.col("h"), i, k), _POSITION_BITS), _POSITION_BITS).bitwiseOR(i.cast("long"))

    def least(ranks: Column, window: int):
        return lambda i: F.least(*[F.get(ranks, i + j) for j in range(window)]) if window > 1 else F.get(ranks, i)

    def printed(k: int, more: int):
        def one(c: Column) -> Column:
            at = c.bitwiseAND(mask).cast("int")
            return F.struct(F.lit(k).alias("k"), F.lit(more).alias("more"), at.alias("at"), F.xxhash64(F.lit(k), _grams(F.col("h"), at, k)).alias("gram"), F.array(*[F.get("h", at + j) for j in range(-more, k + more)]).alias("around"))

        return one

    names = [f"_{i}" for i in range(len(forms))]
    df = df.select(*keys, "h", *[F.transform(_starts(F.col("h"), k), ranked(k)).alias(n) for n, (k, _, _) in zip(names, forms, strict=True)])
    df = df.select(*keys, "h", *[F.array_distinct(F.transform(_starts(F.col(n), window), least(F.col(n), window))).alias(n) for n, (_, window, _) in zip(names, forms, strict=True)])
    return df.select(*keys, F.inline(F.concat(*[F.transform(n, printed(k, more)) for n, (k, _, more) in zip(names, forms, strict=True)])))


def _items(benchmark: DataFrame, ident: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences (cls, h) and their item identifiers (cls, item)."""
    rows = benchmark.select(F.col(ident).cast("string").alias("item"), words(ascii_lower(F.col(text))).alias("w")).where(F.size("w") > 0)
    rows = rows.select("item", F.sha2(F.array_join("w", " ").cast("binary"), 256).alias("cls"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    rows = materialise(rows, "decontam-items")
    return rows.dropDuplicates(["cls"]).select("cls", "h"), rows.select("cls", "item").distinct()


def spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(_d, _t, start, end, cls): stretches of document words that occur in an item of class cls; and (cls, item).

    _d is the doc_id (null: lowest) and _t a hash of the text. A stretch holds at least SPAN words, or is a whole item
    of fewer. Fingerprints are joined, then a hit is extended over the words around it, as far as a window reaches.
    The benchmark is the query set: it meets all documents in broadcast blocks of a set number of fingerprints, and all
    documents are read once per block.

    Null and empty texts have no words, so no stretches; nor has anything if there are no items or no documents. Long
    texts are handled whole, in time and memory that grow with their length. Ties between hashes in a window go to the
    first position. Repeated rows have the same stretches, listed once. Other columns are not read.
    """
    classes, items = _items(benchmark, item_id, item_text)
    classes = materialise(classes.withColumn("n", F.size("h")), "decontam-classes")
    short = sorted(r[0] for r in classes.where(F.col("n") < SPAN).select("n").distinct().collect())
    long, brief = (K, SPAN - K + 1, SPAN - K), [(n, 1, 0) for n in short]
    hashed = docs.select(*row_key(text), F.transform(words(ascii_lower(F.col(f"`{text}`"))), lambda x: F.xxhash64(x)).alias("h"))

    found = []
    own = [fingerprints(classes.where(F.col("n") >= SPAN).select("cls", "h"), [long])] + [fingerprints(classes.where(F.col("n") == form[0]).select("cls", "h"), [form]) for form in brief]
    prints = reduce(DataFrame.unionByName, own).select("cls", F.col("k").alias("n"), "gram", F.col("around").alias("theirs"))
    prints = materialise(prints, "decontam-prints")
    forms = ([long] if not prints.where(F.size("theirs") > F.col("n")).isEmpty() else []) + brief
    blocks = -(-prints.count() // block)
    for i in range(blocks):
        part = prints if blocks == 1 else prints.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == i)
        hits = fingerprints(hashed, forms).join(F.broadcast(part), "gram")
        same = F.zip_with("around", "theirs", lambda a, b: F.coalesce(a == b, F.lit(False)))
        hits = hits.where((F.col("k") == F.col("n")) & (F.size("around") == F.size("theirs"))).select("_d", "_t", "at", "cls", "k", "more", same.alias("same"))
        run = lambda flags: F.when(F.array_contains(flags, False), F.array_position(flags, False) - 1).otherwise(F.col("more")).cast("int")
        left, right = run(F.reverse(F.slice("same", 1, F.col("more")))), run(F.slice("same", F.col("more") + F.col("k") + 1, F.col("more")))
        whole = ~F.array_contains(F.slice("same", F.col("more") + 1, F.col("k")), False)
        hits = hits.where(whole).select("_d", "_t", "cls", (F.col("at") - left).alias("start"), (F.col("at") + F.col("k") + right).alias("end"), F.when(F.col("more") > 0, SPAN).otherwise(F.col("k")).alias("least"))
        found.append(hits.where(F.col("end") - F.col("start") >= F.col("least")).drop("least"))
    none = docs.sparkSession.createDataFrame([], "_d long, _t long, cls string, start int, end int")
    return reduce(DataFrame.unionByName, found, none).distinct(), items


def row_key(text: str = "text", ident: str = "doc_id") -> list[Column]:
    return [F.coalesce(F.col(f"`{ident}`").cast("long"), F.lit(-(2**63))).alias("_d"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_t")]


def contaminated_words(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """_d, _t, n_hit, n_items, items_sha256 for the documents that share a window with an item; see spans() for awkward rows."""
    found, items = spans(docs, benchmark, text)
    found = materialise(found, "decontam-spans")
    earlier = Window.partitionBy("_d", "_t").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    places = found.select("_d", "_t", "start", "end").distinct().withColumn("reached", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    n_hit = places.groupBy("_d", "_t").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))).cast("long").alias("n_hit"))
    pairs = found.select("_d", "_t", "cls").distinct().join(items, "cls").select("_d", "_t", "item").distinct()
    joined = pairs.groupBy("_d", "_t").agg(F.array_sort(F.collect_list("item")).alias("items"))
    joined = joined.select("_d", "_t", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    return n_hit.join(joined, ["_d", "_t"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that share SPAN consecutive words, or all of a shorter item, with a benchmark item.

    Null and empty texts have no words and stay, as does everything if there are no items. Repeated rows go or stay
    together. All columns are returned as they were, whatever their names. See spans() for long texts and ties.
    """
    hit = materialise(spans(docs, benchmark)[0].select("_d", "_t").distinct(), "decontam-hit")
    return docs.select(packed(docs), *row_key()).join(hit, ["_d", "_t"], "left_anti").select(*unpacked(docs))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words that lie in benchmark windows; repeated rows have the same result."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = materialise(contaminated_words(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "decontam-documents")
    rows = docs.select("doc_id", *row_key(), F.size(words(ascii_lower(F.col("text")))).cast("long").alias("n_words"))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.join(found, ["_d", "_t"], "left").select("doc_id", "n_words", zero("n_hit"), zero("n_items"), F.coalesce("items_sha256", empty).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


OP5_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, w, least(10, len(w)) as n from (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark) where len(w) > 0),
lengths as (select distinct n from b),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as g from (select *, unnest(generate_series(1, len(w) - n + 1)) as i from b)),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g from (select d.doc_id, d.w, l.n, unnest(generate_series(1, len(d.w) - l.n + 1)) as i from d cross join lengths l)),
m as (select dw.doc_id, dw.i, dw.n, bw.item_id from dw join bw on dw.g = bw.g and dw.n = bw.n),
hits as (select doc_id, count(distinct p) as n_hit from (select distinct doc_id, unnest(generate_series(i, i + n - 1)) as p from m) group by doc_id),
items as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256 from (select distinct doc_id, item_id::varchar as item from m) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit, coalesce(x.n_items, 0)::bigint as n_items,
  coalesce(x.items_sha256, sha256('')) as items_sha256, h.n_hit is not null as contaminated
from d left join hits h on h.doc_id = d.doc_id left join items x on x.doc_id = d.doc_id
"""
