"""Near-duplicates by Order MinHash, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, documents, join_groups, materialise, packed, release, unpacked, words

#: Words of a shingle and the similarity from which texts are linked.
SHINGLE, SIMILAR = 5, 0.8
#: Sketches per text, and shingles per sketch: texts of similarity s agree in a sketch with probability of about s ** ORDERED.
SKETCHES, ORDERED = 28, 5
#: Two texts of at most SHORT shingles are found by exact keys, without sketches.
SHORT = 25
#: Shingles of a centre whose order tells texts apart before they are aligned, how many of them both must have for that, and the share in order that is enough.
MARKS, ENOUGH, IN_ORDER = 32, 20, 0.6
#: Pairs in large groups are made in squares of about this many texts a side, so that no group gathers in one task.
SIDE = 256
#: Texts of similarity SIMILAR differ in at most this share of the shingles of both: 1 in 9.
DIFFER = (1 - SIMILAR) / (1 + SIMILAR)
_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SEEDS = np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def labelled_shingles(word_hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes of a text's shingles in order, the r-th occurrence of a shingle told from the others.

    A text of fewer than SHINGLE words is one shingle; one without words has none.
    """
    h = np.asarray(word_hashes, dtype=np.int64).view(np.uint64)
    n = len(h)
    if not n:
        return h
    m = max(1, n - SHINGLE + 1)
    g = np.full(m, np.uint64(min(n, SHINGLE)))
    for i in range(min(n, SHINGLE)):
        g = g * _MULTIPLY + h[i : i + m]
    g = _mixed(g)
    order = np.argsort(g, kind="stable")
    same = np.concatenate(([False], g[order][1:] == g[order][:-1]))
    if same.any():
        at = np.arange(m)
        rank = np.empty(m, dtype=np.uint64)
        rank[order] = at - np.maximum.accumulate(np.where(same, 0, at))
        g = _mixed(g + rank * _MULTIPLY)
    return g


def sketches(shingles: np.ndarray) -> list[int]:
    """Order MinHash: per sketch the ORDERED shingles with the smallest hashes, hashed in the order of the text."""
    m = len(shingles)
    if not m:
        return []
    out = np.empty(SKETCHES, dtype=np.uint64)
    step = max(1, min(SKETCHES, 4_000_000 // m))
    for b in range(0, SKETCHES, step):
        h = _mixed(shingles[None, :] ^ _SEEDS[b : b + step, None])
        at = np.argpartition(h, ORDERED - 1, axis=1)[:, :ORDERED] if m > ORDERED else np.broadcast_to(np.arange(m), h.shape)
        x = shingles[np.sort(at, axis=1)]
        s = np.full(len(x), np.uint64(m if m < ORDERED else ORDERED))
        for j in range(x.shape[1]):
            s = _mixed(s * _MULTIPLY + x[:, j])
        out[b : b + step] = s
    return out.view(np.int64).tolist()


def bucket_keys(shingles: np.ndarray) -> list[int]:
    """What a text's buckets are named after: its sketches with their numbers, the keys of its smallest shingles, or both.

    If two texts have the share SIMILAR of their shingles in common, the smallest hashes of each, as many as it may lack
    and one more, have one in common. Texts of at most SHORT shingles get these keys; those that can be similar to a
    longer one get sketches too.
    """
    m, out = len(shingles), []
    if m <= SHORT:
        prefix = np.sort(shingles)[: m - int(np.ceil(SIMILAR * m - 1e-9)) + 1] if m else shingles
        out += _mixed(prefix * _MULTIPLY).view(np.int64).tolist()
    if m >= SIMILAR * (SHORT + 1):
        numbered = np.array(sketches(shingles), dtype=np.int64).view(np.uint64) ^ _SEEDS
        out += _mixed(numbered).view(np.int64).tolist()
    return out


def alignment(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Shingles that the best alignment of two texts matches, over those that either has.

    Labelled shingles are unique in a text, so the best alignment is the longest increasing run of matched positions.
    Only matches inside the band count: further from the diagonal, no alignment can reach least; results below it may be too low.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = int((n + m) * (1 - least) / (1 + least)) + 1
    keep = np.abs(i - j) <= band
    i, j = i[keep], j[keep]
    if len(i) < least / (1 + least) * (n + m) - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        matched = len(j)
    else:
        from bisect import bisect_left

        ends: list[int] = []
        for x in j.tolist():
            at = bisect_left(ends, x)
            ends[at : at + 1] = [x]
        matched = len(ends)
    return matched / (n + m - matched)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sketch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for hashes in batches:
        yield pd.Series([bucket_keys(labelled_shingles(h)) for h in hashes])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _short_shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Labelled shingles cut to 32 bits, made unique again by taking the next free number."""
    for hashes in batches:
        out = []
        for h in hashes:
            s = (labelled_shingles(h) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            if len(np.unique(s)) < len(s):
                seen: set[int] = set()
                for k, x in enumerate(s.tolist()):
                    while x in seen:
                        x = x + 1 if x < 2**31 - 1 else -(2**31)
                    seen.add(x)
                    s[k] = x
            out.append(s)
        yield pd.Series(out)


@F.pandas_udf(T.DoubleType())
def _aligned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        yield pd.Series([alignment(np.asarray(a), np.asarray(b)) for a, b in zip(left, right, strict=True)], dtype=float)


def marks(text: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Where a text has MARKS shingles that a hash chooses of the centre's; -1 for those it lacks."""
    chosen = np.sort(centre[np.argsort(_mixed(centre.astype(np.int64).view(np.uint64) * _MULTIPLY), kind="stable")[:MARKS]])
    order = np.argsort(text, kind="stable")
    at = np.searchsorted(text[order], chosen)
    at = np.minimum(at, len(text) - 1)
    return np.where(text[order][at] == chosen, order[at], -1).astype(np.int32)


@F.pandas_udf(T.StructType([T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("apart", "marks")]))
def _differences(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The shingles that one of a text and its centre has and the other has not, and the text's marks."""
    for left, right in batches:
        pairs = [(np.asarray(a), np.asarray(b)) for a, b in zip(left, right, strict=True)]
        yield pd.DataFrame({"apart": [np.setxor1d(a, b, assume_unique=True) for a, b in pairs], "marks": [marks(a, b) for a, b in pairs]})


def _in_order(p: Column, q: Column, n: Column, m: Column) -> Column:
    """Whether two texts of n and m shingles can have the similarity SIMILAR by where they have their centre's marks.

    What an alignment of that similarity matches is at places that differ by at most what it leaves unmatched of the longer
    text. It matches 8 of 9 shingles, so of the marks that both have, which a hash chose, hardly ever fewer than IN_ORDER.
    """
    slack = F.greatest(n, m) - (n + m) * F.lit(SIMILAR / (1 + SIMILAR)) + 1
    both = F.filter(F.zip_with(p, q, lambda a, b: F.when((a >= 0) & (b >= 0), F.abs(a - b))), lambda x: x.isNotNull())
    return (F.size(both) < ENOUGH) | (F.size(F.filter(both, lambda x: x <= slack)) >= F.lit(IN_ORDER) * F.size(both))


def keys(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> list[Column]:
    """_id (null: lowest) and _th, a hash of the text: what tells rows apart without reading their words."""
    return [F.coalesce(F.col(f"`{ident}`").cast("long"), F.lit(-(2**63))).alias("_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_th")]


def _hashed(docs: DataFrame, text: str, ident: str) -> DataFrame:
    """_id, _th, _node, n_words and h, the hashes of the words; _node is 128 bits and the same for texts with equal words, or equal texts if they have none."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(*keys(docs, text, ident), t.alias("_t"), words(F.lower(t)).alias("_w"))
    df = df.select("_id", "_th", "_t", F.size("_w").alias("n_words"), F.transform("_w", lambda x: F.xxhash64(x)).alias("h"))
    two = lambda *c: F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *c)), 16, "0") for seed in (1, 2)])
    node = F.when(F.col("n_words") > 0, two(F.col("h"))).otherwise(two(F.lit("text"), F.col("_t")))
    return df.select("_id", "_th", F.unhex(node).alias("_node"), "n_words", "h")


def components(links: DataFrame) -> DataFrame:
    """links(a, b) as (_node, _root): the least node that can be reached; nodes without links are left out.

    Least labels spread along links and then jump to the label of the label, until nothing changes. Every round is
    written out; the links of a node that has very many are not gathered in one task.
    """
    both = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-both")
    labels = both.groupBy(F.col("a").alias("_node")).agg(F.least(F.min("b"), F.col("_node")).alias("_root"), F.count("*").alias("_n"))
    labels = materialise(labels, "near-labels")
    while True:
        near = join_groups(both, labels.select(F.col("_node").alias("b"), "_n", F.col("_root").alias("_next")), "b", "_n").groupBy(F.col("a").alias("_node")).agg(F.min("_next").alias("_next"))
        spread = materialise(labels.join(near, "_node").select("_node", "_n", F.col("_root").alias("_old"), F.least("_root", "_next").alias("_root")), "near-spread")
        release(labels)
        if spread.where("_root != _old").isEmpty():
            release(both)
            out = spread.select("_node", "_root")
            out.scratch_path = spread.scratch_path
            return out
        jump = spread.groupBy("_root").agg(F.count("*").alias("_size")).join(spread.select(F.col("_node").alias("_root"), F.col("_root").alias("_far")), "_root")
        labels = materialise(join_groups(spread.drop("_old"), jump, "_root", "_size").select("_node", "_n", F.least("_root", "_far").alias("_root")), "near-labels")
        release(spread)


def _met(docs: DataFrame, text: str, ident: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, nodes, shingles, met, links to centres): what classes() and links() both begin with."""
    bounded_batches(docs.sparkSession)
    hashed = _hashed(docs, text, ident)
    rows = materialise(hashed.select("_id", "_th", "_node", "n_words", _sketch("h").alias("sketch")), "near-rows")
    nodes = rows.groupBy("_node").agg(F.min(F.struct("_id", "_th")).alias("rep"), F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("sketch").alias("sketch"))
    nodes = materialise(nodes, "near-nodes")
    live = _shared(nodes.where(F.size("sketch") > 0).select("_node", "n_words", F.explode("sketch").alias("bucket")))
    popular = materialise(live.groupBy("_node").agg(F.sum("size").alias("popular")), "near-popular")
    shingles = _shingle_table(docs, nodes, popular, text, ident)
    members = materialise(live.join(popular, "_node"), "near-shared")
    centres = materialise(members.groupBy("bucket").agg(F.max(F.struct("popular", "_node", "n_words")).alias("c"), F.count("*").alias("_n")), "near-centres")
    met = join_groups(members.select("_node", "n_words", "bucket"), centres, "bucket", "_n").where("_node != c._node")
    met = materialise(met.select("_node", "n_words", F.col("c._node").alias("to"), F.col("c.n_words").alias("m")).distinct(), "near-met")
    star = met.where(_fits(F.col("n_words"), F.col("m"))).select(F.least("_node", "to").alias("a"), F.greatest("_node", "to").alias("b"))
    candidates = materialise(star.distinct(), "near-pairs")
    release(live, popular, members, centres)
    found = _verified(shingles, candidates)
    release(candidates)
    return rows, nodes, shingles, met, found


def links(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """All pairs (a, b) of different texts, as the identifiers of one row that stands for each, that are similar and share a bucket.

    Members of one class are compared too, by the same filter, so a family of n texts that are all similar gives all its
    n (n - 1) / 2 pairs: as many rows as there are links. classes() needs only enough of them to connect each family.
    """
    rows, nodes, shingles, met, star = _met(docs, text, ident)
    every = _remaining(shingles, met, star.limit(0).select(F.col("a").alias("_node"), F.col("b").alias("_root")))
    more = _verified(shingles, every)
    name = lambda side: nodes.select(F.col("_node").alias(side), F.col("rep._id").alias(f"{side}_id"))
    out = materialise(star.union(more).distinct().join(name("a"), "a").join(name("b"), "b").select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")), "near-all-links")
    release(rows, nodes, shingles, met, star, every, more)
    return out


def classes(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row per row of docs: _id, _th, _node, class_id, kept.

    Texts with equal words form one node. Nodes that agree in a sketch, or short ones in a key, share a bucket. In every
    bucket, of whatever size, each node meets the centre, the node that shares most buckets with others. Then each node
    that is not yet in the centre's class meets those of the bucket that its differences from the centre show to be
    possibly similar (see _remaining): every two similar nodes that share a bucket end in one class. Candidates are
    verified by alignment and linked from SIMILAR on. Classes are the connected components, named after their smallest
    identifier. links() has all pairs.

    Texts without words are only linked to equal texts; null counts as empty. A null identifier is the lowest. The row
    with the smallest identifier of its class is kept, with its repetitions. Long texts are sketched and aligned whole, in
    time that grows with their length. Ties between sketches or centres are broken by node, so reruns agree. An empty
    table gives no rows. Only the text and the identifier are read, so other columns may have any names.
    """
    rows, nodes, shingles, met, star = _met(docs, text, ident)
    first = components(star)
    remaining = _remaining(shingles, met, first)
    more = _verified(shingles, remaining)
    found = materialise(star.union(more).distinct(), "near-found")
    release(shingles, met, star, first, remaining, more)

    roots = components(found)
    named = nodes.select("_node", "rep", "copies").join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    named = materialise(named, "near-named")
    heads = named.groupBy("_root").agg(F.min(F.struct("rep", "_node")).alias("head"), F.count("*").alias("_n"))
    named_classes = materialise(join_groups(named, heads, "_root", "_n").select("_node", "copies", "head"), "near-classes")
    release(nodes, found, roots, named)
    out = join_groups(rows.select("_id", "_th", "_node"), named_classes, "_node", "copies")
    kept = (F.col("_node") == F.col("head._node")) & (F.struct("_id", "_th") == F.col("head.rep"))
    return out.select("_id", "_th", "_node", F.col("head.rep._id").alias("class_id"), kept.alias("kept"))


def _shingle_count(n: Column) -> Column:
    return F.greatest(n - (SHINGLE - 1), F.lit(1))


def _fits(n: Column, m: Column, least: float = SIMILAR) -> Column:
    """Whether texts of n and m words can have the similarity least by their lengths."""
    return F.least(_shingle_count(n), _shingle_count(m)) >= F.lit(least) * F.greatest(_shingle_count(n), _shingle_count(m))


def _crowds(shingles: DataFrame, met: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes that have met a centre of which some node is in another class: to (the centre), _node, _root, open (not in the centre's class), size, n_apart, apart (the shingles that tell it from the centre) and marks. A centre that only one node has met is left out."""
    known = met.select("_node", "to").join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    named = met.groupBy("to").agg(F.count("*").alias("_n")).join(roots.withColumnRenamed("_node", "to"), "to", "left").select("to", "_n", F.coalesce("_root", "to").alias("_centre"))
    named = materialise(named, "near-named-centres")
    known = materialise(join_groups(known, named, "to", "_n").select("to", "_node", "_root", (F.col("_root") != F.col("_centre")).alias("open")), "near-known")
    sides = materialise(known.groupBy("to").agg(F.count("*").alias("_n"), F.count_if("open").alias("_open")).where("_open > 0 and _n > 1"), "near-sides")
    rows = join_groups(known, sides.select("to", "_n"), "to", "_n").drop("_n")
    own = rows.join(shingles.hint("merge"), "_node")
    theirs = sides.select("to", "_n").join(shingles.select(F.col("_node").alias("to"), F.col("s").alias("c")).hint("merge"), "to")
    centres = materialise(theirs, "near-centre-shingles")
    both = join_groups(own, centres, "to", "_n", hot_share=0.005)
    apart = both.select("to", "_node", "_root", "open", F.size("s").alias("size"), _differences("s", "c").alias("d"))
    out = materialise(apart.select("to", "_node", "_root", "open", "size", F.size("d.apart").alias("n_apart"), "d.apart", "d.marks"), "near-apart")
    release(named, known, sides, centres)
    return out


def _remaining(shingles: DataFrame, met: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes of one large bucket that are in different classes so far and that may be similar.

    Let X and Y be the shingles that tell two nodes from a centre that both have met. What tells the nodes from each
    other is the symmetric difference of X and Y. Nodes of n and m shingles are similar only if that has at most
    d = DIFFER (n + m) members, so X and Y share at least t = (|X| + |Y| - d) / 2. If both are sorted alike, their first
    |X| - t + 1 and |Y| - t + 1 members then have one in common. The order puts what few nodes of the crowd have first, so
    that passages that many share make no pairs. If t is not positive, a stand-in that all have takes the place of the
    common member. No pair of similar nodes is lost. Of these pairs those go on whose order fits too (see _in_order): texts
    of the same sentences in other orders have nearly the same shingles.
    """
    crowd = _crowds(shingles, met, roots)
    members = crowd.select("to", "_node", "_root", "open", "size", "n_apart", "marks", F.explode("apart").alias("x"))
    often = materialise(members.groupBy("to", "x").agg(F.count("*").alias("often")).where("often > 1"), "near-often")
    by_node = Window.partitionBy("to", "_node")
    ranked = members.join(often, ["to", "x"]).withColumns({"_n": F.count("*").over(by_node), "_at": F.row_number().over(by_node.orderBy("often", "x"))})
    ranked = ranked.withColumn("rank", F.col("n_apart") - F.col("_n") + F.col("_at"))  # members that no other node has come first
    longest = F.col("size") * (1 + 1 / SIMILAR) * DIFFER + 1e-6
    columns = ["to", "x", "_node", "_root", "open", "size", "n_apart", "marks", "rank"]
    stand_in = crowd.where(F.col("n_apart") <= longest).select("to", F.lit(None).cast("int").alias("x"), "_node", "_root", "open", "size", "n_apart", "marks", F.lit(0).cast("long").alias("rank"))
    entries = materialise(ranked.where(F.col("rank") <= longest + 1).select(*columns).union(stand_in).withColumn("x", F.coalesce(F.col("x").cast("long"), F.lit(2**40))), "near-entries")
    sides = entries.groupBy("to", "x").agg(F.count("*").alias("_all"), F.count_if("open").alias("_open"), F.count_if(F.col("rank") <= longest / 2 + 1).alias("_short"), F.min("_root").alias("_lo"), F.max("_root").alias("_hi"))
    sides = sides.where("_open > 0 and _short > 0 and _lo != _hi").select("to", "x", F.ceil(F.col("_all") / SIDE).cast("int").alias("_all_sides"), F.ceil(F.col("_open") / SIDE).cast("int").alias("_open_sides"))
    postings = materialise(sides, "near-postings")
    rows = materialise(entries.join(postings, ["to", "x"]), "near-open")
    own = lambda n: F.pmod(F.xxhash64("_node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("open").select("to", "x", F.col("_node").alias("p"), F.col("_root").alias("rp"), F.col("size").alias("n"), F.col("n_apart").alias("np"), F.col("rank").alias("kp"), F.col("marks").alias("mp"), own("_open_sides").alias("i"), every("_all_sides").alias("j"))
    right = rows.select("to", "x", F.col("_node").alias("q"), F.col("_root").alias("rq"), F.col("size").alias("m"), F.col("n_apart").alias("nq"), F.col("rank").alias("kq"), F.col("marks").alias("mq"), "open", own("_all_sides").alias("j"), every("_open_sides").alias("i"))
    d = (F.col("n") + F.col("m")) * DIFFER + 1e-6
    prefix = (F.col("kp") <= (F.col("np") - F.col("nq") + d) / 2 + 1) & (F.col("kq") <= (F.col("nq") - F.col("np") + d) / 2 + 1)
    near = F.when(F.col("x") == 2**40, F.col("np") + F.col("nq") <= d).otherwise(prefix)
    alike = F.least("n", "m") >= F.lit(SIMILAR - 1e-9) * F.greatest("n", "m")
    pairs = left.join(right, ["to", "x", "i", "j"]).where((~F.col("open") | (F.col("p") < F.col("q"))) & (F.col("rp") != F.col("rq")) & alike & near & _in_order(F.col("mp"), F.col("mq"), F.col("n"), F.col("m")))
    out = materialise(pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "near-remaining")
    release(crowd, often, entries, postings, rows)
    return out


def _shared(dealt: DataFrame) -> DataFrame:
    """dealt's rows in buckets of several nodes, with size."""
    counts = materialise(dealt.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "near-buckets")
    out = materialise(join_groups(dealt, counts, "bucket", "size"), "near-members")
    release(counts)
    return out


def _shingle_table(docs: DataFrame, nodes: DataFrame, asked: DataFrame, text: str, ident: str) -> DataFrame:
    """Short shingles of the asked nodes, from the text of one row that stands for each."""
    reps = nodes.join(asked.select("_node"), "_node", "left_semi").select("_node", "rep._id", "rep._th")
    own = docs.select(*keys(docs, text, ident), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    own = own.join(reps.hint("merge"), ["_id", "_th"]).dropDuplicates(["_id", "_th"])
    own = own.select("_node", _short_shingles(F.transform(words(F.lower(F.col("_text"))), lambda x: F.xxhash64(x))).alias("s"))
    return materialise(own, "near-shingles")


def _verified(shingles: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of nodes whose similarity is at least SIMILAR; a node with very many partners is not gathered in one task."""
    met = pairs.groupBy("b").agg(F.count("*").alias("_n")).join(shingles.select(F.col("_node").alias("b"), F.col("s").alias("sb")).hint("merge"), "b")
    both = pairs.join(shingles.select(F.col("_node").alias("a"), F.col("s").alias("sa")).hint("merge"), "a")
    partners = materialise(met, "near-partners")
    both = join_groups(both, partners, "b", "_n", hot_share=0.005)
    out = materialise(both.select("a", "b", _aligned("sa", "sb").alias("alike")).where(F.col("alike") >= SIMILAR).select("a", "b"), "near-links")
    release(partners)
    return out


def dedup(docs: DataFrame) -> DataFrame:
    """docs with one document of each class of near-duplicates; all columns are returned as they were, whatever their names."""
    gone = materialise(classes(docs).where(~F.col("kept")).select("_id", "_th").distinct(), "near-gone")
    rows = docs.select(packed(docs), *keys(docs)).join(gone.hint("merge"), ["_id", "_th"], "left_anti")
    return rows.select(*unpacked(docs))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every document."""
    out = classes(documents(spark, sf_dir, "doc_id", "text"))
    lowest = lambda c: F.when(F.col(c) != F.lit(-(2**63)), F.col(c))
    return out.select(lowest("_id").alias("doc_id"), lowest("class_id").alias("class_id"), "kept")
