"""A Merkle manifest of a dataset: levels of aligned blocks as hex strings, proofs as their substrings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, documents, join_groups, materialise, release

#: Nodes that are hashed to their parent, levels that a block spans, nodes of a block, characters of a digest.
ARITY, DEPTH = 8, 3
SPAN, DIGEST = ARITY**DEPTH, 64
RUN = ARITY * DIGEST


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """The digest of a row's fields: `-` for a null, else the bytes of the value in UTF-8, their number and a colon before it."""
    text = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]))


def parents(level: Column) -> Column:
    """The next level of a block: each run of ARITY digests, the last may be shorter, becomes its digest."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / RUN))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level.cast("binary"), (i * RUN + 1).cast("int"), F.lit(RUN)), 256)), "")


def flanks(level: Column, at: Column) -> Column:
    """The siblings of node at of a level, as one string of digests before it and one of those behind it in its run."""
    start, place = F.floor(at / ARITY) * RUN, at % ARITY * DIGEST
    part = lambda begin, n: F.substring(level.cast("binary"), begin.cast("int"), n.cast("int")).cast("string")
    return F.struct(part(start + 1, place).alias("before"), part(start + place + DIGEST + 1, RUN - place - DIGEST).alias("behind"))


def blocks(nodes: DataFrame) -> DataFrame:
    """nodes(tree, at, n, node) as blocks of SPAN places: tree, block, n, levels, top.

    n is the number of nodes of the tree. levels holds one string of digests each, from the nodes upwards; a tree in one
    block goes up until one node is left, the blocks of a larger one all go up DEPTH levels. top is the node above them.
    """
    own = nodes.groupBy("tree", block_of("at"), "n").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "node"))), lambda x: x["node"]), "").alias("level"))

    def rise(levels: Column, k: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.when((F.col("n") > SPAN) | (F.octet_length(last) > DIGEST), F.concat(levels, F.array(parents(last)))).otherwise(levels)

    levels = F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.array("level"), rise)
    return own.select("tree", "block", "n", levels.alias("levels")).withColumn("top", F.element_at("levels", -1))


def block_of(at: str) -> Column:
    return F.floor(F.col(at) / SPAN).alias("block")


def steps(levels: Column, at: Column) -> Column:
    """The flanks of the node at a place of a block, on each level below the block's top."""
    return F.transform(F.slice(levels, 1, F.size(levels) - 1), lambda level, k: flanks(level, F.floor((at % SPAN) / F.pow(F.lit(float(ARITY)), k)).cast("long")))


def fold(node: Column, path: Column) -> Column:
    """The digest at the top when a node is hashed with the flanks of each level."""
    return F.aggregate(path, node, lambda h, s: digest(F.concat(s["before"], h, s["behind"])))


def climb(nodes: DataFrame) -> DataFrame:
    """blocks(nodes) with path, the flanks from the block's top to the root of its tree, and root; a scratch table.

    The tops of the blocks of a tree are the nodes of the next round, a SPAN-th of them; trees in one block are done.
    """
    own = materialise(blocks(nodes), "merkle-blocks")
    none = F.array().cast("array<struct<before:string,behind:string>>")
    done = own.where(F.col("n") <= SPAN).select("*", none.alias("path"), F.col("top").alias("root"))
    large = own.where(F.col("n") > SPAN)
    if large.isEmpty():
        return materialised_from(done, own)
    tops = large.select("tree", F.col("block").alias("at"), F.ceil(F.col("n") / SPAN).alias("n"), F.col("top").alias("node"))
    upper = climb(tops)
    paths = with_paths(tops, upper).select("tree", F.col("at").alias("block"), "path", "root")
    return materialised_from(done.unionByName(large.join(paths, ["tree", "block"])), own, upper)


def materialised_from(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """df as a scratch table; the scratch tables that it is made of are deleted."""
    out = materialise(df, "merkle-paths")
    release(*tables)
    return out


def with_paths(nodes: DataFrame, climbed: DataFrame) -> DataFrame:
    """nodes with path, the flanks from the node itself to the root, and root."""
    found = climbed.select("tree", "block", F.col("levels").alias("_levels"), F.col("path").alias("_path"), *[c for c in climbed.columns if c not in ("tree", "block", "n", "levels", "top", "path")])
    joined = nodes.withColumn("block", block_of("at")).join(found.hint("merge"), ["tree", "block"])
    return joined.withColumn("path", F.concat(steps(F.col("_levels"), F.col("at")), F.col("_path"))).drop("_levels", "_path", "block")


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with at, their place in their tree by order (from 0), and n, the tree's rows; a scratch table.

    Rows are range-partitioned and sorted by tree and order, so that no tree, however large, is one task. A partition
    numbers its own rows; what lies before a partition, a number for each, is counted and broadcast; so is each tree's start.
    """
    own = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    own = materialise(own.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")), "merkle-sorted")
    counts = sorted(tuple(r) for r in own.groupBy("_part").count().collect())
    before = [(part, sum(n for _, n in counts[:i])) for i, (part, _) in enumerate(counts)]
    numbered = own.join(F.broadcast(rows.sparkSession.createDataFrame(before, "_part int, _before long")), "_part").withColumn("_at", F.col("_before") + F.col("_row"))
    trees = materialise(numbered.groupBy(tree).agg(F.min("_at").alias("_first"), F.count("*").alias("n")), "merkle-trees")
    out = join_groups(numbered, trees, tree, "n").withColumn("at", F.col("_at") - F.col("_first"))
    return materialised_from(out.select(*rows.columns, "at", "n"), own, trees)


def manifest(rows: DataFrame, fields: list[str], tree: str, ident: str, seen: dict[str, Column] | None = None) -> DataFrame:
    """ident, leaf, subroot, root, proof (the flanks from leaf to root), seen (the leaf as it was read again), folded (the root that follows from it).

    Every row is a leaf. The leaves of one value of tree, in the order of ident, form a tree of arity ARITY; the trees'
    roots (subroot), in the order of tree, form the upper one. A run of fewer nodes, even of one, becomes its digest like
    any other; a lone leaf is its own root. seen has the values that some fields are found to have now; a row is intact
    if folded is root.

    A null tree comes first, then trees in the order of their bytes; a null ident comes first in its tree. Rows with one
    ident are ordered by their leaves; repeated rows are a leaf each, at places next to each other. Long texts are hashed
    whole. An empty table gives no rows. Only the named columns are read; others may have any names.
    """
    key = F.when(F.col(tree).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(tree).cast("string")))
    again = [(seen or {}).get(f, F.col(f)) for f in fields]
    # equal rows are told apart by a number, so that ranges can divide them
    narrow = rows.select(F.col(ident).alias("ident"), key.alias("tree"), leaf([F.col(f) for f in fields]).alias("leaf"), leaf(again).alias("seen"), F.monotonically_increasing_id().alias("tie"))
    narrow = materialise(narrow, "merkle-leaves")
    leaves = placed(narrow, "tree", ["ident", "leaf", "seen", "tie"])
    lower = climb(leaves.select("tree", "at", "n", F.col("leaf").alias("node")))
    roots = placed(lower.groupBy("tree").agg(F.first("root").alias("node"), F.count("*").alias("blocks")).withColumn("all", F.lit("")), "all", ["tree"])
    nodes = roots.select(F.col("all").alias("tree"), "at", "n", "node", "blocks", F.col("tree").alias("name"))
    upper = climb(nodes.select("tree", "at", "n", "node"))
    above = materialise(with_paths(nodes, upper).select(F.col("name").alias("tree"), "blocks", F.col("node").alias("subroot"), F.col("path").alias("_up"), F.col("root").alias("_top")), "merkle-above")
    whole = join_groups(lower, above, "tree", "blocks").withColumns({"path": F.concat("path", "_up"), "root": F.col("_top")})
    whole = materialised_from(whole.select("tree", "block", "n", "levels", "top", "path", "subroot", "root"), lower, roots, upper, above)
    release(narrow)
    out = with_paths(leaves.select("tree", "at", "ident", "leaf", "seen"), whole)
    return out.select(F.col("ident").alias(ident), "leaf", "subroot", "root", F.col("path").alias("proof"), "seen", fold(F.col("seen"), F.col("path")).alias("folded"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the manifest by language, and whether a third of them, with texts in lower case, still verify."""
    docs = documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    out = manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": F.when(changed, ascii_lower(F.col("text"))).otherwise(F.col("text"))})
    proof = digest(F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["behind"])), ""))
    return out.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


_FIELD = "case when {0} is null then '-' else strlen({0}::varchar)::varchar || ':' || {0}::varchar end"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "words")) + ")"
_CRC = "xor(4294967295, list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"
_STEPS = "coalesce(string_agg(s.h, '' order by s.pos) filter (s.pos < c.pos), '') || ':' || coalesce(string_agg(s.h, '' order by s.pos) filter (s.pos > c.pos), '')"
OP12_SQL = f"""
with recursive d as (select *, case when {_CRC} % 3 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as seen from documents),
l as (select doc_id, coalesce('1' || lang, '0') as tree, {_LEAF.replace("words", "text")} as leaf, {_LEAF.replace("words", "seen")} as seen from d),
p as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf, seen) - 1 as pos, count(*) over (partition by tree) as n from l),
t as (select tree, 0 as level, pos, leaf as h, n from p
  union all select tree, level + 1, pos // 8, sha256(string_agg(h, '' order by pos)), any_value((n + 7) // 8) from t where n > 1 group by tree, level, pos // 8),
r as (select tree, h as subroot, row_number() over (order by tree) - 1 as pos, count(*) over () as n from t where n = 1),
u as (select 0 as level, pos, subroot as h, n from r union all select level + 1, pos // 8, sha256(string_agg(h, '' order by pos)), any_value((n + 7) // 8) from u where n > 1 group by level, pos // 8),
low as (select tree, level, c.pos, any_value(c.n) as n, {_STEPS} as step from t c join t s using (tree, level) where c.n > 1 and s.pos // 8 = c.pos // 8 group by tree, level, c.pos),
high as (select level, c.pos, {_STEPS} as step from u c join u s using (level) where c.n > 1 and s.pos // 8 = c.pos // 8 group by level, c.pos),
paths as (select p.doc_id, p.tree, p.pos, p.leaf, p.seen, coalesce(list(low.step order by low.level) filter (low.step is not null), []) as path from p left join low on p.tree = low.tree and low.pos = p.pos // (8 ** low.level)::bigint group by all),
ups as (select r.tree, r.subroot, coalesce(list(high.step order by high.level) filter (high.step is not null), []) as path from r left join high on high.pos = r.pos // (8 ** high.level)::bigint group by all),
j as (select doc_id, leaf, seen, subroot, (select h from u where n = 1) as root, list_concat(paths.path, ups.path) as path from paths join ups using (tree)),
f as (select *, list_reduce([seen] || path, lambda h, s: sha256(split_part(s, ':', 1) || h || split_part(s, ':', 2))) as folded_root from j)
select doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), ':', '')) as proof_sha256, folded_root, folded_root = root as verified from f
"""
