"""Chat formatting after the collapse of cumulative snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

#: How a turn is rendered; {role} and {text} are filled in.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _conversation():
    """What tells conversations apart: a null conv_id is one of its own, and another than the empty one."""
    return F.when(F.col("conv_id").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("conv_id").cast("string"))).alias("_conv")


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Per turn: _conv, _idx (from 1), _n (turns of its conversation), _p and _q (128 bits of hash of the turns up to it).

    The hash of a prefix is the exclusive or of hashes of (position, role, text), so that it rolls with a running
    aggregate; the order counts because the position is hashed too. Turns are put in the order of turn, role and text.
    """
    by_turn = Window.partitionBy("_conv").orderBy("turn", "role", "text")
    so_far = by_turn.rowsBetween(Window.unboundedPreceding, 0)
    df = turns.select(_conversation(), "turn", "role", "text").withColumn("_idx", F.row_number().over(by_turn).cast("long"))
    content = [F.col("_idx"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    df = df.withColumns({"_p": F.bit_xor(F.xxhash64(F.lit(1), *content)).over(so_far), "_q": F.bit_xor(F.xxhash64(*content, F.lit(2))).over(so_far)})
    return df.select("_conv", "_idx", "_p", "_q", F.count("*").over(Window.partitionBy("_conv")).alias("_n"))


def collapse(turns: DataFrame) -> DataFrame:
    """The conversations to keep: _conv, n_turns, copies (conversations with the same turns).

    A conversation goes if its turns are the first turns of a longer one; an anti-join of whole-conversation hashes with
    the hashes of proper prefixes finds it. Of conversations with the same turns the one with the smallest conv_id (as
    a number; null first) stays. Hashes are made distinct before the join, so a common first turn is one row of it.
    """
    prefixes = materialise(turn_prefixes(turns), "chat-prefixes")
    whole = prefixes.where("_idx = _n").groupBy("_n", "_p", "_q").agg(F.min(F.struct(F.try_to_number(F.substring("_conv", 2, 2**30), F.lit("S9999999999999999999")).alias("number"), F.col("_conv").alias("conv"))).alias("least"), F.count("*").alias("copies"))
    proper = prefixes.where("_idx < _n").select(F.col("_idx").alias("_n"), "_p", "_q").distinct()
    kept = whole.join(proper, ["_n", "_p", "_q"], "left_anti")
    return kept.select(F.col("least.conv").alias("_conv"), F.col("_n").alias("n_turns"), "copies")


def render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies, chat: one rendered text per maximal conversation, turns in order, nulls as empty.

    All turns without a conv_id are one conversation, an empty conv_id is another. Repeated turns stay, next to each other.
    Long turns are hashed and rendered whole; a conversation is one value of the result, so that its turns must fit into
    one row. An empty input gives no rows. Columns but conv_id, turn, role and text are not read.
    """
    kept = materialise(collapse(turns), "chat-kept")
    own = turns.select(_conversation(), "conv_id", "turn", "role", "text").join(kept, "_conv")
    line = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    rows = own.groupBy("_conv").agg(F.first("conv_id").alias("conv_id"), F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("turn", "role", "text", line.alias("line")))).alias("turns"))
    return rows.select("conv_id", "n_turns", "copies", F.array_join(F.col("turns.line"), "").alias("chat"))


def op8_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations that no longer one begins with, rendered."""
    out = render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return out.select("conv_id", "n_turns", "copies", "chat", F.sha2(F.col("chat").cast("binary"), 256).alias("chat_sha256"))


OP8_SQL = """
with t as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn, role, text) as i from conversations),
lines as (select *, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) as line,
  list(struct_pack(r := role, x := text)) over (partition by conv_id order by i rows between unbounded preceding and current row) as prefix from t),
convs as (select conv_id, count(*) as n_turns, string_agg(line, '' order by i) as chat, arg_max(prefix, i) as whole from lines group by conv_id),
proper as (select distinct l.prefix from lines l join convs c using (conv_id) where l.i < c.n_turns)
select min(conv_id) as conv_id, any_value(n_turns) as n_turns, count(*) as copies, any_value(chat) as chat, sha256(any_value(chat)) as chat_sha256
from convs where not exists (select 1 from proper p where p.prefix = convs.whole) group by whole
"""
