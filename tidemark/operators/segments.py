"""Row order within a series without a series in one task: windows over a series' segments and a small table of their edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of arrival are cut into segments of so many; times are cut by month.
SPAN = 1 << 20


def stacked(rows: DataFrame, few: DataFrame) -> DataFrame:
    """rows and few more, by name; columns that one lacks are null.

    few is dealt out anew: a union of two sides that are partitioned alike keeps their partitions, and fails when one side
    turns out to be empty at run time and is planned again with another number of them.
    """
    return rows.unionByName(few.hint("rebalance"), allowMissingColumns=True)


def segment(df: DataFrame, by: str) -> Column:
    """The segment of a row, ascending with by: months since year 0 of a time, SPAN numbers otherwise; null stays null."""
    kind = df.schema[by].dataType
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.year(by) * 12 + F.month(by)
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(by) / SPAN).cast("long")
    raise ValueError(f"{by} must be a time or a number")


def _edges(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per segment of a series what its neighbours end and begin with: _before and _after, the values of the last row before and of the first one behind.

    One row per series is made of its segments, of which a year has twelve.
    """
    ends = rows.groupBy(*keys, "_segment").agg(F.min(F.struct("_by", "_value")).alias("first"), F.max(F.struct("_by", "_value")).alias("last"))
    all_ends = ends.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_segment", "first", "last"))).alias("e"))
    near = F.transform("e", lambda x, i: F.struct(x["_segment"].alias("_segment"), F.get("e", i - 1)["last"]["_value"].alias("_before"), F.get("e", i + 1)["first"]["_value"].alias("_after")))
    return all_ends.select(*keys, F.inline(near))


def neighbours(df: DataFrame, keys: Sequence[str], before: dict[str, str] | None = None, after: dict[str, str] | None = None, by: str = "timestamp") -> DataFrame:
    """df with the values that columns have in the row before or after in the order of by: {new column: column}.

    A series is cut into segments (see segment) and each window has one of them; the rows next to its edges come from a
    table of one row per segment, also over segments without rows. Rows with an equal by are ordered by these values, nulls
    first; a null by comes first. Series may have null keys. No window holds a whole series, however long.
    """
    before, after = before or {}, after or {}
    wanted = list(dict.fromkeys([*before.values(), *after.values()]))
    value = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(wanted)])
    rows = df.withColumns({"_segment": segment(df, by), "_by": F.col(by), "_value": value, "_side": F.lit(0)})
    edges = _edges(rows, keys)
    ghosts = edges.select(*keys, "_segment", F.inline(F.array(F.struct(F.lit(-1).alias("_side"), F.col("_before").alias("_value")), F.struct(F.lit(1).alias("_side"), F.col("_after").alias("_value")))))
    both = stacked(rows, ghosts)
    w = Window.partitionBy(*keys, "_segment").orderBy("_side", "_by", "_value")
    found = {"_lag": F.lag("_value").over(w)} if before else {}
    found |= {"_lead": F.lead("_value").over(w)} if after else {}
    out = both.withColumns(found).where("_side = 0")
    new = {n: F.col("_lag")[f"v{wanted.index(c)}"] for n, c in before.items()} | {n: F.col("_lead")[f"v{wanted.index(c)}"] for n, c in after.items()}
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], *[v.alias(n) for n, v in new.items()])


def _prefixes(rows: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Per segment of a series the greatest value in all segments before it, under name."""
    own = rows.groupBy(*keys, "_segment").agg(F.max(value).alias("_most"))
    every = own.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_segment", "_most"))).alias("e"))
    near = F.transform("e", lambda x, i: F.struct(x["_segment"].alias("_segment"), F.array_max(F.slice(F.col("e")["_most"], F.lit(1), i)).alias(name)))
    return every.select(*keys, F.inline(near))


def carried(df: DataFrame, keys: Sequence[str], column: str, name: str, by: str = "timestamp") -> DataFrame:
    """df with name, the last value of column up to the row that is not null, in the order of by.

    Rows with an equal by see each other's, and of several values the greatest. Segments as in neighbours.
    """
    rows = df.withColumns({"_segment": segment(df, by), "_by": F.col(by), "_side": F.lit(0), "_held": F.when(F.col(column).isNotNull(), F.struct(F.col(by).alias("at"), F.col(column).alias("value")))})
    ghosts = _prefixes(rows, keys, F.col("_held"), "_held").withColumn("_side", F.lit(-1))
    w = Window.partitionBy(*keys, "_segment").orderBy("_side", "_by").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = stacked(rows, ghosts).withColumn("_last", F.max("_held").over(w)).where("_side = 0")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col("_last.value").alias(name))


def reach(df: DataFrame, keys: Sequence[str], at: str, end: str, name: str, *ties: str) -> DataFrame:
    """df with name, the greatest end of all rows before the row, in the order of at and then ties; null for the first."""
    rows = df.withColumns({"_segment": segment(df, at), "_at": F.col(at), "_side": F.lit(0), "_end": F.col(end)})
    ghosts = _prefixes(rows, keys, F.col("_end"), "_end").withColumn("_side", F.lit(-1))
    w = Window.partitionBy(*keys, "_segment").orderBy("_side", "_at", *ties).rowsBetween(Window.unboundedPreceding, -1)
    out = stacked(rows, ghosts).withColumn("_reach", F.max("_end").over(w)).where("_side = 0")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col("_reach").alias(name))
