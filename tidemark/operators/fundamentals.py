"""Fundamentals as they were known at a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Candidate tags of each concept, best first; concepts counted in shares; what the missing list looks at.
CONCEPTS = {
    "revenue": ("RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "RevenueFromContractWithCustomerIncludingAssessedTax", "SalesRevenueNet"),
    "operating_income": ("OperatingIncomeLoss",),
    "net_income": ("NetIncomeLoss", "ProfitLoss"),
    "dep_amort": ("DepreciationDepletionAndAmortization", "DepreciationAmortizationAndAccretionNet", "DepreciationAndAmortization", "Depreciation"),
    "cfo": ("NetCashProvidedByUsedInOperatingActivities", "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations"),
    "capex": ("PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets"),
    "cash": ("CashAndCashEquivalentsAtCarryingValue",),
    "lt_debt_noncurrent": ("LongTermDebtNoncurrent", "LongTermDebt"),
    "lt_debt_current": ("LongTermDebtCurrent", "DebtCurrent"),
    "interest_expense": ("InterestExpense", "InterestExpenseNonoperating", "InterestAndDebtExpense", "InterestExpenseDebt"),
    "diluted_shares": ("WeightedAverageNumberOfDilutedSharesOutstanding",),
    "sbc": ("ShareBasedCompensation", "AllocatedShareBasedCompensationExpense"),
    "inventory": ("InventoryNet",),
}
IN_SHARES = ("diluted_shares",)
LATEST_FIELDS = ("revenue", "operating_income", "net_income", "dep_amort", "cfo", "capex", "cash", "lt_debt_noncurrent", "interest_expense", "diluted_shares", "sbc")


def _yearly(facts: DataFrame) -> DataFrame:
    """10-K facts for the full year, flows over 330 to 400 days."""
    known = facts.where(F.col("form").startswith("10-K") & (F.col("fp") == "FY") & F.col("val").isNotNull())
    return known.where(F.col("start").isNull() | F.datediff("end", "start").between(330, 400))


def annual_facts(facts: DataFrame, as_of: str) -> DataFrame:
    """Yearly facts known by as_of: 10-K forms for the full year, flows over 330 to 400 days; per period end the last filed, the first of several."""
    known = _yearly(facts).where(F.col("filed") <= F.lit(as_of).cast("date"))
    w = Window.partitionBy("cik", "tag", "unit", "end").orderBy(F.col("filed").desc(), "pos")
    return known.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def concept_table(candidates: dict[str, tuple[str, ...]] = CONCEPTS) -> Column:
    """array<struct<concept, tag, prio, unit>> of all candidates; a few dozen entries."""
    return F.array(*[F.struct(F.lit(c).alias("concept"), F.lit(t).alias("tag"), F.lit(i).alias("prio"), F.lit("shares" if c in IN_SHARES else "USD").alias("unit")) for c, tags in candidates.items() for i, t in enumerate(tags)])


def fact_versions(facts: DataFrame) -> DataFrame:
    """Yearly facts with known_from and known_to: a fact holds from its filing until the next of the same period end (null: still).

    Of facts filed on one day the first holds. At any date the versions that hold are annual_facts() of that date.
    """
    same = ("cik", "tag", "unit", "end")
    first = Window.partitionBy(*same, "filed").orderBy("pos")
    df = _yearly(facts).where("filed is not null").withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
    return df.withColumns({"known_from": F.col("filed"), "known_to": F.lead("filed").over(Window.partitionBy(*same).orderBy("filed"))})


def _dates(days: Sequence[str]) -> Column:
    return F.array_sort(F.array_distinct(F.array(*[F.lit(d).cast("date") for d in days]).cast("array<date>")))


def resolve_concepts(annual: DataFrame, candidates: dict[str, tuple[str, ...]] = CONCEPTS, by: Sequence[str] = ("cik",)) -> DataFrame:
    """annual facts of the tag chosen for each company (by) and concept: the one that reaches the latest period, then the best candidate."""
    spark = annual.sparkSession
    table = F.broadcast(spark.range(1).select(F.inline(concept_table(candidates))))
    df = annual.join(table, ["tag", "unit"])
    reach = F.max("end").over(Window.partitionBy(*by, "concept", "tag"))
    df = df.withColumn("_reach", reach)
    best = F.min(F.struct(-F.unix_date("_reach"), F.col("prio"))).over(Window.partitionBy(*by, "concept"))
    return df.withColumn("_best", best["prio"]).where(F.col("prio") == F.col("_best")).drop("_best", "_reach", "prio")


def build_snapshot(facts: DataFrame, as_of: str, max_years: int = 6, candidates: dict[str, tuple[str, ...]] = CONCEPTS) -> DataFrame:
    """One wide row per company and fiscal year end, the last max_years of them; filed is the latest of the facts used."""
    return _wide(annual_facts(facts, as_of), max_years, candidates, ("cik",))


def _wide(annual: DataFrame, max_years: int, candidates: dict[str, tuple[str, ...]], by: Sequence[str]) -> DataFrame:
    chosen = resolve_concepts(annual, candidates, by)
    wide = chosen.groupBy(*by, F.col("end").alias("fiscal_year_end")).agg(F.max("filed").alias("filed"), *[F.max(F.when(F.col("concept") == c, F.col("val").cast("double"))).alias(c) for c in candidates])
    w = Window.partitionBy(*by).orderBy(F.col("fiscal_year_end").desc())
    return wide.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= max_years).drop("_rank").withColumn("fiscal_year", F.year("fiscal_year_end"))


def build_snapshots(facts: DataFrame, as_of: Sequence[str], max_years: int = 6, candidates: dict[str, tuple[str, ...]] = CONCEPTS) -> DataFrame:
    """build_snapshot() of each date of as_of, in one pass over facts, with a column as_of.

    A company's snapshot changes only on days on which it files. The dates asked for are set back to the last of those
    days, so that a snapshot is made once per company and state, however many dates see that state. Repeated dates count
    once; no dates give no rows.
    """
    versions = fact_versions(facts)
    filed = versions.groupBy("cik").agg(F.collect_set("known_from").alias("_filed"))
    state = lambda d: F.array_max(F.filter("_filed", lambda f: f <= d))
    asked = filed.select("cik", F.explode(F.transform(_dates(as_of), lambda d: F.struct(d.alias("as_of"), state(d).alias("_state")))).alias("a")).select("cik", "a.*").where("_state is not null")
    states = asked.groupBy("cik").agg(F.collect_set("_state").alias("_states"))
    holds = F.filter("_states", lambda d: (F.col("known_from") <= d) & (F.col("known_to").isNull() | (F.col("known_to") > d)))
    annual = versions.join(states, "cik").withColumn("_state", F.explode(holds)).drop("_states", "known_from", "known_to")
    return _wide(annual, max_years, candidates, ("cik", "_state")).join(asked, ["cik", "_state"]).drop("_state")


def with_fundamental_metrics(df: DataFrame) -> DataFrame:
    """fcf, ebitda, total_debt, net_debt, interest_coverage and sbc_to_fcf; what is not reported stays null."""
    c = F.col
    debt = F.when(c("lt_debt_current").isNotNull() | c("lt_debt_noncurrent").isNotNull(), F.coalesce("lt_debt_current", F.lit(0.0)) + F.coalesce("lt_debt_noncurrent", F.lit(0.0)))
    df = df.withColumns({"fcf": c("cfo") - c("capex"), "ebitda": c("operating_income") + c("dep_amort"), "total_debt": debt})
    return df.withColumns({"net_debt": c("total_debt") - c("cash"), "interest_coverage": F.when(c("interest_expense") > 0, c("operating_income") / c("interest_expense")), "sbc_to_fcf": F.when(c("fcf") > 0, c("sbc") / c("fcf"))})


def missing_concepts(latest: DataFrame) -> DataFrame:
    """latest with missing: the names of LATEST_FIELDS that are null, in that order."""
    return latest.withColumn("missing", F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in LATEST_FIELDS])))


def _recent(annual: DataFrame, keep: Column | None = None) -> DataFrame:
    df = annual.where(keep) if keep is not None else annual
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy("cik").orderBy(F.col("fiscal_year_end").desc())))


def fcf_positive_count(annual: DataFrame, years: int = 5) -> DataFrame:
    """Per company over its last years: positive and computable free cash flows."""
    return _recent(annual).where(F.col("_rank") <= years).groupBy("cik").agg(F.count_if(F.col("fcf") > 0).alias("positive"), F.count("fcf").alias("computable"))


def share_growth(annual: DataFrame) -> DataFrame:
    """Growth of diluted shares over the last two years that report them; null without two or a positive earlier count."""
    last = _recent(annual, F.col("diluted_shares").isNotNull()).where("_rank <= 2").groupBy("cik").agg(F.max(F.when(F.col("_rank") == 1, F.col("diluted_shares"))).alias("a"), F.max(F.when(F.col("_rank") == 2, F.col("diluted_shares"))).alias("b"))
    return last.select("cik", F.when(F.col("b") > 0, F.col("a") / F.col("b") - 1).alias("diluted_share_growth"))


def inventory_vs_sales(annual: DataFrame) -> DataFrame:
    """Inventory growth less revenue growth over the last two years; null if a figure is missing or an earlier one not positive."""
    pick = lambda c, r: F.max(F.when(F.col("_rank") == r, F.col(c)))
    last = _recent(annual).where("_rank <= 2").groupBy("cik").agg(pick("inventory", 1).alias("i1"), pick("inventory", 2).alias("i0"), pick("revenue", 1).alias("r1"), pick("revenue", 2).alias("r0"))
    c = F.col
    return last.select("cik", F.when((c("i0") > 0) & (c("r0") > 0), (c("i1") / c("i0") - 1) - (c("r1") / c("r0") - 1)).alias("inventory_vs_sales"))


def pit_common_shares(facts: DataFrame, cutoff: str) -> DataFrame:
    """Per company the latest positive share count filed, and for a period ended, by the cutoff: filed, end, accn, val, form."""
    day = F.lit(cutoff).cast("date")
    known = _share_counts(facts).where((F.col("filed") <= day) & (F.col("end") <= day))
    return known.groupBy("cik").agg(F.max(F.struct(*_COUNT)).alias("f")).select("cik", "f.*")


_COUNT = ("filed", "end", "accn", "val", "form")


def _share_counts(facts: DataFrame) -> DataFrame:
    form = F.col("form").startswith("10-K") | F.col("form").startswith("10-Q") | F.col("form").startswith("8-K")
    return facts.where(form & (F.col("val") > 0))


def common_shares_at(facts: DataFrame, cutoffs: Sequence[str]) -> DataFrame:
    """pit_common_shares() of each cutoff, in one pass over facts, with a column cutoff.

    Counts are first reduced to one per company and the first cutoff that knows them, then each cutoff takes the latest
    of its own and the earlier ones. Repeated cutoffs count once; no cutoffs give no rows.
    """
    since = F.get(F.filter(_dates(cutoffs), lambda d: (F.col("filed") <= d) & (F.col("end") <= d)), 0)
    best = _share_counts(facts).withColumn("_since", since).where("_since is not null").groupBy("cik", "_since").agg(F.max(F.struct(*_COUNT)).alias("f"))
    own = best.groupBy("cik").agg(F.collect_list(F.struct("_since", "f")).alias("_all"))
    upto = lambda d: F.array_max(F.transform(F.filter("_all", lambda x: x["_since"] <= d), lambda x: x["f"]))
    rows = own.select("cik", F.explode(F.transform(_dates(cutoffs), lambda d: F.struct(d.alias("cutoff"), upto(d).alias("f")))).alias("r"))
    return rows.where("r.f is not null").select("cik", "r.cutoff", "r.f.*")
