"""The typed facts model: supersession, trailing-twelve-month preference, amendments, fiscal calendar, conformation.

A grain is one reported figure; its versions have a total order, so ties are decided alike everywhere. Ordinary grains are
windows over one hash partitioning. A grain that by itself holds more rows than a task takes is split by salt: each part
finds its own first row, the parts' firsts are compared, and the outcome goes back to the rows by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.operators.buckets import ROWS_PER_TASK, hot_keys
from tallystone.plans import values as V
from tallystone.runtime import key128, maybe_broadcast, stage

GRAIN = ["cik", "concept", "unit", "start_date", "end_date"]
ORDER = ["filed_date", "accession_number", "fact_id"]


def firsts(df: DataFrame, key: list[str], order: list[Column], pick: dict[str, Column], whole: dict[str, Column] | None = None, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """df plus _first (is the row the first of its group in order? exactly one is), the first row's values `pick`, and
    aggregates over the group, `whole` (minima, maxima or sums of columns, by name). Null keys equal null."""
    whole = whole or {}
    h1, h2 = key128(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in key])
    df = df.withColumns({"_h1": h1, "_h2": h2})
    _, hot = hot_keys(df.select("_h1", "_h2"), ["_h1", "_h2"], per_task)

    def windowed(x: DataFrame, by: list[str]) -> DataFrame:
        p = W.partitionBy(*by)
        w = p.orderBy(*order)
        return x.withColumns({"_first": F.row_number().over(w) == 1} | {n: F.first(c).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) for n, c in pick.items()} | {n: c.over(p) for n, c in whole.items()})

    if hot is None:
        return windowed(df, ["_h1", "_h2"]).drop("_h1", "_h2")
    h = maybe_broadcast(hot)
    cold = windowed(df.join(h, ["_h1", "_h2"], "left_anti"), ["_h1", "_h2"])
    salted = df.join(h, ["_h1", "_h2"]).withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in ("_h1", "_h2")]), F.col("_parts"))).drop("_parts")
    local = windowed(salted, ["_h1", "_h2", "_part"])
    heads = stage(local.where("_first"), "firsts")  # one row a part; their number is bounded by the rows over per_task
    keep = ["_h1", "_h2", "_part", *pick, *whole]
    top = W.partitionBy("_h1", "_h2")
    best = heads.withColumn("_n", F.row_number().over(top.orderBy(*order, "_part"))).withColumns({n: F.first(n).over(top.orderBy(*order, "_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) for n in pick} | {n: (F.sum(n) if n.startswith("_sum") else F.min(n) if n.startswith("_min") else F.max(n)).over(top) for n in whole})
    best = best.select(*keep, (F.col("_n") == 1).alias("_head"))
    out = local.drop(*pick, *whole).join(maybe_broadcast(best), ["_h1", "_h2", "_part"]).withColumn("_first", F.col("_first") & F.col("_head")).drop("_head", "_part")
    return cold.unionByName(out).drop("_h1", "_h2")


def supersede(df: DataFrame, grain: list[str] = GRAIN, order: list[str] = ORDER, winner: str = "accession_number", per_task: int = ROWS_PER_TASK) -> DataFrame:
    """is_superseded and superseded_by: within a grain (nulls are a value) the last in order stays, the others name it."""
    f = firsts(df, grain, [F.col(c).desc_nulls_last() for c in order], {"_by": F.col(winner)}, per_task=per_task)
    return f.withColumns({"is_superseded": ~F.col("_first"), "superseded_by": F.when(~F.col("_first"), F.col("_by"))}).drop("_first", "_by")


def prefer_fiscal_year(df: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Among facts of a whole year that aren't superseded and begin on different days (trailing twelve months), keep the
    one whose end month is the company's year end (the first in order), else the latest end; the others are superseded.
    Companies without a year end are left alone."""
    open_ = ~F.coalesce("is_superseded", F.lit(False)) & (F.col("fiscal_period") == "FY") & F.col("start_date").isNotNull() & X.end_month(F.col("fiscal_year_end")).isNotNull()
    marked = df.withColumn("_ttm", F.coalesce(open_, F.lit(False)))
    match = F.coalesce(F.month("end_date") == X.end_month(F.col("fiscal_year_end")), F.lit(False))
    order = [match.desc(), F.when(~match, F.col("end_date")).desc(), *[F.col(c) for c in ORDER]]
    year = firsts(marked.where("_ttm"), ["cik", "concept", "unit", "fiscal_year"], order, {"_keeps": F.col("accession_number")}, {"_min_start": F.min("start_date"), "_max_start": F.max("start_date")}, per_task)
    lost = (F.col("_min_start") != F.col("_max_start")) & ~F.col("_first")
    year = year.withColumns({"is_superseded": F.when(lost, True).otherwise(F.col("is_superseded")), "superseded_by": F.when(lost, F.col("_keeps")).otherwise(F.col("superseded_by"))})
    return year.select(*df.columns).unionByName(marked.where("NOT _ttm").select(*df.columns))


def model(raw: DataFrame, entities: DataFrame, concepts: DataFrame) -> DataFrame:
    """Raw rows to typed facts. Companies without an entity and rows without a period end drop out; unmapped concepts are
    other / uncategorized, tier 3. Of several entity rows of a company the last by mapping_id counts."""
    e = entities.groupBy("cik").agg(F.max_by(F.struct(F.col("mapping_id").alias("entity_id"), "canonical_name", "ticker", "fiscal_year_end"), "mapping_id").alias("e")).select("cik", "e.*")
    c = concepts.groupBy("concept").agg(F.max_by(F.struct("business_term_id", "business_term", "financial_statement", "category", "tier"), F.coalesce("business_term_id", F.lit(""))).alias("c")).select("concept", "c.*")
    f = raw.where(F.col("end_date").isNotNull()).join(maybe_broadcast(e), "cik").join(maybe_broadcast(c), "concept", "left")
    f = f.withColumns({"financial_statement": F.coalesce("financial_statement", F.lit("other")), "category": F.coalesce("category", F.lit("uncategorized")), "tier": F.coalesce("tier", F.lit(3))})
    f = f.withColumns({"fiscal_year": X.fiscal_year(F.col("end_date"), F.col("fiscal_year_end")), "fiscal_period": X.fiscal_period(F.col("start_date"), F.col("end_date"), F.col("fiscal_period"))})
    f = f.withColumns({"calendar_year": F.year("end_date"), "calendar_quarter": F.quarter("end_date"), "is_amendment": X.is_amendment(F.col("form")), "fact_id": X.grain_hash("cik", "concept", "unit", "start_date", "end_date", "accession_number")})
    return prefer_fiscal_year(supersede(f))


def amendments(facts: DataFrame, grain: list[str] = GRAIN, order: list[str] = ORDER, value: str = "val", per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each earlier filing of a grain beside the latest: change, and change in percent of the size of the earlier value
    (null where that is 0)."""
    pick = ["accession_number", "filed_date", "form", value]
    m = firsts(facts, grain, [F.col(c).desc_nulls_last() for c in order], {f"_{c}": F.col(c) for c in pick}, per_task=per_task).where(~F.col("_first"))
    return m.select(*grain, F.col("accession_number").alias("original_accession"), F.col("filed_date").alias("original_filed_date"), F.col(value).alias("original_val"), F.col("_accession_number").alias("amendment_accession"), F.col("_filed_date").alias("amendment_filed_date"), F.col(f"_{value}").alias("amendment_val"), F.col("_form").alias("amendment_form"), (F.col(f"_{value}") - F.col(value)).alias("val_change"), X.pct_of_abs(F.col(f"_{value}"), F.col(value), 100.0).alias("val_change_pct"))


def fiscal_calendar(facts: DataFrame) -> DataFrame:
    """First and last day of each company's fiscal periods; a null start doesn't count."""
    c = facts.groupBy("cik", "fiscal_year", "fiscal_period").agg(F.min("start_date").alias("period_start"), F.max("end_date").alias("period_end"))
    return c.withColumns({"duration_days": F.datediff("period_end", "period_start"), "is_annual": F.col("fiscal_period") == "FY", "calendar_id": X.grain_hash("cik", "fiscal_year", "fiscal_period")})


def canonical_term(c: Column) -> Column:
    """Legacy ids become terms; others stay."""
    m = F.create_map(*[F.lit(x) for kv in V.LEGACY.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def conform(facts: DataFrame) -> DataFrame:
    """One authoritative fact for each company, term, fiscal year and period: the only one, else by the term's preferred
    concepts, else by tier and how common the concept is. competing_fact_count and selection_reason say how."""
    f = facts.where(~F.coalesce("is_superseded", F.lit(False)) & F.col("business_term_id").isNotNull() & F.col("fiscal_year").isNotNull())
    f = f.withColumn("business_term_id", canonical_term(F.col("business_term_id")))
    rows = [(t, u, c, i) for t, (u, cs) in V.PRIORITIES.items() for i, c in enumerate(cs)]
    spark = facts.sparkSession
    units = spark.createDataFrame([(t, u) for t, (u, _) in V.PRIORITIES.items()], "business_term_id string, unit string")  # a fixed table
    first = spark.createDataFrame([(t, c, i) for t, _, c, i in rows], "business_term_id string, concept string, _place int")
    f = f.join(F.broadcast(units), ["business_term_id", "unit"]).join(F.broadcast(first), ["business_term_id", "concept"], "left")
    common = f.groupBy("concept").agg(F.count(F.lit(1)).alias("_freq"))
    f = f.join(maybe_broadcast(common), "concept")
    key = ["cik", "business_term_id", "fiscal_year", "fiscal_period"]
    by_concept = F.col("_place").isNotNull()
    last = [F.col(c) for c in ("val", "promoted_at") if c in facts.columns]
    w = W.partitionBy(*key).orderBy(F.col("_place").asc_nulls_last(), F.when(~by_concept, F.coalesce("tier", F.lit(3))), F.when(~by_concept, -F.col("_freq")), *[F.col(c) for c in ORDER], *last)
    won = f.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1)  # groups are limited before the shuffle
    n = f.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.count(F.lit(1)).alias("competing_fact_count"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    f = won.join(n, same).drop(*[f"_{c}" for c in key])
    reason = F.when(F.col("competing_fact_count") == 1, "sole_candidate").when(by_concept, "primary_concept").otherwise("tier_frequency_fallback")
    return f.withColumns({"selection_reason": reason, "conformed_id": X.grain_hash(*key)}).drop("_place", "_freq", "_rank")
