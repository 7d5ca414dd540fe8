"""Valid time, filing time and system time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.operators.facts import GRAIN


def current(facts: DataFrame, cik: int | None = None, concept: str | None = None, business_term_id: str | None = None) -> DataFrame:
    """Facts that aren't superseded, optionally of a company, concept or term."""
    out = facts.where(~F.coalesce("is_superseded", F.lit(False)))
    for name, x in (("cik", cik), ("concept", concept), ("business_term_id", business_term_id)):
        out = out if x is None else out.where(F.col(name) == x)
    return out


def as_known_on(facts: DataFrame, day: str, grain: list[str] = GRAIN, order: tuple[str, ...] = ("filed_date", "accession_number", "fact_id")) -> DataFrame:
    """The version of each figure that was the latest filed by the end of a day. Later flags don't count."""
    w = W.partitionBy(*grain).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return facts.where(F.col(order[0]) <= F.lit(day).cast("date")).withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def history(facts: DataFrame, cik: int, concept: str, start: str | None, end: str, unit: str = "USD") -> DataFrame:
    """Every version of one figure in order of filing; a null start is a value."""
    same = (F.col("cik") == cik) & (F.col("concept") == concept) & F.col("start_date").eqNullSafe(F.lit(start).cast("date")) & (F.col("end_date") == F.lit(end).cast("date")) & (F.col("unit") == unit)
    return facts.where(same).orderBy("filed_date", "accession_number", "fact_id")


def compare(facts: DataFrame, end1: str, end2: str, unit: str = "USD") -> DataFrame:
    """Current values of two period ends for every company and concept that has both: change, and percent of the signed
    first value, rounded to 2 (null where that is 0). Of several values of an end the greatest counts."""
    c = current(facts).where(F.col("unit") == unit)
    pick = lambda e: F.max(F.when(F.col("end_date") == F.lit(e).cast("date"), F.col("val")))
    p = c.where(F.col("end_date").isin(F.lit(end1).cast("date"), F.lit(end2).cast("date"))).groupBy("cik", "concept").agg(pick(end1).alias("period1_val"), pick(end2).alias("period2_val"))
    p = p.where(F.col("period1_val").isNotNull() & F.col("period2_val").isNotNull()).withColumn("change", F.col("period2_val") - F.col("period1_val"))
    return p.withColumn("pct_change", F.bround(F.try_divide("change", "period1_val") * 100, 2))


def validate(facts: DataFrame, today: str | None = None, tolerance: float = 99.0) -> DataFrame:
    """The temporal rules in one pass and one join: check, violations, passed. An empty table passes."""
    now = F.lit(today).cast("date") if today else F.current_date()
    sup = F.col("superseded_by")
    filed = facts.where(F.col("accession_number").isNotNull()).groupBy(F.col("accession_number").alias("superseded_by")).agg(F.max("filed_date").alias("_by_filed"))
    slim = facts.select("filed_date", "start_date", "end_date", "is_superseded", "superseded_by")
    none = slim.where(sup.isNull()).withColumn("_by_filed", F.lit(None).cast("date"))  # most rows: they have nobody to look for
    j = slim.where(sup.isNotNull()).join(filed, "superseded_by", "left").unionByName(none)
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    one = j.agg(
        n(F.col("filed_date") > now).alias("future_filed"), n(F.col("start_date") >= F.col("end_date")).alias("start_not_before_end"), n(F.coalesce("is_superseded", F.lit(False)) & (F.col("filed_date") > F.col("_by_filed"))).alias("superseded_later"),
        n(F.col("filed_date") < F.col("end_date")).alias("filed_before_end"), n(sup.isNotNull() & F.col("_by_filed").isNull()).alias("unknown_successor"), F.count(F.lit(1)).alias("rows"),
    )
    checks = ["future_filed", "start_not_before_end", "superseded_later", "filed_before_end", "unknown_successor"]
    share_ok = F.col("rows") == 0
    cells = [F.struct(F.lit(c).alias("check"), F.col(c).cast("long").alias("violations"), (share_ok | ((100.0 * (F.col("rows") - F.col(c)) / F.greatest("rows", F.lit(1)) >= tolerance) if c == "filed_before_end" else F.col(c) == 0)).alias("passed")) for c in checks]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
