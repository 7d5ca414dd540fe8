"""Checks on built tables: figures against expected ones, what must not be there, latest results of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.runtime import maybe_broadcast

GRAIN = ["cik", "business_term_id", "fiscal_year", "fiscal_period"]
#: Percent of the expected figure within which an actual one matches, or is close.
MATCH, CLOSE = 1.0, 5.0


def figures(expected: DataFrame, actual: DataFrame, key: list[str] = GRAIN, value: str = "val") -> DataFrame:
    """Each expected figure with the actual one, their difference in percent and a status: MATCH, CLOSE, MISMATCH, or MISSING
    where there is none. An expected 0 is matched by 0 only. Null keys find nothing; one row a key on either side."""
    e = expected.select(*key, F.col(value).alias("expected"))
    j = e.join(actual.select(*key, F.col(value).alias("actual")), key, "left")
    off = F.when(F.col("expected") != 0, F.abs(F.col("actual") - F.col("expected")) / F.abs("expected") * 100).when(F.col("actual") == 0, 0.0).otherwise(100.0)
    j = j.withColumn("pct_diff", F.when(F.col("actual").isNotNull(), off))
    status = F.when(F.col("actual").isNull(), "MISSING").when(F.col("pct_diff") < MATCH, "MATCH").when(F.col("pct_diff") < CLOSE, "CLOSE").otherwise("MISMATCH")
    return j.withColumn("status", status)


def latest(results: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last result of each key in order. Groups are limited before the shuffle."""
    return results.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where(F.col("_n") == 1).drop("_n")


def repeated(df: DataFrame, key: list[str]) -> DataFrame:
    """violations: keys that occur more than once (null equals null)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("violations"))


def absent(df: DataFrame, parents: DataFrame, key: list[str], parent_key: list[str] | None = None) -> DataFrame:
    """violations: rows whose key the parents don't have; a null in a key is found nowhere."""
    names = [f"_k{i}" for i in range(len(key))]
    p = parents.select(*[F.col(c).alias(n) for c, n in zip(parent_key or key, names, strict=True)]).distinct()
    cond = [F.col(c) == F.col(n) for c, n in zip(key, names, strict=True)]
    return df.join(maybe_broadcast(p), cond, "left_anti").agg(F.count(F.lit(1)).alias("violations"))


def broken(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).alias("violations"))


def negative(t: dict[str, DataFrame], per_share: list[str]) -> DataFrame:
    """Ten things that must not be there: check, violations. t: conformed_facts, financial_facts, company_financials,
    financial_ratios, peer_comparison."""
    fin, conf, rat = t["company_financials"], t["conformed_facts"], t["financial_ratios"]
    unit = F.when(F.col("business_term_id").isin(per_share), F.lit("USD/shares")).otherwise("USD")
    collisions = fin.groupBy("cik", "business_term_id", "period_end_date", "fiscal_period").agg(F.countDistinct("fiscal_year").alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("violations"))
    period = ["fiscal_year", "fiscal_period"]
    sizes = fin.agg(F.count(F.lit(1)).alias("a")).join(F.broadcast(conf.agg(F.count(F.lit(1)).alias("b"))), F.lit(True)).select(F.abs(F.col("a") - F.col("b")).alias("violations"))  # one row each
    superseded = t["financial_facts"].where("is_superseded").select("fact_id").distinct()
    parts = {
        "duplicate_grains": repeated(fin, GRAIN),
        "superseded_facts": conf.join(superseded, "fact_id", "left_semi").agg(F.count(F.lit(1)).alias("violations")),
        "null_business_term": broken(conf, F.col("business_term_id").isNull()),
        "null_fiscal_year": broken(conf, F.col("fiscal_year").isNull()),
        "wrong_units": broken(conf, ~F.col("unit").eqNullSafe(unit)),
        "fiscal_year_collisions": collisions,
        "orphan_numerators": absent(rat, fin, ["cik", "numerator_bt_id", *period], GRAIN),
        "orphan_denominators": absent(rat, fin, ["cik", "denominator_bt_id", *period], GRAIN),
        "row_count_difference": sizes,
        "duplicate_peer_rankings": repeated(t["peer_comparison"], ["cik", "metric_id", *period, "metric_source"]),
        "cross_zone_grains": absent(fin, conf, GRAIN),
    }
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("check"), F.col("violations").cast("long").alias("violations"))
        out = one if out is None else out.unionByName(one)
    return out
