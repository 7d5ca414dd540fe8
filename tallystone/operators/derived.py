"""Derived products: financials, ratios, growth, peers, amendment statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.plans import values as V
from tallystone.runtime import maybe_broadcast

PERIOD = ["cik", "fiscal_year", "fiscal_period"]


def sectors(entities: DataFrame) -> DataFrame:
    """cik, sector: Unknown without a code or for a code that isn't listed."""
    m = F.create_map(*[F.lit(x) for kv in V.SECTORS.items() for x in kv])
    one = entities.groupBy("cik").agg(F.max_by("sic_code", "mapping_id").alias("sic"))
    return one.select("cik", F.coalesce(F.try_element_at(m, F.col("sic")), F.lit("Unknown")).alias("sector"))


def with_sector(df: DataFrame, entities: DataFrame) -> DataFrame:
    return df.join(maybe_broadcast(sectors(entities)), "cik", "left").withColumn("sector", F.coalesce("sector", F.lit("Unknown")))


def with_reporting(df: DataFrame, by: list[str], who: str = "cik") -> DataFrame:
    """companies_reporting: distinct companies for each `by`, joined back (Spark has no distinct count over a window)."""
    n = df.groupBy(*by).agg(F.countDistinct(who).alias("companies_reporting"))
    return df.drop("companies_reporting").join(maybe_broadcast(n), by)


def financials(conformed: DataFrame, entities: DataFrame) -> DataFrame:
    f = with_reporting(with_sector(conformed, entities), ["business_term_id", "fiscal_period"])
    return f.withColumnsRenamed({"end_date": "period_end_date", "concept": "source_concept"}).withColumn("record_id", X.grain_hash("cik", "business_term_id", "fiscal_year", "fiscal_period"))


def latest_rows(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in order."""
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def ratios(fin: DataFrame, definitions: list[tuple] = V.RATIOS) -> DataFrame:
    """Numerator over denominator by definition, for periods that have both. One aggregate pivots the terms in use, so the
    table is read and shuffled once however many definitions there are. A denominator of 0 gives none; where the
    numerator's size is meant, neither does a negative one."""
    used = sorted({t for _, _, a, b, _ in definitions for t in (a, b)})
    wide = fin.where(F.col("business_term_id").isin(used)).groupBy(*PERIOD).agg(*[F.max(F.when(F.col("business_term_id") == t, F.col("val"))).alias(f"_{t}") for t in used])
    cells = []
    for rid, name, a, b, size in definitions:
        num, den = F.col(f"`_{a}`"), F.col(f"`_{b}`")
        ok = num.isNotNull() & den.isNotNull() & (den != 0) & ((den > 0) if size else F.lit(True))
        cells.append(F.when(ok, F.struct(F.lit(rid).alias("ratio_id"), F.lit(name).alias("ratio_name"), F.try_divide(F.abs(num) if size else num, den).alias("ratio_value"), F.lit(a).alias("numerator_bt_id"), num.alias("numerator_val"), F.lit(b).alias("denominator_bt_id"), den.alias("denominator_val"))))
    out = wide.select(*PERIOD, F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("r")).select(*PERIOD, "r.*")
    return out.withColumn("record_id", X.grain_hash("cik", "ratio_id", "fiscal_year", "fiscal_period"))


def growth(fin: DataFrame, key: list[str] | None = None, year: str = "fiscal_year", value: str = "val") -> DataFrame:
    """yoy_change, yoy_pct_change and cagr_5yr against the value exactly one or five years before (never the previous row).
    One window serves all three."""
    key = key or ["cik", "business_term_id", "fiscal_period"]
    w = W.partitionBy(*key).orderBy(year)
    g = fin.withColumns({"_1": F.first(value).over(w.rangeBetween(-1, -1)), "_5": F.first(value).over(w.rangeBetween(-5, -5))})
    now, one, five = F.col(value), F.col("_1"), F.col("_5")

    def cell(kind: str, ok: Column, growth_value: Column, prior: Column, base: Column, base_year: Column) -> Column:
        return F.when(ok, F.struct(F.lit(kind).alias("growth_type"), growth_value.alias("growth_value"), prior.alias("prior_val"), base.alias("base_val"), base_year.alias("base_year")))

    none = F.lit(None).cast("double")
    cells = [
        cell("yoy_change", one.isNotNull() & now.isNotNull(), now - one, one, none, F.lit(None).cast("int")),
        cell("yoy_pct_change", (one != 0) & now.isNotNull(), X.pct_of_abs(now, one), one, none, F.lit(None).cast("int")),
        cell("cagr_5yr", (five > 0) & now.isNotNull(), X.cagr(F.try_divide(now, five), 5), none, five, (F.col(year) - 5).cast("int")),
    ]
    return g.select(*key, year, now.alias("current_val"), F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("g")).select(*key, year, "current_val", "g.*")


def peers(metrics: DataFrame, group: list[str], who: str = "cik", value: str = "val", least: int = 2) -> DataFrame:
    """Rank (dense, descending), mean, interpolated median, percentile (n - rank) / (n - 1) and number of peers in each
    group of at least `least`. One row a company: the greatest where there are several."""
    one = metrics.where(F.col(value).isNotNull()).groupBy(*group, who).agg(F.max(value).alias(value))
    stats = one.groupBy(*group).agg(F.count(F.lit(1)).alias("peer_count"), F.avg(value).alias("sector_avg"), F.percentile(value, 0.5).alias("sector_median")).where(F.col("peer_count") >= least)
    w = W.partitionBy(*group).orderBy(F.col(value).desc())
    ranked = one.withColumn("sector_rank", F.dense_rank().over(w).cast("long"))
    out = ranked.join(stats, group)
    return out.withColumn("sector_percentile", (F.col("peer_count") - F.col("sector_rank")) / (F.col("peer_count") - 1))


def amendment_stats(pairs: DataFrame) -> DataFrame:
    """Per company and calendar year of the period's end: counts, sizes of changes, days to amend, and the concept of the
    largest change (ties: the least name)."""
    size, pct = F.abs("val_change"), F.abs("val_change_pct")
    days = F.datediff("amendment_filed_date", "original_filed_date")
    top = F.min_by("concept", F.struct(-F.coalesce(size, F.lit(0.0)), F.col("concept")))
    return pairs.groupBy("cik", F.year("end_date").alias("fiscal_year")).agg(
        F.count(F.lit(1)).alias("amendment_count"), F.countDistinct("concept").alias("distinct_concepts"), F.countDistinct("amendment_accession").alias("distinct_filings"),
        F.coalesce(F.avg(size), F.lit(0.0)).alias("mean_abs_change"), F.coalesce(F.percentile(size, 0.5), F.lit(0.0)).alias("median_abs_change"), F.coalesce(F.max(size), F.lit(0.0)).alias("max_abs_change"), F.coalesce(F.sum(size), F.lit(0.0)).alias("total_val_impact"),
        F.avg(pct).alias("mean_abs_pct"), F.percentile(pct, 0.5).alias("median_abs_pct"), F.coalesce(F.avg(days), F.lit(-1.0)).alias("avg_days_to_amend"), F.coalesce(F.percentile(days, 0.5), F.lit(-1.0)).alias("median_days_to_amend"), F.coalesce(top, F.lit("")).alias("most_changed_concept"),
    )


def group_stats(df: DataFrame, by: list[str], value: str, label: str) -> DataFrame:
    """Mean, upper median, leader, laggard and number for each group; ties go to the least label."""
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.avg(value).alias("mean"), X.median_upper(value).alias("median"), F.min_by(label, F.struct(-F.col(value), F.col(label))).alias("leader"), F.min_by(label, F.struct(F.col(value), F.col(label))).alias("laggard"), F.count(F.lit(1)).alias("n"))
