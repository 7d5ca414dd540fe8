"""The whole rulebook over the test tables and the tables derived from them, with its DuckDB SQL.

Tables that the test data has are read; the others (calendar, amendments, concept mappings, conformed facts, growth, peers,
amendment analysis, audits) are built by this engine's operators and written once, and on the other side by SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.operators import derived, entities, facts, rules
from tallystone.plans import catalog as C
from tallystone.plans import values as V
from tallystone.plans.rulebook import rulebook
from tallystone.runtime import stage, table

#: The clock of the rules that ask for it.
DAY = "2026-05-01"
GIVEN = ["xbrl_company_facts", "financial_facts", "entity_mappings", "company_financials", "financial_ratios"]
DERIVED = ["entity_resolution_audit", "concept_mappings", "tag_normalization_audit", "fiscal_calendar", "amendment_tracking", "conformed_facts", "period_over_period", "peer_comparison", "amendment_analysis"]


def tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All tables of the rulebook by their last name; the derived ones lazy."""
    t = {n: table(spark, d, n) for n in GIVEN}
    day = F.lit(DAY).cast("date").alias("load_date")
    concepts = entities.normalize(t["xbrl_company_facts"]).withColumn("status", F.when(F.col("business_term_id").isNotNull(), "approved").otherwise("unmapped"))
    pairs = facts.amendments(t["financial_facts"], order=C.ORDER)
    fin = C._fin(spark, d)
    period = ["cik", "fiscal_year", "fiscal_period"]
    figures = fin.select(*period, "sector", F.col("business_term_id").alias("metric_id"), F.col("val").alias("metric_value"), F.lit("company_financials").alias("metric_source"))
    who = fin.groupBy("cik").agg(F.max("sector").alias("sector"))
    quotients = derived.ratios(fin).join(who, "cik").select(*period, "sector", F.col("ratio_id").alias("metric_id"), F.col("ratio_value").alias("metric_value"), F.lit("financial_ratios").alias("metric_source"))
    group = ["sector", "metric_id", "fiscal_year", "fiscal_period", "metric_source"]
    growth = derived.with_reporting(derived.growth(fin).withColumnRenamed("base_year", "base_fiscal_year"), ["growth_type", "business_term_id", "fiscal_period"])
    return t | {
        "entity_resolution_audit": entities.audit(t["entity_mappings"], "mapping_id", "promoted", "tallystone", f"{DAY} 00:00:00"),
        "concept_mappings": concepts.select("*", day),
        "tag_normalization_audit": entities.audit(concepts, "concept", "promoted", "tallystone", f"{DAY} 00:00:00"),
        "fiscal_calendar": facts.fiscal_calendar(t["financial_facts"]).select("*", day),
        "amendment_tracking": pairs.select("*", day),
        "conformed_facts": facts.conform(t["financial_facts"]),
        "period_over_period": growth.withColumn("record_id", X.grain_hash("cik", "business_term_id", "fiscal_year", "fiscal_period", "growth_type")),
        "peer_comparison": derived.peers(figures.unionByName(quotients), group, value="metric_value").withColumn("record_id", X.grain_hash("cik", "metric_id", "fiscal_year", "fiscal_period", "metric_source")),
        "amendment_analysis": derived.amendment_stats(pairs).withColumn("record_id", X.grain_hash("cik", "fiscal_year")),
    }


def _bound() -> list[rules.Rule]:
    """The rules with tables by their last name and a fixed clock."""
    out = []
    for r in rulebook():
        sql = r.sql
        for zone in ("raw", "base", "consumable"):
            for n in GIVEN + DERIVED:
                sql = sql.replace(f"{zone}.{n}", n)
        sql = sql.replace("CURRENT_DATE", f"DATE '{DAY}'").replace("CURRENT_TIMESTAMP", f"TIMESTAMP '{DAY} 00:00:00'")
        out.append(replace(r, sql=sql))
    return out


def dq_rulebook(spark: SparkSession, d: str) -> DataFrame:
    """The raw value of every rule of the rulebook, each table read in one pass for all rules over its rows."""
    every = _bound()
    t = tables(spark, d)
    for n in GIVEN:
        t[n].createOrReplaceTempView(n)
    for n in DERIVED:
        stage(t[n], n).createOrReplaceTempView(n)
    return rules.raw_values(spark, every)


def _hash(*cols: str) -> str:
    return "substr(sha256(concat_ws('|', " + ", ".join(f"coalesce({c}::VARCHAR, '')" for c in cols) + ")), 1, 16)"


def _tier() -> str:
    exact = ", ".join(f"'{r[0]}'" for r in V.EXACT)
    return f"CASE WHEN concept IN ({exact}) THEN 1 WHEN business_term_id IS NOT NULL OR " + " OR ".join(f"starts_with(concept, '{r[0]}')" for r in V.PREFIXES) + " THEN 2 ELSE 3 END"


_GROW = " UNION ALL ".join(
    f"SELECT a.cik, a.business_term_id, a.fiscal_period, a.fiscal_year, '{kind}' AS growth_type, {value} AS growth_value, {prior} AS prior_val, {base} AS base_val, {year} AS base_fiscal_year FROM fin a JOIN fin b USING (cik, business_term_id, fiscal_period) WHERE b.fiscal_year = a.fiscal_year - {back} AND a.val IS NOT NULL AND {ok}"
    for kind, value, prior, base, year, back, ok in (
        ("yoy_change", "a.val - b.val", "b.val", "NULL", "NULL", 1, "b.val IS NOT NULL"),
        ("yoy_pct_change", "(a.val - b.val) / abs(b.val)", "b.val", "NULL", "NULL", 1, "b.val <> 0"),
        ("cagr_5yr", "CASE WHEN a.val / b.val <= 0 THEN -pow(abs(a.val / b.val), 0.2) - 1 ELSE pow(a.val / b.val, 0.2) - 1 END", "NULL", "b.val", "a.fiscal_year - 5", 5, "b.val > 0"),
    )
)
_CONFORM = C.SQL["conform_winner"].partition("SELECT cik, business_term_id, fiscal_year, fiscal_period, fact_id, n AS")
_PEER = "PARTITION BY sector, metric_id, fiscal_year, fiscal_period, metric_source"

_PEER_CTES = ",\n".join(
    [
        "figures AS (SELECT cik, fiscal_year, fiscal_period, sector, business_term_id AS metric_id, val AS metric_value, 'company_financials' AS metric_source FROM fin UNION ALL SELECT r.cik, fiscal_year, fiscal_period, w.sector, ratio_id, ratio_value, 'financial_ratios' FROM r JOIN (SELECT cik, max(sector) AS sector FROM fin GROUP BY cik) w USING (cik))",
        "one AS (SELECT sector, metric_id, fiscal_year, fiscal_period, metric_source, cik, max(metric_value) AS metric_value FROM figures WHERE metric_value IS NOT NULL GROUP BY ALL)",
        f"peer_comparison AS MATERIALIZED (SELECT *, (peer_count - sector_rank) / (peer_count - 1) AS sector_percentile, {_hash('cik', 'metric_id', 'fiscal_year', 'fiscal_period', 'metric_source')} AS record_id FROM (SELECT *, count(*) OVER p AS peer_count, dense_rank() OVER ({_PEER} ORDER BY metric_value DESC) AS sector_rank, avg(metric_value) OVER p AS sector_avg, median(metric_value) OVER p AS sector_median FROM one WINDOW p AS ({_PEER})) WHERE peer_count >= 2)",
    ]
)


def _sql() -> str:
    ctes = [
        C._FIN,
        C._PAIRS,
        C._RATIO,
        f"entity_resolution_audit AS (SELECT mapping_id, DATE '{DAY}' AS load_date FROM entity_mappings)",
        f"concept_mappings AS (SELECT *, CASE WHEN business_term_id IS NOT NULL THEN 'approved' ELSE 'unmapped' END AS status, {_tier()} AS tier, 0.5 AS confidence, DATE '{DAY}' AS load_date FROM ({C._classify_sql()}))",
        "tag_normalization_audit AS (SELECT concept, load_date FROM concept_mappings)",
        f"fiscal_calendar AS (SELECT *, DATE '{DAY}' AS load_date FROM ({C.SQL['fiscal_calendar']}))",
        f"amendment_tracking AS (SELECT *, DATE '{DAY}' AS load_date FROM pairs)",
        f"conformed_facts AS MATERIALIZED ({_CONFORM[0]} SELECT *, n AS competing_fact_count, CASE WHEN n = 1 THEN 'sole_candidate' WHEN place IS NOT NULL THEN 'primary_concept' ELSE 'tier_frequency_fallback' END AS selection_reason, {_hash('cik', 'business_term_id', 'fiscal_year', 'fiscal_period')} AS conformed_id FROM r WHERE k = 1)",
        f"grow AS (SELECT *, {_hash('cik', 'business_term_id', 'fiscal_year', 'fiscal_period', 'growth_type')} AS record_id FROM ({_GROW}))",
        "period_over_period AS MATERIALIZED (SELECT grow.*, companies_reporting FROM grow JOIN (SELECT growth_type, business_term_id, fiscal_period, count(DISTINCT cik) AS companies_reporting FROM grow GROUP BY ALL) USING (growth_type, business_term_id, fiscal_period))",
        _PEER_CTES,
        f"amendment_analysis AS MATERIALIZED (SELECT cik, year(end_date) AS fiscal_year, count(*) AS amendment_count, count(DISTINCT concept) AS distinct_concepts, coalesce(avg(abs(val_change)), 0) AS mean_abs_change, coalesce(median(abs(val_change)), 0) AS median_abs_change, coalesce(max(abs(val_change)), 0) AS max_abs_change, coalesce(sum(abs(val_change)), 0) AS total_val_impact, {_hash('cik', 'year(end_date)')} AS record_id FROM pairs GROUP BY cik, year(end_date))",
    ]
    cells = []
    for r in _bound():
        sql = r.sql.replace(" RLIKE ", " SIMILAR TO ").replace("double('infinity')", "'infinity'::DOUBLE").replace(f"TIMESTAMP '{DAY} 00:00:00'", f"TIMESTAMPTZ '{DAY} 00:00:00+00'")
        if r.threshold.startswith("result_count"):
            sql = f"SELECT COUNT(*) AS v FROM ({sql}) q"
        cells.append(f"SELECT '{r.rule_id}' AS rule_id, CAST(({sql}) AS DOUBLE) AS raw_value")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(cells)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"dq_rulebook": dq_rulebook}
SQL: dict[str, str] = {"dq_rulebook": _sql()}
