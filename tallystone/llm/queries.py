"""Queries of the problems 4, 7, 8 and 9, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallystone.llm import abuse, leaks, mixture, survivors
from tallystone.runtime import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.found(table(spark, d, "financial_facts"))


def p4_golden(spark: SparkSession, d: str) -> DataFrame:
    return survivors.golden(table(spark, d, "financial_facts"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return leaks.report(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_selection(spark: SparkSession, d: str) -> DataFrame:
    return mixture.Mixture(table(spark, d, "documents"), table(spark, d, "source_targets")).selection()


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.Mixture(table(spark, d, "documents"), table(spark, d, "source_targets")).shares()


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return abuse.found(table(spark, d, "documents"), table(spark, d, "content_labels"))


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.scores(table(spark, d, "documents"), table(spark, d, "content_labels"))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(table(spark, d, "documents"), table(spark, d, "content_labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p4_found, p4_golden, p7_found, p7_report, p8_selection, p8_shares, p9_found, p9_scores, p9_rates)}


def _spelling(c: str) -> str:
    return f"upper(regexp_replace(regexp_replace({c}, '^[^:]*:', ''), '\\s+', '', 'g'))"


def _has(c: str) -> str:
    return f"{c} IS NOT NULL AND lower(trim({c}, ' \t\n\r')) NOT IN ('', 'n/a', '-', 'unknown')"


_GROUP = "cik, start_date, end_date, c, u"
_RANKED = f"""f AS (SELECT *, {_spelling("concept")} AS c, {_spelling("unit")} AS u FROM financial_facts),
r AS (SELECT *, row_number() OVER (PARTITION BY {_GROUP} ORDER BY coalesce(is_superseded, false), filed_date DESC NULLS LAST, accession_number DESC NULLS LAST, fact_id DESC NULLS LAST, promoted_at DESC NULLS LAST) AS k, count(*) OVER (PARTITION BY {_GROUP}) AS n FROM f),
g AS (SELECT {_GROUP}, max(CASE WHEN k = 1 THEN fact_id END) AS s, arg_min(fact_id, k) FILTER (val IS NOT NULL) AS d1, arg_min(fact_id, k) FILTER ({_has("business_term_id")}) AS d2, arg_min(fact_id, k) FILTER ({_has("ticker")}) AS d3, arg_min(fact_id, k) FILTER ({_has("fiscal_year_end")}) AS d4,
arg_min(val, k) FILTER (val IS NOT NULL) AS v1, arg_min(business_term_id, k) FILTER ({_has("business_term_id")}) AS v2, arg_min(ticker, k) FILTER ({_has("ticker")}) AS v3, arg_min(fiscal_year_end, k) FILTER ({_has("fiscal_year_end")}) AS v4 FROM r WHERE n >= 2 GROUP BY ALL)"""

SQL: dict[str, str] = {
    "p4_found": f"WITH {_RANKED}, p AS (" + " UNION ALL ".join(f"SELECT s AS survivor_id, '{f}' AS field_name, d{i} AS donor_id FROM g" for i, f in enumerate(("val", "business_term_id", "ticker", "fiscal_year_end"), 1)) + ") SELECT * FROM p WHERE donor_id IS NOT NULL",
    "p4_golden": f"WITH {_RANKED} SELECT cik, start_date, end_date, c AS concept, u AS unit, s AS survivor_id, v1 AS val, v2 AS business_term_id, v3 AS ticker, v4 AS fiscal_year_end FROM g",
}
