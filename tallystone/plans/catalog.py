"""Queries of the reference's operators over the whole test tables, each with its DuckDB SQL.

Orders are total, so ties are decided alike in both engines; floats are rounded to a fixed scale on both sides; ranks and
counts are cast to long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.functions import formats
from tallystone.operators import bitemporal, derived, entities, facts, rules
from tallystone.plans import values as V
from tallystone.plans.rulebook import rulebook
from tallystone.runtime import table
from tallystone.sources import filings
from tallystone.sources.store import new_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ORDER = ["filed_date", "accession_number", "fact_id", "promoted_at"]
_G = "cik, concept, unit, start_date, end_date"
_O = "filed_date NULLS FIRST, accession_number NULLS FIRST, fact_id NULLS FIRST, promoted_at NULLS FIRST"
_ALL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "financial_facts")


def _fin(spark: SparkSession, d: str) -> DataFrame:
    """company_financials by canonical term, one row a grain: the last loaded."""
    f = table(spark, d, "company_financials").withColumn("business_term_id", facts.canonical_term(F.upper(F.trim("business_term_id")))).where(F.length("business_term_id") > 0)
    order = [F.col("load_date").desc_nulls_last(), F.col("filed_date").desc_nulls_last(), F.col("record_id").desc_nulls_last(), F.col("val").desc_nulls_last()]
    return derived.latest_rows(f, ["cik", "business_term_id", "fiscal_year", "fiscal_period"], order)


_LEGACY = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in V.LEGACY.items())
_FIN = f"""fin AS (SELECT * FROM (SELECT * REPLACE (CASE upper(trim(business_term_id)) {_LEGACY} ELSE upper(trim(business_term_id)) END AS business_term_id) FROM company_financials WHERE length(trim(business_term_id)) > 0)
QUALIFY row_number() OVER (PARTITION BY cik, business_term_id, fiscal_year, fiscal_period ORDER BY load_date DESC NULLS LAST, filed_date DESC NULLS LAST, record_id DESC NULLS LAST, val DESC NULLS LAST) = 1)"""


# supersession, amendments, bitemporal

_SUP = f"""s AS (SELECT *, row_number() OVER w < count(*) OVER g AS now_superseded, CASE WHEN row_number() OVER w < count(*) OVER g THEN last_value(accession_number) OVER wa END AS by_accession
FROM financial_facts WINDOW w AS (PARTITION BY {_G} ORDER BY {_O}), wa AS (PARTITION BY {_G} ORDER BY {_O} {_ALL}), g AS (PARTITION BY {_G}))"""


@query(f"WITH {_SUP} SELECT fact_id, accession_number, filed_date, now_superseded AS is_superseded, by_accession AS superseded_by FROM s")
def supersede_latest(spark, d):
    return facts.supersede(_facts(spark, d), order=ORDER).select("fact_id", "accession_number", "filed_date", "is_superseded", "superseded_by")


@query(f"SELECT fact_id, cik, concept, unit, end_date, filed_date FROM financial_facts WHERE filed_date <= DATE '2021-06-30' QUALIFY row_number() OVER (PARTITION BY {_G} ORDER BY filed_date DESC NULLS LAST, accession_number DESC NULLS LAST, fact_id DESC NULLS LAST, promoted_at DESC NULLS LAST) = 1")
def as_known_on(spark, d):
    return bitemporal.as_known_on(_facts(spark, d), "2021-06-30", order=tuple(ORDER)).select("fact_id", "cik", "concept", "unit", "end_date", "filed_date")


@query("SELECT fact_id, cik, concept, business_term_id FROM financial_facts WHERE NOT coalesce(is_superseded, false)")
def current_facts(spark, d):
    return bitemporal.current(_facts(spark, d)).select("fact_id", "cik", "concept", "business_term_id")


@query(f"SELECT fact_id, filed_date, row_number() OVER (PARTITION BY {_G} ORDER BY {_O}) AS version_no, count(*) OVER (PARTITION BY {_G}) AS versions FROM financial_facts")
def fact_versions(spark, d):
    p = W.partitionBy(*facts.GRAIN)
    w = p.orderBy(*[F.col(c).asc_nulls_first() for c in ORDER])
    return _facts(spark, d).select("fact_id", "filed_date", F.row_number().over(w).cast("long").alias("version_no"), F.count(F.lit(1)).over(p).alias("versions"))


@query("""WITH g AS (SELECT cik, concept, unit, start_date, end_date, count(*) AS n FROM financial_facts WHERE cik IS NOT NULL AND concept IS NOT NULL AND unit IS NOT NULL AND end_date IS NOT NULL GROUP BY ALL ORDER BY n DESC, cik, concept, unit, end_date, start_date NULLS FIRST LIMIT 1)
SELECT fact_id, filed_date, val FROM financial_facts f JOIN g ON f.cik = g.cik AND f.concept = g.concept AND f.unit = g.unit AND f.end_date = g.end_date AND f.start_date IS NOT DISTINCT FROM g.start_date""")
def fact_history(spark, d):
    """Every version of the figure that was stated most often."""
    f = _facts(spark, d)
    g = f.where("cik is not null and concept is not null and unit is not null and end_date is not null").groupBy(*facts.GRAIN).agg(F.count(F.lit(1)).alias("n"))
    top = g.orderBy(F.col("n").desc(), "cik", "concept", "unit", "end_date", F.col("start_date").asc_nulls_first()).first()  # one row
    if top is None:
        return f.limit(0).select("fact_id", "filed_date", "val")
    return bitemporal.history(f, top["cik"], top["concept"], top["start_date"] and str(top["start_date"]), str(top["end_date"]), top["unit"]).select("fact_id", "filed_date", "val")


_PAIRS = f"""p AS (SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY {_G}) AS all_n, last_value(val) OVER wa AS l_val, last_value(accession_number) OVER wa AS l_acc, last_value(filed_date) OVER wa AS l_filed
FROM financial_facts WINDOW w AS (PARTITION BY {_G} ORDER BY {_O}), wa AS (PARTITION BY {_G} ORDER BY {_O} {_ALL})),
pairs AS (SELECT {_G}, accession_number AS original_accession, filed_date AS original_filed_date, val AS original_val, l_acc AS amendment_accession, l_filed AS amendment_filed_date, l_val AS amendment_val, l_val - val AS val_change, CASE WHEN val <> 0 THEN (l_val - val) / abs(val) * 100 END AS val_change_pct FROM p WHERE n < all_n)"""


@query(f"WITH {_PAIRS} SELECT cik, concept, unit, end_date, original_accession, amendment_accession, original_val, amendment_val, round(val_change, 4) AS val_change, round(val_change_pct, 4) AS val_change_pct FROM pairs")
def amendment_pairs(spark, d):
    a = facts.amendments(_facts(spark, d), order=ORDER)
    return a.select("cik", "concept", "unit", "end_date", "original_accession", "amendment_accession", "original_val", "amendment_val", F.round("val_change", 4).alias("val_change"), F.round("val_change_pct", 4).alias("val_change_pct"))


@query(f"""WITH {_PAIRS}, c AS (SELECT *, year(end_date) AS fiscal_year, abs(val_change) AS size, abs(val_change_pct) AS pct, amendment_filed_date - original_filed_date AS days FROM pairs)
SELECT cik, fiscal_year, count(*) AS amendment_count, count(DISTINCT concept) AS distinct_concepts, count(DISTINCT amendment_accession) AS distinct_filings, round(coalesce(avg(size), 0), 5) AS mean_abs_change, round(coalesce(median(size), 0), 5) AS median_abs_change,
round(coalesce(max(size), 0), 5) AS max_abs_change, round(avg(pct), 4) AS mean_abs_pct, round(median(pct), 4) AS median_abs_pct, round(coalesce(avg(days), -1), 4) AS avg_days_to_amend, round(coalesce(median(days), -1), 4) AS median_days_to_amend, coalesce(arg_min(concept, (-coalesce(size, 0), concept)), '') AS most_changed_concept FROM c GROUP BY cik, fiscal_year""")
def amendment_stats(spark, d):
    s = derived.amendment_stats(facts.amendments(_facts(spark, d), order=ORDER))
    return s.select("cik", F.col("fiscal_year").cast("long").alias("fiscal_year"), "amendment_count", "distinct_concepts", "distinct_filings", *[F.round(c, 5).alias(c) for c in ("mean_abs_change", "median_abs_change", "max_abs_change")], *[F.round(c, 4).alias(c) for c in ("mean_abs_pct", "median_abs_pct", "avg_days_to_amend", "median_days_to_amend")], "most_changed_concept")


@query("""WITH c AS (SELECT cik, concept, max(CASE WHEN end_date = DATE '2021-12-31' THEN val END) AS period1_val, max(CASE WHEN end_date = DATE '2022-12-31' THEN val END) AS period2_val FROM financial_facts
WHERE NOT coalesce(is_superseded, false) AND unit = 'USD' AND end_date IN (DATE '2021-12-31', DATE '2022-12-31') GROUP BY cik, concept)
SELECT cik, concept, period1_val, period2_val, period2_val - period1_val AS change, round(CASE WHEN period1_val <> 0 THEN (period2_val - period1_val) / period1_val * 100 END, 1) + 0.0 AS pct_change FROM c WHERE period1_val IS NOT NULL AND period2_val IS NOT NULL""")
def compare_periods(spark, d):
    c = bitemporal.compare(_facts(spark, d), "2021-12-31", "2022-12-31")
    return c.select("cik", "concept", "period1_val", "period2_val", "change", F.round(F.try_divide("change", "period1_val") * 100, 1).alias("pct_change"))


@query("""WITH f AS (SELECT accession_number, max(filed_date) AS by_filed FROM financial_facts WHERE accession_number IS NOT NULL GROUP BY 1), j AS (SELECT t.*, f.by_filed FROM financial_facts t LEFT JOIN f ON t.superseded_by = f.accession_number)
SELECT 'future_filed' AS "check", count(*) FILTER (filed_date > DATE '2026-01-01') AS violations FROM j UNION ALL SELECT 'start_not_before_end', count(*) FILTER (start_date >= end_date) FROM j
UNION ALL SELECT 'superseded_later', count(*) FILTER (coalesce(is_superseded, false) AND filed_date > by_filed) FROM j UNION ALL SELECT 'filed_before_end', count(*) FILTER (filed_date < end_date) FROM j UNION ALL SELECT 'unknown_successor', count(*) FILTER (superseded_by IS NOT NULL AND by_filed IS NULL) FROM j""")
def temporal_validation(spark, d):
    return bitemporal.validate(_facts(spark, d), "2026-01-01").select("check", "violations")


# fiscal derivations

@query("""SELECT fact_id, year(end_date) + CASE WHEN try_cast(substr(fiscal_year_end, 1, 2) AS INT) <> 12 AND month(end_date) > try_cast(substr(fiscal_year_end, 1, 2) AS INT) THEN 1 ELSE 0 END AS derived_year,
CASE WHEN end_date - start_date >= 350 THEN 'FY' ELSE coalesce(nullif(fiscal_period, ''), 'FY') END AS derived_period, quarter(end_date) AS derived_quarter, coalesce(form LIKE '%/A', false) AS amendment,
substr(sha256(concat_ws('|', coalesce(cik::VARCHAR, ''), coalesce(concept, ''), coalesce(unit, ''), coalesce(start_date::VARCHAR, ''), coalesce(end_date::VARCHAR, ''), coalesce(accession_number, ''))), 1, 16) AS grain_id FROM financial_facts""")
def fiscal_derivations(spark, d):
    f = _facts(spark, d)
    return f.select("fact_id", X.fiscal_year(F.col("end_date"), F.col("fiscal_year_end")).cast("long").alias("derived_year"), X.fiscal_period(F.col("start_date"), F.col("end_date"), F.col("fiscal_period")).alias("derived_period"), F.quarter("end_date").cast("long").alias("derived_quarter"), X.is_amendment(F.col("form")).alias("amendment"), X.grain_hash("cik", "concept", "unit", "start_date", "end_date", "accession_number").alias("grain_id"))


@query("SELECT cik, fiscal_year, fiscal_period, min(start_date) AS period_start, max(end_date) AS period_end, max(end_date) - min(start_date) AS duration_days, fiscal_period = 'FY' AS is_annual FROM financial_facts GROUP BY cik, fiscal_year, fiscal_period")
def fiscal_calendar(spark, d):
    c = facts.fiscal_calendar(_facts(spark, d))
    return c.select("cik", "fiscal_year", "fiscal_period", "period_start", "period_end", F.col("duration_days").cast("long").alias("duration_days"), "is_annual")


_T = "try_cast(substr(fiscal_year_end, 1, 2) AS INT)"


@query(f"""WITH {_SUP}, t AS (SELECT *, (NOT now_superseded AND fiscal_period = 'FY' AND start_date IS NOT NULL AND {_T} IS NOT NULL) AS ttm, coalesce(month(end_date) = {_T}, false) AS hit FROM s),
r AS (SELECT *, min(start_date) OVER p <> max(start_date) OVER p AS several, row_number() OVER (PARTITION BY cik, concept, unit, fiscal_year, ttm ORDER BY hit DESC, CASE WHEN NOT hit THEN end_date END DESC NULLS LAST, filed_date NULLS FIRST, accession_number NULLS FIRST, fact_id NULLS FIRST) AS k FROM t WINDOW p AS (PARTITION BY cik, concept, unit, fiscal_year, ttm))
SELECT fact_id, now_superseded OR (ttm AND several AND k > 1) AS is_superseded FROM r""")
def ttm_preference(spark, d):
    return facts.prefer_fiscal_year(facts.supersede(_facts(spark, d), order=ORDER)).select("fact_id", "is_superseded")


# conformation

_PRIO = ", ".join(f"('{t}', '{u}', '{c}', {i})" for t, (u, cs) in V.PRIORITIES.items() for i, c in enumerate(cs))


@query(f"""WITH v(t, u, c, i) AS (VALUES {_PRIO}), units AS (SELECT DISTINCT t, u FROM v),
f AS (SELECT * REPLACE (CASE business_term_id {_LEGACY} ELSE business_term_id END AS business_term_id) FROM financial_facts WHERE NOT coalesce(is_superseded, false) AND business_term_id IS NOT NULL AND fiscal_year IS NOT NULL),
g AS (SELECT f.*, v.i AS place FROM f JOIN units ON f.business_term_id = units.t AND f.unit = units.u LEFT JOIN v ON v.t = f.business_term_id AND v.c = f.concept),
h AS (SELECT *, count(*) OVER (PARTITION BY concept) AS freq FROM g),
r AS (SELECT *, count(*) OVER p AS n, row_number() OVER (PARTITION BY cik, business_term_id, fiscal_year, fiscal_period ORDER BY place NULLS LAST, CASE WHEN place IS NULL THEN coalesce(tier, 3) END NULLS FIRST, CASE WHEN place IS NULL THEN -freq END NULLS FIRST, filed_date NULLS FIRST, accession_number NULLS FIRST, fact_id NULLS FIRST, val NULLS FIRST, promoted_at NULLS FIRST) AS k FROM h WINDOW p AS (PARTITION BY cik, business_term_id, fiscal_year, fiscal_period))
SELECT cik, business_term_id, fiscal_year, fiscal_period, fact_id, n AS competing_fact_count, CASE WHEN n = 1 THEN 'sole_candidate' WHEN place IS NOT NULL THEN 'primary_concept' ELSE 'tier_frequency_fallback' END AS selection_reason FROM r WHERE k = 1""")
def conform_winner(spark, d):
    return facts.conform(_facts(spark, d)).select("cik", "business_term_id", "fiscal_year", "fiscal_period", "fact_id", "competing_fact_count", "selection_reason")


# entities and concepts

@query("""WITH n AS (SELECT cik, entity_name, count(*) AS n FROM xbrl_company_facts WHERE cik IS NOT NULL GROUP BY 1, 2), m AS (SELECT cik, arg_min(entity_name, (-n, entity_name)) AS raw_entity_name, sum(n)::BIGINT AS n_facts FROM n GROUP BY cik)
SELECT 'ER-' || lpad((row_number() OVER (ORDER BY cik))::VARCHAR, 3, '0') AS mapping_id, cik, raw_entity_name, n_facts FROM m""")
def entity_mode(spark, d):
    return entities.resolve(table(spark, d, "xbrl_company_facts")).select("mapping_id", "cik", "raw_entity_name", "n_facts")


@query("SELECT cik, CASE WHEN count(*) > 0 THEN coalesce(max(CASE sic " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in V.SECTORS.items()) + " END), 'Unknown') END AS sector FROM (SELECT cik, arg_max(sic_code, mapping_id) AS sic FROM entity_mappings GROUP BY cik) GROUP BY cik")
def sector_lookup(spark, d):
    return derived.sectors(table(spark, d, "entity_mappings"))


def _classify_sql() -> str:
    def case(field: int) -> str:
        out = [f"WHEN concept = '{r[0]}' THEN '{r[field]}'" for r in V.EXACT] + [f"WHEN starts_with(concept, '{r[0]}') THEN '{r[field]}'" for r in V.PREFIXES]
        tests = ["contains(lower(concept), 'revenue')", "contains(lower(concept), 'netincome')", "contains(lower(concept), 'operatingincome')", "regexp_matches(lower(concept), 'incometax.*expensebenefit') AND NOT regexp_matches(lower(concept), 'incometax(reconciliation|credits|receivable|deferred)')", "contains(lower(concept), 'capitalexpenditure')"]
        out += [f"WHEN {t} THEN '{r[field]}'" for t, r in zip(tests, V.PATTERNS, strict=True)]
        if field > 1:
            out += [f"WHEN contains(concept, '{r[0]}') THEN '{r[field - 1]}'" for r in V.HEURISTICS]
        rest = {1: "NULL", 2: "'other'", 3: "'uncategorized'"}[field]
        return "CASE " + " ".join(out) + f" ELSE {rest} END"

    return f"SELECT concept, {case(1)} AS business_term_id, {case(2)} AS financial_statement, {case(3)} AS category, count(*) AS fact_count, count(DISTINCT cik) AS company_count FROM xbrl_company_facts WHERE taxonomy = 'us-gaap' GROUP BY concept"


@query(_classify_sql())
def classify_concepts(spark, d):
    return entities.normalize(table(spark, d, "xbrl_company_facts")).select("concept", "business_term_id", "financial_statement", "category", "fact_count", "company_count")


@query(f"WITH c AS ({_classify_sql()}) SELECT count(*) FILTER (business_term_id IS NOT NULL) AS mapped, count(*) AS concepts, round(100.0 * count(*) FILTER (business_term_id IS NOT NULL) / count(*), 1) AS concept_pct, round(100.0 * sum(CASE WHEN business_term_id IS NOT NULL THEN fact_count ELSE 0 END) / sum(fact_count), 1) AS fact_pct FROM c")
def mapping_coverage(spark, d):
    c = entities.coverage(entities.normalize(table(spark, d, "xbrl_company_facts")))
    return c.select((F.col("tier1") + F.col("tier2")).alias("mapped"), (F.col("tier1") + F.col("tier2") + F.col("tier3")).alias("concepts"), F.col("concept_pct").cast("double").alias("concept_pct"), F.col("fact_pct").cast("double").alias("fact_pct"))


@query("SELECT mapping_id, load_date, CASE WHEN confidence < 0.8 THEN 'review' ELSE 'auto' END AS decision FROM entity_mappings")
def review_gate(spark, d):
    return entities.gate(table(spark, d, "entity_mappings"), require_human=False).select("mapping_id", "load_date", "decision")


# derived products

@query(f"WITH {_FIN}, n AS (SELECT business_term_id, fiscal_period, count(DISTINCT cik) AS companies_reporting FROM fin GROUP BY 1, 2) SELECT cik, business_term_id, fiscal_year, fiscal_period, n.companies_reporting FROM fin JOIN n USING (business_term_id, fiscal_period)")
def companies_reporting(spark, d):
    return derived.with_reporting(_fin(spark, d), ["business_term_id", "fiscal_period"]).select("cik", "business_term_id", "fiscal_year", "fiscal_period", "companies_reporting")


_DEFS = ", ".join(f"('{i}', '{n}', '{a}', '{b}', {str(s).lower()})" for i, n, a, b, s in V.RATIOS)
_RATIO = f"r AS (SELECT num.cik, num.fiscal_year, num.fiscal_period, ratio_id, (CASE WHEN size THEN abs(num.val) ELSE num.val END) / den.val AS ratio_value FROM (VALUES {_DEFS}) v(ratio_id, ratio_name, a, b, size) JOIN fin num ON num.business_term_id = v.a JOIN fin den ON den.business_term_id = v.b AND den.cik = num.cik AND den.fiscal_year = num.fiscal_year AND den.fiscal_period = num.fiscal_period WHERE num.val IS NOT NULL AND den.val <> 0 AND (NOT size OR den.val > 0))"


@query(f"WITH {_FIN}, {_RATIO} SELECT cik, fiscal_year, fiscal_period, ratio_id, round(ratio_value, 6) AS ratio_value FROM r")
def ratio_pivot(spark, d):
    return derived.ratios(_fin(spark, d)).select("cik", "fiscal_year", "fiscal_period", "ratio_id", F.round("ratio_value", 6).alias("ratio_value"))


_GROWTH = """g AS (SELECT a.cik, a.business_term_id, a.fiscal_period, a.fiscal_year, 'yoy_change' AS growth_type, a.val - b.val AS growth_value FROM fin a JOIN fin b USING (cik, business_term_id, fiscal_period) WHERE b.fiscal_year = a.fiscal_year - 1 AND a.val IS NOT NULL AND b.val IS NOT NULL
UNION ALL SELECT a.cik, a.business_term_id, a.fiscal_period, a.fiscal_year, 'yoy_pct_change', (a.val - b.val) / abs(b.val) FROM fin a JOIN fin b USING (cik, business_term_id, fiscal_period) WHERE b.fiscal_year = a.fiscal_year - 1 AND a.val IS NOT NULL AND b.val <> 0
UNION ALL SELECT a.cik, a.business_term_id, a.fiscal_period, a.fiscal_year, 'cagr_5yr', CASE WHEN a.val / b.val <= 0 THEN -pow(abs(a.val / b.val), 0.2) - 1 ELSE pow(a.val / b.val, 0.2) - 1 END FROM fin a JOIN fin b USING (cik, business_term_id, fiscal_period) WHERE b.fiscal_year = a.fiscal_year - 5 AND a.val IS NOT NULL AND b.val > 0)"""


@query(f"WITH {_FIN}, {_GROWTH} SELECT cik, business_term_id, fiscal_period, fiscal_year, growth_type, round(growth_value, 4) AS growth_value FROM g")
def growth_yoy_cagr(spark, d):
    return derived.growth(_fin(spark, d)).select("cik", "business_term_id", "fiscal_period", "fiscal_year", "growth_type", F.round("growth_value", 4).alias("growth_value"))


@query(f"""WITH {_FIN}, o AS (SELECT sector, business_term_id, fiscal_year, fiscal_period, cik, max(val) AS val FROM fin WHERE val IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
s AS (SELECT *, count(*) OVER p AS peer_count, dense_rank() OVER (PARTITION BY sector, business_term_id, fiscal_year, fiscal_period ORDER BY val DESC) AS sector_rank, avg(val) OVER p AS a, median(val) OVER p AS m FROM o WINDOW p AS (PARTITION BY sector, business_term_id, fiscal_year, fiscal_period))
SELECT sector, business_term_id, fiscal_year, fiscal_period, cik, sector_rank, peer_count, round(a, 5) AS sector_avg, round(m, 5) AS sector_median, round((peer_count - sector_rank) / (peer_count - 1), 6) AS sector_percentile FROM s WHERE peer_count >= 2""")
def peer_rank(spark, d):
    p = derived.peers(_fin(spark, d), ["sector", "business_term_id", "fiscal_year", "fiscal_period"])
    return p.select("sector", "business_term_id", "fiscal_year", "fiscal_period", "cik", "sector_rank", "peer_count", F.round("sector_avg", 5).alias("sector_avg"), F.round("sector_median", 5).alias("sector_median"), F.round("sector_percentile", 6).alias("sector_percentile"))


@query(f"""WITH {_FIN} SELECT sector, fiscal_year, round(avg(val), 5) AS mean, list_sort(list(val))[(count(val) // 2 + 1)::INT] AS median, arg_min(cik, (-val, cik)) AS leader, arg_min(cik, (val, cik)) AS laggard, count(*) AS n FROM fin WHERE business_term_id = 'BT-022' AND fiscal_period = 'FY' AND val IS NOT NULL GROUP BY sector, fiscal_year""")
def sector_stats(spark, d):
    f = _fin(spark, d).where((F.col("business_term_id") == "BT-022") & (F.col("fiscal_period") == "FY"))
    return derived.group_stats(f, ["sector", "fiscal_year"], "val", "cik").select("sector", "fiscal_year", F.round("mean", 5).alias("mean"), "median", "leader", "laggard", "n")


# serving shapes

@query(f"""WITH {_FIN} SELECT fiscal_year, cik, val, row_number() OVER (PARTITION BY fiscal_year ORDER BY val DESC, cik) AS "rank" FROM fin WHERE business_term_id = 'BT-022' AND fiscal_period = 'FY' AND val IS NOT NULL QUALIFY "rank" <= 10""")
def rank_companies(spark, d):
    """Top ten by revenue of each year: the limit is the feature."""
    w = W.partitionBy("fiscal_year").orderBy(F.col("val").desc(), "cik")
    f = _fin(spark, d).where((F.col("business_term_id") == "BT-022") & (F.col("fiscal_period") == "FY") & F.col("val").isNotNull())
    return f.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 10).select("fiscal_year", "cik", "val", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {_FIN}, y AS (SELECT cik, min(ticker) AS t FROM fin GROUP BY cik ORDER BY cik), two AS (SELECT (SELECT min(cik) FROM fin) AS a, (SELECT max(cik) FROM fin) AS b),
j AS (SELECT x.business_term_id, x.fiscal_year, x.val AS val_a, z.val AS val_b FROM two JOIN fin x ON x.cik = two.a JOIN fin z ON z.cik = two.b AND x.business_term_id = z.business_term_id AND x.fiscal_year = z.fiscal_year AND x.fiscal_period = 'FY' AND z.fiscal_period = 'FY' WHERE x.val IS NOT NULL AND z.val IS NOT NULL)
SELECT business_term_id, fiscal_year, val_a, val_b, val_a - val_b AS delta, round(CASE WHEN val_b <> 0 THEN (val_a - val_b) / abs(val_b) END, 6) AS delta_pct, CASE WHEN val_a > val_b THEN 'a' WHEN val_a < val_b THEN 'b' ELSE 'tie' END AS winner FROM j""")
def compare_two(spark, d):
    """Two companies (the least and the greatest number) side by side for all terms and common years."""
    f = _fin(spark, d)
    ends = f.agg(F.min("cik").alias("a"), F.max("cik").alias("b")).select(F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("a").alias("cik")), F.struct(F.lit("b").alias("side"), F.col("b").alias("cik")))).alias("e")).select("e.*")  # two rows
    fy = f.where(F.col("val").isNotNull() & (F.col("fiscal_period") == "FY")).join(F.broadcast(ends), "cik")
    p = fy.groupBy("business_term_id", "fiscal_year").agg(*[F.max(F.when(F.col("side") == s, F.col("val"))).alias(f"val_{s}") for s in "ab"])
    p = p.where(F.col("val_a").isNotNull() & F.col("val_b").isNotNull())
    return p.select("business_term_id", "fiscal_year", "val_a", "val_b", (F.col("val_a") - F.col("val_b")).alias("delta"), F.round(X.pct_of_abs(F.col("val_a"), F.col("val_b")), 6).alias("delta_pct"), F.when(F.col("val_a") > F.col("val_b"), "a").when(F.col("val_a") < F.col("val_b"), "b").otherwise("tie").alias("winner"))


@query(f"""WITH {_FIN}, {_GROWTH}, t AS (SELECT cik, business_term_id, count(*) AS n, count(*) FILTER (growth_value > 0.01) AS up, count(*) FILTER (growth_value < -0.01) AS down FROM g WHERE growth_type = 'yoy_pct_change' AND fiscal_period = 'FY' GROUP BY 1, 2)
SELECT cik, business_term_id, n, CASE WHEN n < 2 THEN 'insufficient_data' WHEN up > 0 AND down > 0 AND least(up, down) / n > 0.3 THEN 'volatile' WHEN up / n >= 0.7 THEN 'growing' WHEN down / n >= 0.7 THEN 'declining' ELSE 'stable' END AS trend FROM t""")
def trend_label(spark, d):
    g = derived.growth(_fin(spark, d)).where((F.col("growth_type") == "yoy_pct_change") & (F.col("fiscal_period") == "FY"))
    t = g.groupBy("cik", "business_term_id").agg(F.collect_list("growth_value").alias("p"))
    return t.select("cik", "business_term_id", F.size("p").cast("long").alias("n"), X.trend(F.col("p")).alias("trend"))


@query(f"WITH {_FIN}, {_RATIO} SELECT a.cik, a.ratio_id, a.fiscal_period, a.fiscal_year, round(a.ratio_value, 6) AS ratio_value, round(a.ratio_value - b.ratio_value, 6) AS yoy_change FROM r a LEFT JOIN r b ON a.cik = b.cik AND a.ratio_id = b.ratio_id AND a.fiscal_period = b.fiscal_period AND b.fiscal_year = a.fiscal_year - 1")
def ratio_yoy(spark, d):
    w = W.partitionBy("cik", "ratio_id", "fiscal_period").orderBy("fiscal_year").rangeBetween(-1, -1)
    r = derived.ratios(_fin(spark, d))
    return r.select("cik", "ratio_id", "fiscal_period", "fiscal_year", F.round("ratio_value", 6).alias("ratio_value"), F.round(F.col("ratio_value") - F.first("ratio_value").over(w), 6).alias("yoy_change"))


_CUR = "CASE WHEN a >= 1e12 THEN printf('$%.1fT', a / 1e12) WHEN a >= 1e9 THEN printf('$%.1fB', a / 1e9) WHEN a >= 1e6 THEN printf('$%.1fM', a / 1e6) WHEN a >= 1e3 THEN printf('$%.1fK', a / 1e3) ELSE printf('$%.2f', a) END"


@query(f"""WITH v AS (SELECT DISTINCT record_id, val, unit, abs(val) AS a FROM company_financials WHERE isfinite(val))
SELECT record_id, CASE WHEN unit = 'USD/shares' THEN CASE WHEN val < 0 THEN '(' || printf('$%.2f', a) || ')' ELSE printf('$%.2f', a) END WHEN val < 0 THEN '(' || {_CUR} || ')' ELSE {_CUR} END AS formatted FROM v WHERE unit IN ('USD', 'USD/shares')""")
def format_values(spark, d):
    v = table(spark, d, "company_financials").where(F.col("unit").isin("USD", "USD/shares") & ~F.isnan("val") & (F.abs("val") < float("inf"))).select("record_id", "val", "unit").distinct()
    return v.select("record_id", formats.value(F.col("val"), F.col("unit")).alias("formatted"))


@query("""SELECT DISTINCT a.cik AS cik_a, b.cik AS cik_b, CASE WHEN k > 182 THEN 365 - k ELSE k END AS days FROM (SELECT a.cik AS ca, b.cik AS cb, abs(make_date(2024, substr(a.fye, 1, 2)::INT, least(substr(a.fye, 3, 2)::INT, 28)) - make_date(2024, substr(b.fye, 1, 2)::INT, least(substr(b.fye, 3, 2)::INT, 28))) AS k FROM (SELECT cik, max(fiscal_year_end) AS fye, row_number() OVER (ORDER BY cik) AS n FROM entity_mappings GROUP BY cik) a JOIN (SELECT cik, max(fiscal_year_end) AS fye, row_number() OVER (ORDER BY cik) AS n FROM entity_mappings GROUP BY cik) b ON b.n = a.n + 1 WHERE regexp_full_match(a.fye, '(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])') AND regexp_full_match(b.fye, '(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])')) x JOIN entity_mappings a ON a.cik = x.ca JOIN entity_mappings b ON b.cik = x.cb""")
def fiscal_alignment(spark, d):
    """Distance of the year ends of each company and the next by number."""
    e = table(spark, d, "entity_mappings").groupBy("cik").agg(F.max("fiscal_year_end").alias("fye"))
    w = W.orderBy("cik")  # one row a company
    p = e.select(F.col("cik").alias("cik_a"), "fye", F.lead("cik").over(w).alias("cik_b"), F.lead("fye").over(w).alias("fye_b"))
    return p.select("cik_a", "cik_b", formats.year_end_distance(F.col("fye"), F.col("fye_b")).cast("long").alias("days")).where(F.col("days").isNotNull())


@query(f"""WITH {_FIN}, {_GROWTH}, y AS (SELECT cik, fiscal_year, fiscal_period, business_term_id, growth_value FROM g WHERE growth_type = 'yoy_pct_change'),
f AS (SELECT fin.cik, fin.business_term_id, fin.fiscal_year, fin.fiscal_period, concat_ws(',', CASE WHEN abs(y.growth_value) > 2 THEN 'extreme_yoy' END, CASE WHEN contains(lower(business_term), 'stockholders equity') AND val < 0 THEN 'negative_equity' END, CASE WHEN contains(lower(business_term), 'revenue') AND val < 0 THEN 'negative_revenue' END) AS flags FROM fin LEFT JOIN y USING (cik, fiscal_year, fiscal_period, business_term_id) WHERE val IS NOT NULL)
SELECT * FROM f WHERE flags <> ''""")
def anomaly_flags(spark, d):
    f = _fin(spark, d)
    y = derived.growth(f).where(F.col("growth_type") == "yoy_pct_change").select("cik", "business_term_id", "fiscal_period", "fiscal_year", F.col("growth_value").alias("yoy"))
    j = f.join(y, ["cik", "business_term_id", "fiscal_period", "fiscal_year"], "left")
    none = F.lit(None).cast("double")
    flags = formats.anomaly_flags(F.col("val"), F.col("business_term"), F.col("yoy"), F.lit(None).cast("string"), none, F.col("sector"))
    return j.select("cik", "business_term_id", "fiscal_year", "fiscal_period", F.array_join(flags, ",").alias("flags")).where(F.col("flags") != "")


# dedup, sets, JSON, profile, rules

@query("SELECT DISTINCT accession_number FROM xbrl_company_facts x WHERE NOT EXISTS (SELECT 1 FROM financial_facts f WHERE f.accession_number = x.accession_number)")
def anti_dedup(spark, d):
    """Filings that the facts don't have yet; a null is nowhere stored."""
    return new_rows(table(spark, d, "xbrl_company_facts").select("accession_number").distinct(), _facts(spark, d), ["accession_number"])


@query("""SELECT row_no FROM xbrl_company_facts n WHERE load_date = (SELECT max(load_date) FROM xbrl_company_facts) AND NOT EXISTS (SELECT 1 FROM xbrl_company_facts o WHERE o.load_date < (SELECT max(load_date) FROM xbrl_company_facts)
AND o.cik IS NOT DISTINCT FROM n.cik AND o.accession_number IS NOT DISTINCT FROM n.accession_number AND o.concept IS NOT DISTINCT FROM n.concept AND o.unit IS NOT DISTINCT FROM n.unit AND o.end_date IS NOT DISTINCT FROM n.end_date)""")
def multi_key_anti(spark, d):
    """Rows of the last load that no earlier load has."""
    x = table(spark, d, "xbrl_company_facts").select("row_no", "load_date", *filings.RAW_KEY)
    last = F.broadcast(x.agg(F.max("load_date").alias("load_date")))  # one row
    return new_rows(x.join(last, "load_date", "left_semi"), x.where(F.col("load_date").isNotNull()).join(last, "load_date", "left_anti"), filings.RAW_KEY, null_safe=True).select("row_no")


@query("SELECT DISTINCT fiscal_year FROM company_financials WHERE sector = 'Technology' INTERSECT SELECT DISTINCT fiscal_year FROM company_financials WHERE sector = 'Energy'")
def intersect_years(spark, d):
    f = table(spark, d, "company_financials")
    years = lambda s: f.where(F.col("sector") == s).select("fiscal_year")
    return years("Technology").intersect(years("Energy"))


@query("SELECT DISTINCT concept FROM xbrl_company_facts EXCEPT SELECT DISTINCT concept FROM financial_facts")
def except_concepts(spark, d):
    return table(spark, d, "xbrl_company_facts").select("concept").subtract(_facts(spark, d).select("concept"))


@query("SELECT cik, fiscal_year, fiscal_period, business_term_id AS metric_id, val AS metric_value, 'company_financials' AS metric_source FROM company_financials UNION ALL SELECT cik, fiscal_year, fiscal_period, ratio_id, ratio_value, 'financial_ratios' FROM financial_ratios")
def union_normalized(spark, d):
    k = ["cik", "fiscal_year", "fiscal_period"]
    a = table(spark, d, "company_financials").select(*k, F.col("business_term_id").alias("metric_id"), F.col("val").alias("metric_value"), F.lit("company_financials").alias("metric_source"))
    b = table(spark, d, "financial_ratios").select(*k, F.col("ratio_id").alias("metric_id"), F.col("ratio_value").alias("metric_value"), F.lit("financial_ratios").alias("metric_source"))
    return a.unionByName(b)


@query("SELECT event_type, count(*) AS n, sum(CAST(props->>'$.k' AS BIGINT))::BIGINT AS sum_k FROM events GROUP BY event_type")
def explode_json(spark, d):
    e = table(spark, d, "events").withColumn("p", F.from_json("props", "map<string,long>"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.try_element_at("p", F.lit("k"))).alias("sum_k"))


@query()
def flatten_documents(spark, d):
    """Well-formed documents by the JVM path."""
    return filings.flatten(table(spark, d, "company_fact_files"))


_PROFILE = ["o_orderstatus", "o_orderpriority"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, min({c}) AS least, max({c}) AS greatest, min(length({c})) AS min_length, max(length({c})) AS max_length FROM orders" for c in _PROFILE))
def profile_columns(spark, d):
    p = filings.profile(table(spark, d, "orders").select(*_PROFILE))
    return p.select("column_name", F.col("n_null").cast("long").alias("n_null"), "n_distinct", "least", "greatest", F.col("min_length").cast("long").alias("min_length"), F.col("max_length").cast("long").alias("max_length"))


#: Rules whose tables are among the test tables; DuckDB doesn't read the SQL of those in _SKIP, or they ask for the day it is.
_TABLES = {"raw.xbrl_company_facts": "xbrl_company_facts", "base.financial_facts": "financial_facts", "base.entity_mappings": "entity_mappings", "consumable.company_financials": "company_financials", "consumable.financial_ratios": "financial_ratios"}
_SKIP = {"RAW-CF-004", "RAW-CF-006", "RAW-CF-008", "RAW-CF-022", "BASE-BT-001", "RAW-CF-005", "RAW-CF-021"}


#: The day it is for rules that ask.
_NOW = {"CURRENT_DATE": "DATE '2026-05-01'", "CURRENT_TIMESTAMP": "TIMESTAMP '2026-05-01 00:00:00'"}


def _testable(skip: set[str] = _SKIP) -> list[rules.Rule]:
    out = []
    for r in rulebook():
        sql = r.sql
        for a, b in _TABLES.items():
            sql = sql.replace(a, b)
        if r.rule_id not in skip and not any(f"{z}." in sql for z in ("raw", "base", "consumable")):
            r.sql = sql
            out.append(r)
    return out


def _scalar(r: rules.Rule) -> str:
    return f"SELECT COUNT(*) AS v FROM ({r.sql}) q" if r.threshold.startswith("result_count") else r.sql


@query(" UNION ALL ".join(f"SELECT '{r.rule_id}' AS rule_id, CAST(({_scalar(r)}) AS DOUBLE) AS raw_value" for r in _testable()))
def dq_rules(spark, d):
    """The raw value of every rule that the test tables can answer and whose SQL both engines read, as one union of scalar
    subqueries. dq_rules_all has all of them."""
    return _raw_values(spark, d, _testable())


@query()
def dq_rules_all(spark, d):
    """The raw value of every rule that the test tables can answer, with a fixed day for those that ask for it."""
    every = _testable(set())
    for r in every:
        for a, b in _NOW.items():
            r.sql = r.sql.replace(a, b)
    return _raw_values(spark, d, every)


def _raw_values(spark, d, chosen: list[rules.Rule]):
    for t in _TABLES.values():
        table(spark, d, t).createOrReplaceTempView(t)
    return rules.raw_values(spark, chosen)


@query()
def chaos_inject(spark, d):
    """Fault injection at 7 percent: rows for each dimension."""
    from tallystone.operators import governance

    x = table(spark, d, "xbrl_company_facts")
    return governance.corruptions(x, 0.07).groupBy("chaos_dimension").agg(F.count(F.lit(1)).alias("n"))
