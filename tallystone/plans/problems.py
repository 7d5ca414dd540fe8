"""Queries of the core training-data problems 1, 2, 3, 5 and 6, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.operators import asof, nested, orphans, profile, readings
from tallystone.runtime import stage, table

#: Columns whose text both engines write alike.
PLAIN_COLUMNS = ["cik", "entity_name", "taxonomy", "concept", "label", "unit", "accession_number", "fiscal_year", "frame", "source_method"]
RAW_COLUMNS = ["cik", "entity_name", "taxonomy", "concept", "label", "description", "unit", "start_date", "val", "accession_number", "fiscal_year", "filed_date", "frame", "ingested_at", "source_url", "source_method"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.found(table(spark, d, "xbrl_company_facts"))


def p1_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.profile(table(spark, d, "xbrl_company_facts"), profile.SPECS + [profile.Spec(c) for c in RAW_COLUMNS])


def p1_expressions(spark: SparkSession, d: str) -> DataFrame:
    return profile.expressions(table(spark, d, "xbrl_company_facts"), profile.SPECS + [profile.Spec(c) for c in RAW_COLUMNS])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.found(table(spark, d, "company_fact_files"))


def p2_observations(spark: SparkSession, d: str) -> DataFrame:
    return nested.Nested(table(spark, d, "company_fact_files")).observations()


def p2_concepts(spark: SparkSession, d: str) -> DataFrame:
    return nested.Nested(table(spark, d, "company_fact_files")).concepts()


def p2_observation_rows(spark: SparkSession, d: str) -> DataFrame:
    """The observations without their identities."""
    o = nested.Nested(table(spark, d, "company_fact_files")).observations()
    return o.select("file_no", "cik", "taxonomy", "concept", "unit", "obs_no", "start_date", "end_date", "val", "accession_number", "fiscal_period", "form", "filed_date", "frame", "usable")


def p2_concept_rows(spark: SparkSession, d: str) -> DataFrame:
    return nested.Nested(table(spark, d, "company_fact_files")).concepts().select("file_no", "cik", "taxonomy", "concept", "label", "description")


def p2_company_rows(spark: SparkSession, d: str) -> DataFrame:
    return nested.Nested(table(spark, d, "company_fact_files")).companies().select("file_no", "cik", "entity_name")


def p1_loads(spark: SparkSession, d: str) -> DataFrame:
    """The standard aggregates of every column and load: rows, nulls, distinct values, and the gaps against other loads."""
    x = table(spark, d, "xbrl_company_facts")
    specs = profile.SPECS + [profile.Spec(c) for c in PLAIN_COLUMNS]
    counts = stage(profile.value_counts(x, specs), "counts")
    n = counts.groupBy("column_name", "load_date").agg(F.countDistinct("value").alias("n_distinct"))
    c = profile.load_changes(counts, specs).join(n, ["column_name", "load_date"])
    return c.select("column_name", "load_date", "rows", F.round("null_share", 6).alias("null_share"), "n_distinct", F.round("null_gap", 6).alias("null_gap"), F.round("shift", 6).alias("shift"))


def p2_parts(spark: SparkSession, d: str) -> DataFrame:
    return nested.Nested(table(spark, d, "company_fact_files")).parts()


def p2_companies(spark: SparkSession, d: str) -> DataFrame:
    return nested.Nested(table(spark, d, "company_fact_files")).companies()


def _three(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, t) for t in ("company_financials", "financial_ratios", "business_terms")]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.found(*_three(spark, d))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.report(*_three(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return asof.found(table(spark, d, "metric_requests"), table(spark, d, "financial_facts"))


def p5_values(spark: SparkSession, d: str) -> DataFrame:
    return asof.values(table(spark, d, "metric_requests"), table(spark, d, "financial_facts"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return readings.found(table(spark, d, "xbrl_company_facts"))


def p6_scores(spark: SparkSession, d: str) -> DataFrame:
    return readings.scores(table(spark, d, "xbrl_company_facts"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_profile, p1_expressions, p2_found, p2_observations, p2_concepts, p2_companies, p2_parts, p2_observation_rows, p2_concept_rows, p2_company_rows, p1_loads, p3_found, p3_report, p5_found, p5_values, p6_found, p6_scores)}

_DOMAIN = "fiscal_period IN ('Q1', 'Q2', 'Q3', 'Q4', 'FY')"
_FORMS = "('10-K', '10-Q', '10-K/A', '10-Q/A', '10-KT', '8-K', '8-K/A', '20-F', '20-F/A', '40-F', '6-K')"
_LOADS = """SELECT load_date, 'fiscal_period' AS c, fiscal_period AS v FROM xbrl_company_facts UNION ALL SELECT load_date, 'form', form FROM xbrl_company_facts UNION ALL SELECT load_date, 'end_date', year(end_date)::VARCHAR FROM xbrl_company_facts"""


def _spelling(c: str) -> str:
    return f"upper(regexp_replace(regexp_replace({c}, '^[^:]*:', ''), '\\s+', '', 'g'))"


_REFERENCES = """t AS (SELECT upper(business_term_id) AS name, business_term_id AS term, added_on, retired_on FROM business_terms UNION ALL SELECT upper(legacy_id), business_term_id, added_on, retired_on FROM business_terms WHERE legacy_id IS NOT NULL),
refs AS (SELECT 'company_financials' AS table_name, 'business_term_id' AS column_name, record_id, cik, fiscal_year, fiscal_period, load_date, business_term_id AS ref FROM company_financials
UNION ALL SELECT 'financial_ratios', 'numerator_bt_id', record_id, cik, fiscal_year, fiscal_period, load_date, numerator_bt_id FROM financial_ratios
UNION ALL SELECT 'financial_ratios', 'denominator_bt_id', record_id, cik, fiscal_year, fiscal_period, load_date, denominator_bt_id FROM financial_ratios),
j AS (SELECT refs.*, t.term, added_on, retired_on FROM refs LEFT JOIN t ON upper(trim(ref, ' \t\n\r')) = t.name WHERE trim(ref, ' \t\n\r') <> ''),
k AS (SELECT cik, fiscal_year, fiscal_period, term, min(load_date) AS first_load FROM j WHERE table_name = 'company_financials' AND term IS NOT NULL GROUP BY ALL),
o AS (SELECT j.*, CASE WHEN j.term IS NULL THEN 'missing' WHEN retired_on <= load_date THEN 'deleted' WHEN added_on > load_date THEN 'late' WHEN table_name = 'financial_ratios' AND first_load IS NULL THEN 'no_component' WHEN table_name = 'financial_ratios' AND first_load > load_date THEN 'late_component' END AS kind
FROM j LEFT JOIN k ON j.cik = k.cik AND j.fiscal_year = k.fiscal_year AND j.fiscal_period = k.fiscal_period AND j.term = k.term)"""
_AS_OF = f"""WITH f AS (SELECT cik, {_spelling("concept")} AS c, {_spelling("unit")} AS u, end_date, filed_date, accession_number, fact_id FROM financial_facts), r AS (SELECT request_id, cik, {_spelling("concept")} AS c, {_spelling("unit")} AS u, CAST(requested_at AT TIME ZONE 'UTC' AS DATE) AS d FROM metric_requests)
SELECT r.request_id, f.fact_id FROM r JOIN f ON r.cik = f.cik AND r.c = f.c AND r.u = f.u AND f.filed_date <= r.d QUALIFY row_number() OVER (PARTITION BY r.request_id ORDER BY f.end_date DESC NULLS LAST, f.filed_date DESC, f.accession_number DESC NULLS LAST, f.fact_id DESC NULLS LAST) = 1"""

#: The documents of the test tables come bare, as a JSON string, in a list of one or in an envelope `data`.
_NESTED = r"""WITH t AS (SELECT file_no, file_name, trim(ltrim(trim(payload, ' ' || chr(10) || chr(13) || chr(9)), chr(65279)), ' ' || chr(10) || chr(13) || chr(9)) AS p FROM company_fact_files WHERE payload IS NOT NULL),
v AS (SELECT file_no, file_name, CASE WHEN json_valid(p) THEN p::JSON END AS j FROM t),
a AS (SELECT file_no, file_name, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN (j->>'$')::JSON END ELSE j END AS j FROM v),
b AS (SELECT file_no, file_name, CASE WHEN json_type(j) = 'ARRAY' THEN j->'$[0]' ELSE j END AS j FROM a),
d AS (SELECT file_no, file_name, CASE WHEN json_exists(j, '$.facts') OR json_exists(j, '$.cik') OR json_exists(j, '$.entityName') THEN j ELSE j->'data' END AS j FROM b),
x AS (SELECT file_no, coalesce(try_cast(try_cast(j->>'$.cik' AS DOUBLE) AS INTEGER), try_cast(regexp_extract(file_name, '[0-9]+') AS INTEGER)) AS cik, j->'facts' AS f FROM d),
tx AS (SELECT file_no, cik, e.key AS taxonomy, e.value AS v FROM x, json_each(x.f) e WHERE json_type(x.f) = 'OBJECT'),
cx AS (SELECT file_no, cik, taxonomy, e.key AS concept, e.value->'units' AS v FROM tx, json_each(tx.v) e WHERE json_type(tx.v) = 'OBJECT' AND json_type(e.value) = 'OBJECT'),
ux AS (SELECT file_no, cik, taxonomy, concept, e.key AS unit, CASE WHEN json_type(e.value) = 'OBJECT' THEN json_array(e.value) ELSE e.value END AS v FROM cx, json_each(cx.v) e WHERE json_type(cx.v) = 'OBJECT'),
ox AS (SELECT file_no, cik, taxonomy, concept, unit, e.key::INTEGER AS obs_no, e.value AS o FROM ux, json_each(ux.v) e WHERE json_type(ux.v) = 'ARRAY')
SELECT DISTINCT file_no, cik, taxonomy, concept, unit, obs_no FROM ox WHERE json_type(o) = 'OBJECT' AND trim(coalesce(o->>'end', '')) <> '' AND try_cast(replace(replace(o->>'val', ',', ''), ' ', '') AS DOUBLE) IS NOT NULL"""

_TREE = _NESTED[: _NESTED.index("SELECT DISTINCT file_no")]


def _load_sql() -> str:
    cells = [(c, "year(end_date)::VARCHAR" if c == "end_date" else f"{c}::VARCHAR", f"{c}::VARCHAR") for c in ["fiscal_period", "form", "end_date", *PLAIN_COLUMNS]]
    x = " UNION ALL ".join(f"SELECT '{c}' AS c, load_date, {b} AS v, {w} AS w FROM xbrl_company_facts WHERE load_date IS NOT NULL" for c, b, w in cells)
    return f"""WITH x AS ({x}), l AS (SELECT c, load_date, count(*) AS n, count(v) AS f, count(DISTINCT w) AS d FROM x GROUP BY ALL), t AS (SELECT c, sum(n) AS n, sum(f) AS f FROM l GROUP BY c),
n AS (SELECT c, load_date, v, count(*) AS n FROM x WHERE v IS NOT NULL GROUP BY ALL), a AS (SELECT c, v, sum(n) AS n FROM n GROUP BY ALL),
s AS (SELECT n.c, n.load_date, sum(abs(n.n / l.f - (a.n - n.n) / (t.f - l.f))) AS d, sum((a.n - n.n) / (t.f - l.f)) AS q FROM n JOIN a ON a.c = n.c AND a.v = n.v JOIN l ON l.c = n.c AND l.load_date = n.load_date JOIN t ON t.c = n.c WHERE t.f > l.f GROUP BY ALL)
SELECT l.c AS column_name, l.load_date, l.n AS "rows", round((l.n - l.f) / l.n, 6) AS null_share, l.d AS n_distinct, round(abs((l.n - l.f) / l.n - ((t.n - t.f) - (l.n - l.f)) / (t.n - l.n)), 6) AS null_gap, round((s.d + 1 - s.q) / 2, 6) AS shift FROM l JOIN t ON t.c = l.c LEFT JOIN s ON s.c = l.c AND s.load_date = l.load_date"""


SQL: dict[str, str] = {
    "p1_loads": _load_sql(),
    "p2_found": _NESTED,
    "p2_observation_rows": _TREE + """SELECT file_no, cik, taxonomy, concept, unit, obs_no, try_cast(o->>'start' AS DATE) AS start_date, try_cast(o->>'end' AS DATE) AS end_date, try_cast(replace(replace(o->>'val', ',', ''), ' ', '') AS DOUBLE) AS val, o->>'accn' AS accession_number, o->>'fp' AS fiscal_period, o->>'form' AS form, try_cast(o->>'filed' AS DATE) AS filed_date, o->>'frame' AS frame,
trim(coalesce(o->>'end', '')) <> '' AND try_cast(replace(replace(o->>'val', ',', ''), ' ', '') AS DOUBLE) IS NOT NULL AS usable FROM ox WHERE json_type(o) = 'OBJECT'""",
    "p2_concept_rows": _TREE + "SELECT file_no, cik, taxonomy, e.key AS concept, e.value->>'label' AS label, e.value->>'description' AS description FROM tx, json_each(tx.v) e WHERE json_type(tx.v) = 'OBJECT' AND json_type(e.value) = 'OBJECT'",
    "p2_company_rows": _TREE.replace("j->'facts' AS f FROM d)", "j->'facts' AS f, j->>'entityName' AS name FROM d WHERE j IS NOT NULL AND json_type(j) = 'OBJECT')") + "SELECT file_no, cik, name AS entity_name FROM x",
    "p1_found": f"""WITH x AS ({_LOADS}), n AS (SELECT c, load_date, v, count(*) AS n FROM x WHERE load_date IS NOT NULL GROUP BY ALL), l AS (SELECT c, load_date, sum(n) AS n, coalesce(sum(n) FILTER (v IS NOT NULL), 0) AS f FROM n GROUP BY ALL),
t AS (SELECT c, sum(n) AS n, sum(f) AS f FROM l GROUP BY c), vv AS (SELECT DISTINCT c, v FROM n WHERE v IS NOT NULL),
s AS (SELECT l.c, l.load_date, sum(abs(coalesce(a.n, 0) / l.f - (w.n - coalesce(a.n, 0)) / (t.f - l.f))) / 2 AS shift FROM l JOIN t ON t.c = l.c JOIN vv ON vv.c = l.c JOIN (SELECT c, v, sum(n) AS n FROM n GROUP BY ALL) w ON w.c = l.c AND w.v = vv.v LEFT JOIN n a ON a.c = l.c AND a.load_date = l.load_date AND a.v = vv.v WHERE l.f > 0 AND t.f > l.f GROUP BY l.c, l.load_date)
SELECT 'violation' AS finding, 'fiscal_period' AS column_name, row_no::VARCHAR AS item_key FROM xbrl_company_facts WHERE fiscal_period IS NOT NULL AND NOT {_DOMAIN}
UNION ALL SELECT 'violation', 'form', row_no::VARCHAR FROM xbrl_company_facts WHERE form IS NULL OR form NOT IN {_FORMS}
UNION ALL SELECT 'violation', 'end_date', row_no::VARCHAR FROM xbrl_company_facts WHERE end_date IS NULL OR end_date < DATE '1993-01-01' OR end_date > filed_date OR end_date < start_date
UNION ALL SELECT 'nulls', l.c, strftime(load_date, '%Y-%m-%d') FROM l JOIN t ON t.c = l.c WHERE t.n > l.n AND abs((l.n - l.f) / l.n - ((t.n - t.f) - (l.n - l.f)) / (t.n - l.n)) > 0.05
UNION ALL SELECT 'shift', c, strftime(load_date, '%Y-%m-%d') FROM s WHERE shift > 0.25""",
    "p3_found": f"WITH {_REFERENCES} SELECT DISTINCT table_name, column_name, record_id, kind FROM o WHERE kind IS NOT NULL",
    "p3_report": f"WITH {_REFERENCES}, per AS (SELECT table_name, column_name, fiscal_year, fiscal_period, kind, count(DISTINCT record_id) AS n_orphans, count(*) AS n_rows FROM o GROUP BY ALL) SELECT * FROM (SELECT *, (sum(n_rows) OVER (PARTITION BY table_name, column_name, fiscal_year, fiscal_period))::BIGINT AS n_references FROM per) WHERE kind IS NOT NULL",
    "p5_found": _AS_OF,
    "p5_values": f"WITH a AS ({_AS_OF}), v AS (SELECT * FROM financial_facts WHERE fact_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY fact_id ORDER BY promoted_at DESC NULLS LAST, val DESC NULLS LAST, end_date DESC NULLS LAST, filed_date DESC NULLS LAST) = 1) SELECT a.request_id, a.fact_id, v.val, v.end_date, v.filed_date FROM a JOIN v USING (fact_id)",
}
