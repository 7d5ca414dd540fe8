"""Queries of the serving tools, promotion and checks over whole tables, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.functions import formats
from tallystone.operators import checks, derived, entities, facts
from tallystone.plans import catalog as C
from tallystone.plans import rule_queries as R
from tallystone.plans import values as V
from tallystone.plans.serving import Tools
from tallystone.runtime import stage, table
from tallystone.sources.store import new_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_FIN, _PAIRS, _RATIO, _GROWTH = C._FIN, C._PAIRS, C._RATIO, C._GROWTH
_K = ["cik", "fiscal_year", "fiscal_period"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _round(c: str, n: int = 5):
    return F.round(c, n).alias(c)


# figures with growth, rank, margin

_GP = "gp AS (SELECT cik, business_term_id, fiscal_year, fiscal_period, max(growth_value) FILTER (growth_type = 'yoy_change') AS yoy_change, max(growth_value) FILTER (growth_type = 'yoy_pct_change') AS yoy_pct_change, max(growth_value) FILTER (growth_type = 'cagr_5yr') AS cagr_5yr FROM g GROUP BY ALL)"
_PK = """pk AS (SELECT * FROM (SELECT sector, business_term_id, fiscal_year, fiscal_period, cik, count(*) OVER p AS peer_count, dense_rank() OVER (PARTITION BY sector, business_term_id, fiscal_year, fiscal_period ORDER BY val DESC) AS sector_rank FROM (SELECT sector, business_term_id, fiscal_year, fiscal_period, cik, max(val) AS val FROM fin WHERE val IS NOT NULL GROUP BY ALL) WINDOW p AS (PARTITION BY sector, business_term_id, fiscal_year, fiscal_period)) WHERE peer_count >= 2)"""
_METRICS = f"""WITH {_FIN}, {_GROWTH}, {_RATIO}, {_GP}, {_PK}, nm AS (SELECT cik, fiscal_year, fiscal_period, max(ratio_value) AS net_margin FROM r WHERE ratio_id = 'RATIO-003' GROUP BY ALL),
m AS (SELECT fin.cik, fin.business_term_id, fin.fiscal_year, fin.fiscal_period, fin.business_term, fin.sector, fin.val, yoy_change, yoy_pct_change, cagr_5yr, sector_rank, peer_count, net_margin FROM fin LEFT JOIN gp USING (cik, business_term_id, fiscal_year, fiscal_period)
LEFT JOIN pk ON pk.cik = fin.cik AND pk.sector = fin.sector AND pk.business_term_id = fin.business_term_id AND pk.fiscal_year = fin.fiscal_year AND pk.fiscal_period = fin.fiscal_period LEFT JOIN nm ON nm.cik = fin.cik AND nm.fiscal_year = fin.fiscal_year AND nm.fiscal_period = fin.fiscal_period)"""
_SHOWN = "cik, business_term_id, fiscal_year, fiscal_period, val, round(yoy_change, 4) AS yoy_change, round(yoy_pct_change, 4) AS yoy_pct_change, round(cagr_5yr, 4) AS cagr_5yr, sector_rank, peer_count, round(net_margin, 6) AS net_margin"


def metrics(fin: DataFrame) -> DataFrame:
    """Every figure with its growth, rank among peers and the company's net margin: left joins, missing is null."""
    g = derived.growth(fin)
    pick = lambda k: F.max(F.when(F.col("growth_type") == k, F.col("growth_value"))).alias(k)
    gp = g.groupBy(*_K, "business_term_id").agg(*[pick(k) for k in ("yoy_change", "yoy_pct_change", "cagr_5yr")])
    p = derived.peers(fin, ["sector", "business_term_id", "fiscal_year", "fiscal_period"]).select("sector", *_K, "business_term_id", "sector_rank", "peer_count")
    nm = derived.ratios(fin).where("ratio_id = 'RATIO-003'").select(*_K, F.col("ratio_value").alias("net_margin"))
    return fin.join(gp, [*_K, "business_term_id"], "left").join(p, ["sector", *_K, "business_term_id"], "left").join(nm, _K, "left")


def _shown(m: DataFrame) -> DataFrame:
    return m.select(*_K, "business_term_id", "val", _round("yoy_change", 4), _round("yoy_pct_change", 4), _round("cagr_5yr", 4), "sector_rank", "peer_count", _round("net_margin", 6))


@query(f"{_METRICS} SELECT {_SHOWN} FROM m")
def company_metrics(spark, d):
    """get_company_metric for every company, term and period."""
    return _shown(metrics(C._fin(spark, d)))


@query(f"{_METRICS} SELECT {_SHOWN} FROM m WHERE fiscal_period = 'FY' QUALIFY row_number() OVER (PARTITION BY cik, business_term_id ORDER BY fiscal_year DESC) = 1")
def latest_metrics(spark, d):
    """get_company_metric without a year: the latest fiscal year of each company and term."""
    m = metrics(C._fin(spark, d)).where("fiscal_period = 'FY'")
    return _shown(checks.latest(m, ["cik", "business_term_id"], [F.col("fiscal_year").desc()]))


@query(f"""{_METRICS}, y AS (SELECT cik, max(fiscal_year) AS fiscal_year FROM fin WHERE fiscal_period = 'FY' GROUP BY cik), {_PAIRS},
a AS (SELECT cik, year(end_date) AS fiscal_year, count(*) AS amendments FROM pairs GROUP BY ALL), c AS (SELECT cik, fiscal_year, count(*) AS ratios FROM r WHERE fiscal_period = 'FY' GROUP BY ALL)
SELECT cik, fiscal_year, any_value(k) AS metrics, coalesce(any_value(ratios), 0) AS ratios, any_value(amendments) AS amendments FROM (SELECT y.cik, y.fiscal_year, count(*) AS k FROM y JOIN fin ON fin.cik = y.cik AND fin.fiscal_year = y.fiscal_year AND fin.fiscal_period = 'FY' GROUP BY ALL) x LEFT JOIN c USING (cik, fiscal_year) LEFT JOIN a USING (cik, fiscal_year) GROUP BY cik, fiscal_year""")
def company_profiles(spark, d):
    """get_company_profile for every company: its latest fiscal year, how many figures and ratios that has, and amendments
    of periods that end in the calendar year of the same number (null where there are none)."""
    fin = C._fin(spark, d)
    fy = fin.where("fiscal_period = 'FY'")
    top = fy.groupBy("cik").agg(F.max("fiscal_year").alias("fiscal_year"))
    k = ["cik", "fiscal_year"]
    n = fy.join(top, k, "left_semi").groupBy(*k).agg(F.count(F.lit(1)).alias("metrics"))
    r = derived.ratios(fin).where("fiscal_period = 'FY'").groupBy(*k).agg(F.count(F.lit(1)).alias("ratios"))
    a = derived.amendment_stats(facts.amendments(C._facts(spark, d), order=C.ORDER)).select(*k, F.col("amendment_count").alias("amendments"))
    return n.join(r, k, "left").join(a, k, "left").select(*k, "metrics", F.coalesce("ratios", F.lit(0)).alias("ratios"), "amendments")


_RP = """rp AS (SELECT * FROM (SELECT sector, ratio_id, fiscal_year, fiscal_period, cik, count(*) OVER p AS peer_count, dense_rank() OVER (PARTITION BY sector, ratio_id, fiscal_year, fiscal_period ORDER BY ratio_value DESC) AS sector_rank FROM (SELECT r.*, sector FROM r JOIN (SELECT cik, max(sector) AS sector FROM fin GROUP BY cik) USING (cik)) WINDOW p AS (PARTITION BY sector, ratio_id, fiscal_year, fiscal_period)) WHERE peer_count >= 2)"""


@query(f"""WITH {_FIN}, {_RATIO.replace(" AS ratio_value FROM", " AS ratio_value, num.val AS numerator_val, den.val AS denominator_val FROM")}, {_RP} SELECT a.cik, a.ratio_id, a.fiscal_year, a.fiscal_period, round(a.ratio_value, 6) AS ratio_value, a.numerator_val, a.denominator_val, sector_rank, peer_count, round(a.ratio_value - b.ratio_value, 6) AS yoy_change
FROM r a LEFT JOIN r b ON a.cik = b.cik AND a.ratio_id = b.ratio_id AND a.fiscal_period = b.fiscal_period AND b.fiscal_year = a.fiscal_year - 1 LEFT JOIN rp ON rp.cik = a.cik AND rp.ratio_id = a.ratio_id AND rp.fiscal_year = a.fiscal_year AND rp.fiscal_period = a.fiscal_period""")
def ratio_details(spark, d):
    """get_ratio for every company, ratio and period: components, rank among peers, change against the year before."""
    fin = C._fin(spark, d)
    r = derived.ratios(fin)
    w = W.partitionBy("cik", "ratio_id", "fiscal_period").orderBy("fiscal_year").rangeBetween(-1, -1)
    who = fin.groupBy("cik").agg(F.max("sector").alias("sector"))
    p = derived.peers(r.join(who, "cik"), ["sector", "ratio_id", "fiscal_year", "fiscal_period"], value="ratio_value").select(*_K, "ratio_id", "sector_rank", "peer_count")
    r = r.withColumn("yoy_change", F.col("ratio_value") - F.first("ratio_value").over(w)).join(p, [*_K, "ratio_id"], "left")
    return r.select(*_K, "ratio_id", _round("ratio_value", 6), "numerator_val", "denominator_val", "sector_rank", "peer_count", _round("yoy_change", 6))


@query(f"WITH {_PAIRS}, a AS (SELECT cik, year(end_date) AS fiscal_year, count(*) AS amendment_count, count(DISTINCT concept) AS distinct_concepts, round(coalesce(max(abs(val_change)), 0), 5) AS max_abs_change FROM pairs GROUP BY ALL) SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY cik ORDER BY fiscal_year DESC) = 1")
def amendment_summaries(spark, d):
    """get_amendment_summary for every company: the latest year."""
    s = derived.amendment_stats(facts.amendments(C._facts(spark, d), order=C.ORDER))
    s = checks.latest(s, ["cik"], [F.col("fiscal_year").desc()])
    return s.select("cik", F.col("fiscal_year").cast("long").alias("fiscal_year"), "amendment_count", "distinct_concepts", _round("max_abs_change"))


#: Texts of the flags, {} the figure.
_TEXT = formats.FLAG_TEXTS


def _flag_sql() -> str:
    t = {k: v.replace("'", "''").split("{}") for k, v in _TEXT.items()}
    e, x = t["extreme_yoy"], t["extreme_leverage"]
    return f"""CASE WHEN abs(yoy) > 2.0 THEN '{e[0]}' || printf('%.0f', abs(yoy) * 100) || '{e[1]}' END AS f1, CASE WHEN contains(lower(metric), 'stockholders equity') AND val < 0 THEN '{t["negative_equity"][0]}' END AS f2,
CASE WHEN contains(lower(ratio), 'debt') AND contains(lower(ratio), 'equity') AND abs(val) > 50 THEN '{x[0]}' || printf('%.1f', val) || '{x[1]}' END AS f3, CASE WHEN contains(lower(metric), 'revenue') AND val < 0 THEN '{t["negative_revenue"][0]}' END AS f4, CASE WHEN margin < -1.0 THEN '{t["pre_profitability"][0]}' END AS f5,
CASE WHEN sector = 'Financials' AND (contains(lower(metric), 'gross margin') OR contains(lower(metric), 'operating margin')) THEN '{t["not_applicable"][0]}' END AS f6"""


@query(f"""{_METRICS}, v AS (SELECT cik, fiscal_year, fiscal_period, business_term_id AS id, business_term AS metric, NULL AS ratio, val, yoy_pct_change AS yoy, net_margin AS margin, sector FROM m
UNION ALL SELECT q.cik, q.fiscal_year, q.fiscal_period, q.ratio_id, NULL, q.ratio_name, q.ratio_value, NULL, CASE WHEN q.ratio_id = 'RATIO-003' THEN q.ratio_value END, q.sector FROM (SELECT DISTINCT cik, fiscal_year, fiscal_period, ratio_id, ratio_name, ratio_value, sector FROM financial_ratios) q),
w AS (SELECT cik, fiscal_year, fiscal_period, id, {_flag_sql()} FROM v WHERE val IS NOT NULL) SELECT cik, fiscal_year, fiscal_period, id, unnest(list_filter([f1, f2, f3, f4, f5, f6], lambda f: f IS NOT NULL)) AS flag FROM w""")
def anomaly_texts(spark, d):
    """All six flags with their texts, for every figure and every ratio of the tables."""
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    a = metrics(C._fin(spark, d)).select(*_K, F.col("business_term_id").alias("id"), formats.anomaly_texts(F.col("val"), F.col("business_term"), F.col("yoy_pct_change"), text, F.col("net_margin"), F.col("sector")).alias("flags"))
    q = table(spark, d, "financial_ratios").select(*_K, "ratio_id", "ratio_name", "ratio_value", "sector").distinct()
    margin = F.when(F.col("ratio_id") == "RATIO-003", F.col("ratio_value"))
    b = q.select(*_K, F.col("ratio_id").alias("id"), formats.anomaly_texts(F.col("ratio_value"), text, none, F.col("ratio_name"), margin, F.col("sector")).alias("flags"))
    return a.unionByName(b).select(*_K, "id", F.explode("flags").alias("flag"))


@query(f"""WITH f AS (SELECT cik, concept, unit, fiscal_year, val, regexp_replace(concept, '([a-z])([A-Z])', '\\1 \\2', 'g') AS metric FROM xbrl_company_facts WHERE fiscal_period = 'FY' AND isfinite(val) QUALIFY row_number() OVER (PARTITION BY cik, concept, unit, fiscal_year ORDER BY end_date DESC NULLS LAST, filed_date DESC NULLS LAST, row_no DESC) = 1),
v AS (SELECT a.cik, a.concept, a.unit, a.fiscal_year, a.metric, NULL AS ratio, a.val, CASE WHEN b.val <> 0 THEN (a.val - b.val) / abs(b.val) END AS yoy, NULL::DOUBLE AS margin, NULL AS sector FROM f a LEFT JOIN f b ON a.cik = b.cik AND a.concept = b.concept AND a.unit = b.unit AND b.fiscal_year = a.fiscal_year - 1),
w AS (SELECT cik, concept, unit, fiscal_year, {_flag_sql()} FROM v) SELECT cik, concept, unit, fiscal_year, unnest(list_filter([f1, f2, f3, f4, f5, f6], lambda f: f IS NOT NULL)) AS flag FROM w""")
def anomaly_raw(spark, d):
    """Flags of the yearly raw figures, whose spikes and signs no rule has seen yet."""
    key = ["cik", "concept", "unit"]
    x = table(spark, d, "xbrl_company_facts").where((F.col("fiscal_period") == "FY") & ~F.isnan("val") & (F.abs("val") < float("inf")))
    f = checks.latest(x, [*key, "fiscal_year"], [F.col("end_date").desc_nulls_last(), F.col("filed_date").desc_nulls_last(), F.col("row_no").desc()])
    before = F.first("val").over(W.partitionBy(*key).orderBy("fiscal_year").rangeBetween(-1, -1))
    f = f.withColumn("yoy", X.pct_of_abs(F.col("val"), F.when(before != 0, before)))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    metric = F.regexp_replace("concept", "([a-z])([A-Z])", "$1 $2")
    return f.select(*key, "fiscal_year", F.explode(formats.anomaly_texts(F.col("val"), metric, F.col("yoy"), text, none, text)).alias("flag"))


_ASKED = ["BT-022", "bt-023", "BT-999", "ratio-003", "revenue", "NET INCOME", "margin", "debt", "total", "no such figure"]
_ASK = ", ".join(f"('{x}')" for x in _ASKED)


@query(f"""WITH {_FIN}, names AS (SELECT business_term_id AS id, min(business_term) AS name, 'company_financials' AS source, 1 AS o FROM fin WHERE business_term IS NOT NULL GROUP BY 1 UNION ALL SELECT ratio_id, min(ratio_name), 'financial_ratios', 2 FROM financial_ratios WHERE ratio_id IS NOT NULL AND ratio_name IS NOT NULL GROUP BY 1),
q AS (SELECT * FROM (VALUES {_ASK}) v(asked)), hit AS (SELECT asked, upper(asked) AS id, CASE WHEN upper(asked) LIKE 'BT-%' THEN 'company_financials' ELSE 'financial_ratios' END AS source, 0 AS rank FROM q WHERE upper(asked) LIKE 'BT-%' OR upper(asked) LIKE 'RATIO-%'
UNION ALL SELECT asked, id, source, o FROM q JOIN names ON lower(name) = lower(asked) UNION ALL SELECT asked, id, source, 2 + o FROM q JOIN names ON contains(lower(name), lower(asked)))
SELECT asked, id, source FROM q LEFT JOIN hit USING (asked) QUALIFY row_number() OVER (PARTITION BY asked ORDER BY rank, id) = 1""")
def resolve_names(spark, d):
    """The resolver of the tools on a fixed list of names: id prefix, exact name, part of a name, figures before ratios."""
    t = Tools(spark, {"company_financials": C._fin(spark, d), "financial_ratios": table(spark, d, "financial_ratios")}, cache=False)
    rows = []
    for x in _ASKED:
        try:
            i, _, source = t.resolve(x)
            rows.append((x, i, source))
        except ValueError:
            rows.append((x, None, None))
    return spark.createDataFrame(rows, "asked string, id string, source string")  # the names asked for


# promotion

_CUT = "DATE '2025-12-31'"


@query(f"SELECT DISTINCT mapping_id, cik FROM entity_mappings WHERE status = 'approved' AND load_date > {_CUT} AND cik NOT IN (SELECT cik FROM entity_mappings WHERE status = 'approved' AND load_date <= {_CUT} AND cik IS NOT NULL)")
def promotable_entities(spark, d):
    """Approved proposals of later loads whose company has no approved mapping in the earlier ones."""
    e = table(spark, d, "entity_mappings")
    early = F.col("load_date") <= F.expr(_CUT)
    return entities.promotable(e.where(~early), e.where(early)).select("mapping_id", "cik").distinct()


@query(f"WITH c AS ({C._classify_sql()}) SELECT concept, business_term_id, CASE WHEN business_term_id IS NULL THEN 'unmapped' ELSE 'approved' END AS status FROM c WHERE NOT EXISTS (SELECT 1 FROM financial_facts f WHERE f.concept = c.concept)")
def promotable_concepts(spark, d):
    """Concepts (approved or unmapped) that no stored fact knows, whatever the status of the stored ones."""
    c = entities.normalize(table(spark, d, "xbrl_company_facts")).withColumn("status", F.when(F.col("business_term_id").isNull(), "unmapped").otherwise("approved"))
    return entities.promotable(c, C._facts(spark, d), key="concept", ready=("approved", "unmapped"), stored_status=None).select("concept", "business_term_id", "status")


_SIX = ["cik", "concept", "unit", "end_date", "original_accession", "amendment_accession"]
_PAIR_COLS = ", ".join(_SIX)
_EARLY_PAIRS = _PAIRS.replace("p AS (SELECT", "pe AS (SELECT", 1).replace("FROM financial_facts WINDOW", "FROM (SELECT * FROM financial_facts WHERE filed_date <= DATE '2021-12-31') WINDOW").replace("\npairs AS", "\nold AS").replace("FROM p WHERE", "FROM pe WHERE")


@query(f"WITH {_PAIRS}, {_EARLY_PAIRS} SELECT DISTINCT {_PAIR_COLS} FROM pairs WHERE NOT EXISTS (SELECT 1 FROM old WHERE {' AND '.join(f'old.{c} IS NOT DISTINCT FROM pairs.{c}' for c in _SIX)})")
def new_amendment_pairs(spark, d):
    """Pairs of filings that aren't stored yet by all six parts of their grain; stored is what was known at the end of 2021."""
    f = C._facts(spark, d)
    now, old = (facts.amendments(x, order=C.ORDER) for x in (f, f.where("filed_date <= '2021-12-31'")))
    return new_rows(now, old, _SIX, null_safe=True).select(*_SIX).distinct()


# checks

_CHECKED = f"""WITH {_FIN}, {_RATIO}, conformed_facts AS MATERIALIZED ({R._CONFORM[0]} SELECT * FROM r WHERE k = 1), {R._PEER_CTES}"""


def _negative_sql() -> str:
    grain = "cik, business_term_id, fiscal_year, fiscal_period"
    per_share = ", ".join(f"'{t}'" for t, (u, _) in V.PRIORITIES.items() if u == "USD/shares")
    orphan = lambda c: f"SELECT count(*) FROM financial_ratios q WHERE NOT EXISTS (SELECT 1 FROM company_financials f WHERE f.cik = q.cik AND f.business_term_id = q.{c} AND f.fiscal_year = q.fiscal_year AND f.fiscal_period = q.fiscal_period)"
    parts = {
        "duplicate_grains": f"SELECT count(*) FROM (SELECT 1 FROM company_financials GROUP BY {grain} HAVING count(*) > 1)",
        "superseded_facts": "SELECT count(*) FROM conformed_facts WHERE fact_id IN (SELECT fact_id FROM financial_facts WHERE is_superseded)",
        "null_business_term": "SELECT count(*) FROM conformed_facts WHERE business_term_id IS NULL",
        "null_fiscal_year": "SELECT count(*) FROM conformed_facts WHERE fiscal_year IS NULL",
        "wrong_units": f"SELECT count(*) FROM conformed_facts WHERE unit IS DISTINCT FROM CASE WHEN business_term_id IN ({per_share}) THEN 'USD/shares' ELSE 'USD' END",
        "fiscal_year_collisions": "SELECT count(*) FROM (SELECT 1 FROM company_financials GROUP BY cik, business_term_id, period_end_date, fiscal_period HAVING count(DISTINCT fiscal_year) > 1)",
        "orphan_numerators": orphan("numerator_bt_id"),
        "orphan_denominators": orphan("denominator_bt_id"),
        "row_count_difference": "SELECT abs((SELECT count(*) FROM company_financials) - (SELECT count(*) FROM conformed_facts))",
        "duplicate_peer_rankings": "SELECT count(*) FROM (SELECT 1 FROM peer_comparison GROUP BY cik, metric_id, fiscal_year, fiscal_period, metric_source HAVING count(*) > 1)",
        "cross_zone_grains": "SELECT count(*) FROM company_financials f WHERE NOT EXISTS (SELECT 1 FROM conformed_facts c WHERE c.cik = f.cik AND c.business_term_id = f.business_term_id AND c.fiscal_year = f.fiscal_year AND c.fiscal_period = f.fiscal_period)",
    }
    return _CHECKED + " " + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", ({q})::BIGINT AS violations" for k, q in parts.items())


@query(_negative_sql())
def negative_checks(spark, d):
    """What must not be there, over the given tables and the conformed facts and peers derived from them."""
    t = R.tables(spark, d)
    t["conformed_facts"] = stage(t["conformed_facts"], "conformed")  # read several times
    return checks.negative(t, [b for b, (u, _) in V.PRIORITIES.items() if u == "USD/shares"])


@query(f"""{_CHECKED}, j AS (SELECT fin.business_term_id, fin.val AS e, c.val AS a FROM fin LEFT JOIN conformed_facts c ON c.cik = fin.cik AND c.business_term_id = fin.business_term_id AND c.fiscal_year = fin.fiscal_year AND c.fiscal_period = fin.fiscal_period WHERE fin.val IS NOT NULL),
s AS (SELECT business_term_id, CASE WHEN a IS NULL THEN 'MISSING' WHEN e <> 0 AND abs(a - e) / abs(e) * 100 < 1 OR e = 0 AND a = 0 THEN 'MATCH' WHEN e <> 0 AND abs(a - e) / abs(e) * 100 < 5 THEN 'CLOSE' ELSE 'MISMATCH' END AS status FROM j) SELECT business_term_id, status, count(*) AS n FROM s GROUP BY ALL""")
def golden_figures(spark, d):
    """The figures of company_financials as expected ones against those conformed from financial_facts: how many of each
    term match, are close, don't match or are missing."""
    got = checks.figures(C._fin(spark, d).where("val is not null"), facts.conform(C._facts(spark, d)))
    return got.groupBy("business_term_id", "status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def latest_results(spark, d):
    """The last result of each key (here the last event of each user and type)."""
    return checks.latest(table(spark, d, "events"), ["user_id", "event_type"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]).select("user_id", "event_type", "event_id", "value")


# coverage, sectors, ranks over all terms

@query(f"WITH {_FIN} SELECT business_term_id, cik, count(*) AS periods, min(fiscal_year) AS first_year, max(fiscal_year) AS last_year FROM fin WHERE val IS NOT NULL GROUP BY business_term_id, cik")
def coverage_matrix(spark, d):
    """Which company reports which term, for how many periods."""
    return C._fin(spark, d).where("val is not null").groupBy("business_term_id", "cik").agg(F.count(F.lit(1)).alias("periods"), F.min("fiscal_year").alias("first_year"), F.max("fiscal_year").alias("last_year"))


@query(f"""WITH {_FIN} SELECT sector, business_term_id, fiscal_year, fiscal_period, round(avg(val), 5) AS mean, list_sort(list(val))[(count(val) // 2 + 1)::INT] AS median, arg_min(cik, (-val, cik)) AS leader, arg_min(cik, (val, cik)) AS laggard, count(*) AS n FROM fin WHERE val IS NOT NULL GROUP BY ALL""")
def sector_summaries(spark, d):
    """get_sector_summary for every sector, term and period."""
    by = ["sector", "business_term_id", "fiscal_year", "fiscal_period"]
    return derived.group_stats(C._fin(spark, d), by, "val", "cik").select(*by, _round("mean"), "median", "leader", "laggard", "n")


@query(f"""WITH {_FIN} SELECT business_term_id, fiscal_year, fiscal_period, cik, val, row_number() OVER (PARTITION BY business_term_id, fiscal_year, fiscal_period ORDER BY val DESC, cik) AS "rank", count(*) OVER (PARTITION BY business_term_id, fiscal_year, fiscal_period) AS companies_included FROM fin WHERE val IS NOT NULL""")
def company_ranks(spark, d):
    """rank_companies for every term and period, uncut."""
    p = W.partitionBy("business_term_id", "fiscal_year", "fiscal_period")
    f = C._fin(spark, d).where("val is not null")
    return f.select("business_term_id", "fiscal_year", "fiscal_period", "cik", "val", F.row_number().over(p.orderBy(F.col("val").desc(), "cik")).cast("long").alias("rank"), F.count(F.lit(1)).over(p).alias("companies_included"))


_RAW = ["row_no", "cik", "entity_name", "taxonomy", "concept", "label", "unit", "start_date", "end_date", "accession_number", "fiscal_year", "fiscal_period", "form", "filed_date", "frame", "source_method", "load_date"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null, round(count(*) FILTER ({c} IS NULL) / count(*), 4) AS null_rate, count(DISTINCT {c}) AS n_distinct, arg_min({c}::VARCHAR, (-n, {c}::VARCHAR)) FILTER ({c} IS NOT NULL) AS commonest, max(n) FILTER ({c} IS NOT NULL) AS times, min(length({c}::VARCHAR)) AS min_length, max(length({c}::VARCHAR)) AS max_length FROM (SELECT {c}, count(*) OVER (PARTITION BY {c}) AS n FROM xbrl_company_facts)" for c in _RAW))
def profile_raw(spark, d):
    """Profile of the raw table's columns: nulls, distinct values, the commonest value (ties: the least) and lengths."""
    from tallystone.sources import filings

    p = filings.profile(table(spark, d, "xbrl_company_facts").select(*_RAW), top=1)
    top = F.from_json("top_values", "array<struct<value:string,n:long>>")[0]
    return p.select("column_name", F.col("n_null").cast("long").alias("n_null"), F.col("null_rate").cast("double").alias("null_rate"), "n_distinct", top["value"].alias("commonest"), top["n"].alias("times"), F.col("min_length").cast("long").alias("min_length"), F.col("max_length").cast("long").alias("max_length"))


@query("SELECT record_id, CASE WHEN ratio_value IS NULL THEN 'N/A' WHEN ratio_value < 0 THEN '(' || printf('%.1fx', abs(ratio_value)) || ')' ELSE printf('%.1fx', ratio_value) END AS multiple, CASE WHEN ratio_value IS NULL THEN 'N/A' WHEN ratio_value < 0 THEN '(' || printf('%.1f', abs(ratio_value * 100)) || '%)' ELSE printf('%.1f', ratio_value * 100) || '%' END AS percentage, CASE WHEN ratio_value IS NULL THEN 'N/A' WHEN ratio_value > 0 THEN '+' || printf('%.1f', ratio_value * 100) || '%' WHEN ratio_value < 0 THEN '-' || printf('%.1f', abs(ratio_value * 100)) || '%' ELSE printf('%.1f', ratio_value * 100) || '%' END AS yoy FROM (SELECT DISTINCT record_id, ratio_value FROM financial_ratios)")
def ratio_texts(spark, d):
    """Ratios as multiples, percentages and signed changes."""
    r = table(spark, d, "financial_ratios").select("record_id", "ratio_value").distinct()
    v = F.col("ratio_value")
    return r.select("record_id", formats.multiple(v).alias("multiple"), formats.percentage(v).alias("percentage"), formats.yoy(v).alias("yoy"))


@query("SELECT DISTINCT cik, entity_name, " + "trim(regexp_replace(array_to_string(list_transform(regexp_extract_all(lower(trim(entity_name)), '[a-z]+|[^a-z]+'), lambda t: CASE WHEN t[1] BETWEEN 'a' AND 'z' THEN upper(t[1]) || t[2:] ELSE t END), ''), '\\s+', ' ', 'g')) AS title FROM xbrl_company_facts WHERE entity_name IS NOT NULL")
def entity_titles(spark, d):
    """Names in title case."""
    return table(spark, d, "xbrl_company_facts").where("entity_name is not null").select("cik", "entity_name").distinct().withColumn("title", X.title_name(F.col("entity_name")))
