"""Every query with SQL against DuckDB on the smallest tables, as the driver does at a larger scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallystone.plans import catalog, problems, product_queries, rule_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
ALL = (catalog, problems, product_queries, rule_queries)
SQL = {n: q for m in ALL for n, q in m.SQL.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def canon(rows):
    return sorted(tuple("NULL" if x is None else format(x, ".9g") if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_is_its_sql(spark, duck, name):
    df = next(m.QUERIES[name] for m in ALL if name in m.QUERIES)(spark, DATA)
    cols = sorted(df.columns)
    want = duck.execute("SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({SQL[name]})").fetchall()
    assert canon(df.select(*[f"`{c}`" for c in cols]).collect()) == canon(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for n, cols in {"p1_found": ["finding", "column_name", "item_key"], "p2_found": ["file_no", "cik", "taxonomy", "concept", "unit", "obs_no"], "p3_found": ["table_name", "column_name", "record_id", "kind"], "p5_found": ["request_id", "fact_id"], "p6_found": ["row_no", "kind"]}.items():
        assert entry.queries()[n](spark, DATA).columns == cols


def test_pipeline_and_tools(spark, tmp_path):
    from tallystone.plans import pipeline, serving
    from tallystone.runtime import table
    from tallystone.sources.store import VersionedTable

    raw = table(spark, DATA, "xbrl_company_facts").where("fiscal_year between 2015 and 2024")
    done = pipeline.build(spark, str(tmp_path), raw, None, table(spark, DATA, "business_terms"), "2026-05-01 00:00:00")
    assert list(done) == list(pipeline.KEYS) and done["base.financial_facts"]["rows"] > 0
    t = {n: VersionedTable(spark, str(tmp_path), f"consumable.{n}").read() for n in serving.TABLES}
    fin = t.pop("company_financials")
    tools = serving.Tools(spark, t | {"company_financials": fin.withColumn("ticker", fin["cik"].cast("string"))})
    assert tools.missing == [] and tools.row_counts()["company_financials"] == done["consumable.company_financials"]["rows"]
    row = fin.where("fiscal_period = 'FY'").orderBy("cik", "business_term_id").first()
    name, who = row["business_term"], str(row["cik"])
    top = tools.rank_companies(name, top_n=2)
    assert top["companies_included"] >= 1 and top["ranking"][0]["rank"] == 1
    assert tools.get_company_metric(who, name)["business_term"] == name
    assert tools.get_company_profile(who)["metrics"]
    assert tools.get_company_trend(who, row["business_term_id"])["series"]
    assert tools.get_sector_summary("Unknown", row["fiscal_year"], name)["metrics"][0]["n"] >= 1
    assert "error" in tools.get_company_metric("x", name) and "error" in tools.get_ratio("x", "no such") and "error" in tools.compare_companies("x", "y")
    assert {"get_company_metric", "get_company_profile", "compare_companies", "rank_companies", "get_company_trend", "get_sector_summary", "get_ratio", "get_amendment_summary"} == set(tools.registry()) == {x["name"] for x in serving.schemas()}
    tools.reset()
