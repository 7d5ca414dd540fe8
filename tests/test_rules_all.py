"""Rules that DuckDB can't read or that ask for the day, against brute force on rows that violate each."""

import datetime as dt
import math
import os
import re

import pytest
from pyspark.sql import functions as F

from tallystone.plans import catalog
from tallystone.runtime import table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_all_rules_of_the_tables_are_answered(spark, tmp_path):
    raw, facts = table(spark, DATA, "xbrl_company_facts"), table(spark, DATA, "financial_facts")
    few = raw.limit(8)
    bad = [
        few.withColumn("accession_number", F.lit("12-3")), few.limit(3).withColumn("val", F.lit(float("nan"))), few.limit(2).withColumn("val", F.lit(float("-inf"))), few.limit(4).withColumn("filed_date", F.lit(dt.date(2026, 5, 2))),
        few.limit(5).withColumn("fiscal_year", F.lit(2028)), few.limit(1).withColumn("fiscal_year", F.lit(1989)), few.limit(6).withColumn("ingested_at", F.lit("2026-05-01 01:00:01").cast("timestamp")), few.limit(7).withColumn("ingested_at", F.lit("2026-05-01 01:00:00").cast("timestamp")),
    ]
    for b in bad:
        raw = raw.unionByName(b.select(*[F.col(c).cast(raw.schema[c].dataType).alias(c) for c in raw.columns]))
    facts = facts.unionByName(facts.limit(9).withColumn("filed_date", F.lit(dt.date(2026, 5, 2))))
    for t in catalog._TABLES.values():
        {"xbrl_company_facts": raw, "financial_facts": facts}.get(t, table(spark, DATA, t)).write.parquet(f"{tmp_path}/{t}.parquet")
    got = {r["rule_id"]: r["raw_value"] for r in catalog.QUERIES["dq_rules_all"](spark, str(tmp_path)).collect()}
    rows, today = table(spark, str(tmp_path), "xbrl_company_facts").collect(), dt.date(2026, 5, 1)
    late = spark.read.parquet(f"{tmp_path}/xbrl_company_facts.parquet").where("ingested_at > '2026-05-01 01:00:00'").count()
    want = {
        "RAW-CF-004": sum(x["accession_number"] is not None and not re.fullmatch("[0-9]{10}-[0-9]{2}-[0-9]{6}", x["accession_number"]) for x in rows),
        "RAW-CF-005": sum(x["filed_date"] is not None and x["filed_date"] > today for x in rows),
        "RAW-CF-006": sum(x["val"] is not None and not math.isfinite(x["val"]) for x in rows),
        "RAW-CF-008": 0,
        "RAW-CF-021": sum(x["fiscal_year"] is not None and not 1990 <= x["fiscal_year"] <= 2027 for x in rows),
        "RAW-CF-022": late,
        "BASE-BT-001": sum(x["filed_date"] is not None and x["filed_date"] > today for x in table(spark, str(tmp_path), "financial_facts").collect()),
    }
    assert all(want[r] > 0 for r in want if r != "RAW-CF-008")
    assert {r: got[r] for r in want} == want
    assert set(want) == catalog._SKIP and set(got) == {r.rule_id for r in catalog._testable()} | set(want)


def test_a_table_without_recent_filings_is_stale(spark, tmp_path):
    for t in catalog._TABLES.values():
        x = table(spark, DATA, t)
        (x.where("filed_date < '2024-05-01'") if t == "xbrl_company_facts" else x).write.parquet(f"{tmp_path}/{t}.parquet")
    got = catalog.QUERIES["dq_rules_all"](spark, str(tmp_path)).where("rule_id = 'RAW-CF-008'").collect()
    assert [r["raw_value"] for r in got] == [1.0]


def test_passes_shared_by_rules_change_no_value(spark):
    both = {r["rule_id"]: r["raw_value"] for r in catalog.QUERIES["dq_rules_all"](spark, DATA).collect()}
    alone = {r["rule_id"]: r["raw_value"] for r in catalog.QUERIES["dq_rules"](spark, DATA).collect()}
    assert len(alone) == 56 and {r: both[r] for r in alone} == alone
