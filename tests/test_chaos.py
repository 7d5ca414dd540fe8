import json
import os

import pytest
from pyspark.sql import functions as F

from tallystone.operators import governance as G
from tallystone.operators import rules
from tallystone.runtime import table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def clean(spark):
    x = table(spark, DATA, "xbrl_company_facts")
    parts = [x.withColumn("row_no", F.col("row_no") * 10 + k) for k in range(10)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.cache()


def test_every_strategy_is_drawn_and_does_what_it_says(spark, clean):
    bad = G.corruptions(clean, 0.10, 3).cache()
    n = clean.count()
    assert 0.08 * n < bad.count() < 0.12 * n and bad.select("chaos_id").distinct().count() == bad.count()
    drawn = {(r[0], r[1]) for r in bad.select("chaos_dimension", "chaos_strategy").distinct().collect()}
    assert {d for d, _ in drawn} == set(G.DIMENSIONS) and all(s in G.STRATEGIES[d] for d, s in drawn)
    assert len(drawn) > 0.8 * sum(len(x) for x in G.STRATEGIES.values())
    was = {r["row_no"]: r for r in clean.collect()}
    for r in bad.collect():
        fields = [x for x in r["chaos_fields"].split(",") if x]
        assert fields == list(G.STRATEGIES[r["chaos_dimension"]][r["chaos_strategy"]])
        for c in clean.columns:
            if c not in fields:
                assert str(r[c]) == str(was[r["row_no"]][c])
        after = {x["field"]: x.get("value") for x in json.loads(r["chaos_after"])}
        assert set(after) == set(fields)
        if r["chaos_strategy"].startswith("null_"):
            assert r[fields[0]] is None and after[fields[0]] is None
        if r["chaos_strategy"] == "penny_value":
            assert r["val"] == 0.01
        if r["chaos_strategy"] == "end_date_filed_gap" and was[r["row_no"]]["filed_date"]:
            assert (r["end_date"] - was[r["row_no"]]["filed_date"]).days == 4000


def test_a_row_can_be_drawn_more_than_twice(spark, clean):
    few = clean.limit(12)
    bad = G.corruptions(few, 0.10, 1)
    assert {r["n"] for r in bad.groupBy("chaos_dimension").agg(F.count(F.lit(1)).alias("n")).collect() if r["n"] < G.LEAST_EACH} == set()
    assert max(r["count"] for r in bad.groupBy("chaos_dimension", "row_no").count().collect()) >= 2
    assert sorted(map(str, bad.collect())) == sorted(map(str, G.corruptions(few, 0.10, 1).collect()))


def test_manifest_report_and_teardown(spark, clean, tmp_path):
    bad = G.corruptions(clean, 0.05, 5)
    head, lines = G.manifest(bad, "raw.xbrl_company_facts", clean.count(), 0.05, "chaos-0001", "2026-05-01T00:00:00")
    folder = f"{tmp_path}/shadow/manifests"
    assert G.latest_manifest(spark, folder) is None
    path = G.write_manifest(folder, head, lines)
    G.write_manifest(folder, head | {"run_id": "chaos-0002"}, lines)
    assert G.latest_manifest(spark, folder).endswith("chaos-0002")
    got, rows = G.read_manifest(spark, path)
    assert got == head and all(got["dimension_coverage"].values()) and rows.count() == got["injected_row_count"] == bad.count()
    results = [rules.Result("R-1", "s", "Validity", "P0", False, 3, "result = 0"), rules.Result("R-2", "s", "Coverage", "P1", True, 0, "result = 0")]
    r = G.reconcile(bad, results)
    text = G.report(r, head, lines, results)
    assert "chaos-0001" in text and "R-1 (P0, Validity)" in text and "no rule catches full_row_duplicate" in text and "no rule catches inject_nan" not in text
    assert all(f.nullable for f in G.relaxed(clean.schema))
    with pytest.raises(G.Refused):
        G.teardown(spark, str(tmp_path) + "/other")
    assert G.teardown(spark, f"{tmp_path}/shadow") and not os.path.exists(f"{tmp_path}/shadow")
    assert G.shadow(clean, bad).where("chaos_id is null").count() == clean.count()
