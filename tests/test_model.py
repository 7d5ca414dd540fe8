import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.functions import formats
from tallystone.operators import bitemporal, derived, entities, facts

D = dt.date
FACT = "fact_id string, cik int, concept string, unit string, start_date date, end_date date, val double, accession_number string, filed_date date, form string, fiscal_period string, fiscal_year int, fiscal_year_end string, business_term_id string, tier int, is_superseded boolean, superseded_by string"


def fact(**x):
    base = dict(fact_id="f1", cik=1, concept="Assets", unit="USD", start_date=D(2023, 1, 1), end_date=D(2023, 12, 31), val=1000.0, accession_number="a1", filed_date=D(2024, 2, 15), form="10-K", fiscal_period="FY", fiscal_year=2023, fiscal_year_end="1231", business_term_id="BT-024", tier=1, is_superseded=False, superseded_by=None)
    return tuple((base | x).values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


def test_supersession_and_amendments(spark):
    f = frame(spark, fact(), fact(fact_id="f2", accession_number="a2", filed_date=D(2024, 5, 1), val=900.0), fact(fact_id="f3", start_date=None), fact(fact_id="f4", start_date=None, accession_number="a4", filed_date=D(2024, 6, 1), val=0.0))
    got = {r["fact_id"]: (r["is_superseded"], r["superseded_by"]) for r in facts.supersede(f).collect()}
    assert got == {"f1": (True, "a2"), "f2": (False, None), "f3": (True, "a4"), "f4": (False, None)}
    a = {r["original_accession"]: (r["val_change"], r["val_change_pct"]) for r in facts.amendments(f.where("start_date is not null")).collect()}
    assert a == {"a1": (-100.0, -10.0)}
    assert facts.amendments(frame(spark, fact(val=0.0), fact(fact_id="x", accession_number="b", filed_date=D(2025, 1, 1)))).first()["val_change_pct"] is None


def test_trailing_twelve_months(spark):
    f = frame(spark, fact(), fact(fact_id="f2", start_date=D(2022, 10, 1), end_date=D(2023, 9, 30), accession_number="a2"), fact(fact_id="f3", cik=2, fiscal_year_end=None), fact(fact_id="f4", cik=2, fiscal_year_end=None, start_date=D(2022, 10, 1)))
    got = {r["fact_id"]: (r["is_superseded"], r["superseded_by"]) for r in facts.prefer_fiscal_year(f).collect()}
    assert got == {"f1": (False, None), "f2": (True, "a1"), "f3": (False, None), "f4": (False, None)}


def test_conform_reasons(spark):
    rows = [fact(), fact(fact_id="f2", cik=2, concept="Other"), fact(fact_id="f3", cik=2, accession_number="zz"), fact(fact_id="f4", cik=3, concept="A", tier=2), fact(fact_id="f5", cik=3, concept="B", tier=1), fact(fact_id="f6", cik=4, unit="EUR"), fact(fact_id="f7", cik=5, is_superseded=True), fact(fact_id="f8", cik=6, business_term_id="CDE-007"), fact(fact_id="f9", cik=7, fiscal_year=None), fact(fact_id="fa", cik=8, business_term_id=None)]
    got = {r["cik"]: (r["fact_id"], r["selection_reason"], r["competing_fact_count"], r["business_term_id"]) for r in facts.conform(frame(spark, *rows)).collect()}
    assert got == {1: ("f1", "sole_candidate", 1, "BT-024"), 2: ("f3", "primary_concept", 2, "BT-024"), 3: ("f5", "tier_frequency_fallback", 2, "BT-024"), 6: ("f8", "sole_candidate", 1, "BT-024")}


def test_calendar_and_derivations(spark):
    c = facts.fiscal_calendar(frame(spark, fact(start_date=None), fact(fact_id="b"))).first()
    assert (c["period_start"], c["period_end"], c["duration_days"], c["is_annual"]) == (D(2023, 1, 1), D(2023, 12, 31), 364, True)
    rows = spark.createDataFrame([(D(2023, 10, 1), "0930"), (D(2023, 9, 30), "0930"), (D(2023, 10, 1), ""), (D(2023, 10, 1), None), (D(2024, 1, 3), "1231")], "e date, y string")
    assert [r[0] for r in rows.select(X.fiscal_year(F.col("e"), F.col("y"))).collect()] == [2024, 2023, 2023, 2023, 2024]
    p = spark.createDataFrame([(D(2023, 1, 1), D(2023, 12, 31), "Q4"), (None, D(2023, 3, 31), None), (D(2023, 1, 1), D(2023, 3, 31), ""), (D(2023, 1, 1), D(2023, 3, 31), "Q1")], "s date, e date, p string")
    assert [r[0] for r in p.select(X.fiscal_period(F.col("s"), F.col("e"), F.col("p"))).collect()] == ["FY", "FY", "FY", "Q1"]
    n = spark.createDataFrame([("jp-morgan  chase",), ("o'neil",), ("3m co",)], "n string")
    assert [r[0] for r in n.select(X.title_name(F.col("n"))).collect()] == ["Jp-Morgan Chase", "O'Neil", "3M Co"]


FIN = "cik int, business_term_id string, fiscal_year int, fiscal_period string, sector string, val double"


def test_ratios(spark):
    rows = [(1, "BT-035", 2023, "FY", "T", 40.0), (1, "BT-022", 2023, "FY", "T", 100.0), (1, "BT-043", 2023, "FY", "T", -5.0), (2, "BT-023", 2023, "FY", "T", 5.0), (2, "BT-022", 2023, "FY", "T", 0.0), (3, "BT-043", 2023, "FY", "T", 5.0), (3, "BT-022", 2023, "FY", "T", -10.0), (4, "BT-027", 2023, "FY", "T", 5.0), (4, "BT-028", 2023, "FY", "T", -10.0)]
    got = {(r["cik"], r["ratio_id"]): r["ratio_value"] for r in derived.ratios(spark.createDataFrame(rows, FIN)).collect()}
    assert got == {(1, "RATIO-001"): 0.4, (1, "RATIO-007"): 0.05, (4, "RATIO-004"): -0.5}


def test_growth(spark):
    rows = [(1, "BT-022", y, "FY", "T", v) for y, v in ((2018, 100.0), (2019, 110.0), (2021, 50.0), (2023, -100.0), (2024, 0.0), (2025, 5.0))]
    got = {(r["fiscal_year"], r["growth_type"]): r["growth_value"] for r in derived.growth(spark.createDataFrame(rows, FIN)).collect()}
    assert got[2019, "yoy_change"] == 10 and math.isclose(got[2019, "yoy_pct_change"], 0.1)
    assert (2021, "yoy_change") not in got  # 2020 is missing
    assert math.isclose(got[2023, "cagr_5yr"], -2.0) and math.isclose(got[2024, "cagr_5yr"], -1.0)
    assert got[2024, "yoy_change"] == 100 and got[2024, "yoy_pct_change"] == 1 and (2025, "yoy_pct_change") not in got


def test_peers(spark):
    rows = [(1, "m", 2023, "FY", "T", 10.0), (2, "m", 2023, "FY", "T", 10.0), (3, "m", 2023, "FY", "T", -4.0), (4, "m", 2023, "FY", "T", 2.0), (5, "m", 2023, "FY", "E", 1.0), (6, "m", 2023, "FY", "T", None)]
    got = {r["cik"]: (r["sector_rank"], r["sector_median"], r["peer_count"], round(r["sector_percentile"], 4)) for r in derived.peers(spark.createDataFrame(rows, FIN), ["sector", "business_term_id", "fiscal_year", "fiscal_period"]).collect()}
    assert got == {1: (1, 6.0, 4, 1.0), 2: (1, 6.0, 4, 1.0), 4: (2, 6.0, 4, 0.6667), 3: (3, 6.0, 4, 0.3333)}


def test_amendment_stats(spark):
    rows = [(1, "A", D(2020, 3, 31), "x", D(2020, 5, 1), D(2020, 6, 1), -10.0, None), (1, "B", D(2020, 6, 30), "y", D(2020, 5, 1), D(2020, 5, 11), 10.0, 50.0)]
    s = derived.amendment_stats(spark.createDataFrame(rows, "cik int, concept string, end_date date, amendment_accession string, original_filed_date date, amendment_filed_date date, val_change double, val_change_pct double")).first()
    assert (s["fiscal_year"], s["amendment_count"], s["median_abs_change"], s["mean_abs_pct"], s["most_changed_concept"], s["avg_days_to_amend"]) == (2020, 2, 10.0, 50.0, "A", 20.5)


def test_bitemporal(spark):
    f = frame(spark, fact(), fact(fact_id="f2", accession_number="a2", filed_date=D(2024, 5, 1), val=900.0, is_superseded=True, superseded_by="nope"), fact(fact_id="f3", end_date=D(2022, 12, 31), start_date=D(2022, 1, 1), val=500.0))
    assert bitemporal.as_known_on(f, "2024-03-01").where("end_date = '2023-12-31'").first()["fact_id"] == "f1"
    assert bitemporal.as_known_on(f, "2024-05-01").where("end_date = '2023-12-31'").first()["fact_id"] == "f2"
    assert [r["fact_id"] for r in bitemporal.history(f, 1, "Assets", "2023-01-01", "2023-12-31").collect()] == ["f1", "f2"]
    assert bitemporal.history(f, 1, "Assets", None, "2023-12-31").count() == 0
    c = bitemporal.compare(f, "2022-12-31", "2023-12-31").first()
    assert (c["change"], float(c["pct_change"])) == (500.0, 100.0)
    v = {r["check"]: (r["violations"], r["passed"]) for r in bitemporal.validate(f, "2024-03-01").collect()}
    assert v["future_filed"] == (1, False) and v["unknown_successor"] == (1, False) and v["start_not_before_end"] == (0, True)
    assert all(r["passed"] for r in bitemporal.validate(f.limit(0)).collect())


def test_formats(spark):
    cases = [(394.25e9, "USD", "$394.2B"), (-1.25e9, "USD", "($1.2B)"), (0.25, "percentage", "25.0%"), (-0.5, None, "(50.0%)"), (1.5, "USD/shares", "$1.50"), (2.675, "ratio", "2.7x"), (12.0, None, "12.00"), (5000.0, None, "$5.0K"), (None, "USD", "N/A"), (999.0, "USD", "$999.00")]
    df = spark.createDataFrame([(v, u) for v, u, _ in cases], "v double, u string")
    assert [r[0] for r in df.select(formats.value(F.col("v"), F.col("u"))).collect()] == [t for *_, t in cases]
    y = spark.createDataFrame([(0.078,), (-0.02,), (0.0,)], "v double")
    assert [r[0] for r in y.select(formats.yoy(F.col("v"))).collect()] == ["+7.8%", "-2.0%", "0.0%"]
    d = spark.createDataFrame([("0131", "1231"), ("0930", "1231"), ("0930", "x"), (None, "1231")], "a string, b string")
    assert [r[0] for r in d.select(formats.year_end_distance(F.col("a"), F.col("b"))).collect()] == [30, 91, None, None]
    a = spark.createDataFrame([(-1.0, "Total Stockholders Equity", 2.5, "Debt-to-Equity", -2.0, "X"), (60.0, None, None, "Debt-to-Equity", None, None), (None, "Revenue", 9.0, None, None, None), (-3.0, "Revenue", None, None, None, None)], "v double, m string, y double, r string, n double, s string")
    got = [r[0] for r in a.select(formats.anomaly_flags(*[F.col(c) for c in "vmyrns"])).collect()]
    assert got == [["extreme_yoy", "negative_equity", "pre_profitability"], ["extreme_leverage"], [], ["negative_revenue"]]


@pytest.mark.parametrize(("pcts", "label"), [([0.1], "insufficient_data"), ([0.1, -0.1, 0.1], "volatile"), ([0.1, 0.2, 0.3, -0.1], "growing"), ([-0.1, -0.2], "declining"), ([0.0, 0.005], "stable")])
def test_trend(spark, pcts, label):
    assert spark.createDataFrame([(pcts,)], "p array<double>").select(X.trend(F.col("p"))).first()[0] == label


def test_entities(spark):
    raw = spark.createDataFrame([(2, "b co"), (2, "b co"), (2, "B CO"), (1, "x"), (1, "a"), (None, "n")], "cik int, entity_name string")
    got = [tuple(r) for r in entities.resolve(raw).select("mapping_id", "cik", "canonical_name", "confidence").orderBy("cik").collect()]
    assert got == [("ER-001", 1, "A", 0.5), ("ER-002", 2, "B Co", 0.5)]
    c = spark.createDataFrame([(x,) for x in ("Assets", "InventoryGross", "DeferredRevenueX", "RevenueRecognized", "LeaseCost", "Zzz")], "c string")
    got = [(r[0]["business_term_id"], r[0]["tier"], r[0]["category"]) for r in c.select(entities.classify(F.col("c"))).collect()]
    assert got == [("BT-024", 1, "assets"), ("BT-031", 2, "inventory"), ("BT-022", 2, "revenue"), ("BT-022", 2, "revenue"), (None, 3, "leases"), (None, 3, "uncategorized")]
    p = spark.createDataFrame([("a", 0.9, "pending"), ("b", 0.5, "pending"), ("c", 0.9, "approved")], "mapping_id string, confidence double, status string")
    assert [r["decision"] for r in entities.gate(p, require_human=False).collect()] == ["auto", "review", "auto"]
    assert {r["decision"] for r in entities.gate(p).collect()} == {"review"}
    assert [r["status"] for r in entities.decide(p, "approved", "me", ["a", "c"]).collect()] == ["approved", "pending", "approved"]
    assert entities.audit(p, "mapping_id", "promoted", "me", "2026-01-01 00:00:00").count() == 3


def test_hot_grains_are_split_without_a_change(spark):
    import random

    from tallystone.operators import facts as M

    r = random.Random(3)
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(days=k)
    rows = [(1 if r.random() < 0.6 else r.randrange(2, 40), "Assets", "USD", r.choice([day(0), day(1), None]), day(360 + r.randrange(2)), day(400 + r.randrange(30)), r.choice("ab"), f"f{r.randrange(400)}", r.choice(["10-K", None]), float(r.randrange(9)), 2020, "FY", "1231") for _ in range(1500)]
    df = spark.createDataFrame(rows, "cik int, concept string, unit string, start_date date, end_date date, filed_date date, accession_number string, fact_id string, form string, val double, fiscal_year int, fiscal_period string, fiscal_year_end string")
    canon = lambda x: sorted(map(str, x.collect()))
    one = M.supersede(df)
    assert canon(one) == canon(M.supersede(df, per_task=50))
    assert sum(not x["is_superseded"] for x in one.collect()) == df.select(*M.GRAIN).distinct().count()
    order = [*M.ORDER, "val", "form"]
    assert canon(M.amendments(df, order=order)) == canon(M.amendments(df, order=order, per_task=50))
    cols = ["cik", "start_date", "end_date", "is_superseded", "superseded_by"]
    assert canon(M.prefer_fiscal_year(one).select(*cols)) == canon(M.prefer_fiscal_year(one, per_task=20).select(*cols))
