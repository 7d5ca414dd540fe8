from tallystone.operators import checks as K
from tallystone.operators import entities as E
from tallystone.plans.serving import Tools

KEY = "cik int, business_term_id string, fiscal_year int, fiscal_period string, val double"


def test_figures(spark):
    want = [(1, "a", 2020, "FY", 100.0), (1, "b", 2020, "FY", 100.0), (1, "c", 2020, "FY", -100.0), (1, "d", 2020, "FY", 0.0), (1, "e", 2020, "FY", 0.0), (1, "f", 2020, "FY", 5.0), (None, "a", 2020, "FY", 1.0)]
    have = [(1, "a", 2020, "FY", 100.9), (1, "b", 2020, "FY", 104.9), (1, "c", 2020, "FY", -95.0), (1, "d", 2020, "FY", 0.0), (1, "e", 2020, "FY", 1.0), (None, "a", 2020, "FY", 1.0)]
    got = {(r["cik"], r["business_term_id"]): r["status"] for r in K.figures(spark.createDataFrame(want, KEY), spark.createDataFrame(have, KEY)).collect()}
    assert got == {(1, "a"): "MATCH", (1, "b"): "CLOSE", (1, "c"): "MISMATCH", (1, "d"): "MATCH", (1, "e"): "MISMATCH", (1, "f"): "MISSING", (None, "a"): "MISSING"}


def test_latest_and_empty(spark):
    df = spark.createDataFrame([("r", 1, True), ("r", 2, False), ("s", 1, True), (None, 3, True)], "rule string, at int, passed boolean")
    assert sorted(map(str, K.latest(df, ["rule"], [df["at"].desc()]).collect())) == sorted(map(str, df.where("at = 2 or rule = 's' or rule is null").collect()))
    e = spark.createDataFrame([], KEY)
    assert K.repeated(e, K.GRAIN).first()[0] == 0 == K.absent(e, e, K.GRAIN).first()[0] == K.broken(e, e["val"].isNull()).first()[0]
    assert K.figures(e, e).collect() == []


def test_promotable(spark):
    p = spark.createDataFrame([(1, "approved"), (2, "approved"), (3, "pending"), (None, "approved"), (4, "rejected")], "cik int, status string")
    stored = spark.createDataFrame([(1, "approved"), (2, "rejected"), (3, "approved")], "cik int, status string")
    assert sorted((r["cik"] or 0) for r in E.promotable(p, stored).collect()) == [0, 2]
    assert sorted((r["cik"] or 0) for r in E.promotable(p, stored, stored_status=None).collect()) == [0]


def test_resolver(spark):
    fin = spark.createDataFrame([("BT-022", "Revenue"), ("BT-034", "Cost of Revenue"), ("BT-009", "Net Margin Base")], "business_term_id string, business_term string")
    rat = spark.createDataFrame([("RATIO-003", "Net Margin"), ("RATIO-001", "Gross Margin")], "ratio_id string, ratio_name string")
    t = Tools(spark, {"company_financials": fin, "financial_ratios": rat}, cache=False)
    assert t.resolve(" revenue ")[0] == "BT-022" and t.resolve("cost")[0] == "BT-034" and t.resolve("net margin")[0] == "RATIO-003"
    assert t.resolve("margin")[0] == "BT-009" and t.resolve("margin", "financial_ratios")[0] == "RATIO-001"
    assert t.resolve("bt-999") == ("BT-999", "bt-999", "company_financials") and t.resolve("ratio-001")[1] == "Gross Margin"
    try:
        t.resolve("nothing")
        raise AssertionError
    except ValueError as e:
        assert "Revenue" in str(e)
