import datetime as dt
import random

from pyspark.sql import functions as F

from tallystone.operators import profile as P

SCHEMA = "row_no long, load_date date, fiscal_period string, form string, start_date date, end_date date, filed_date date, expression string"
D = dt.date


def rows(n=600, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        load = D(2025, 1, 1 + i % 3)
        fp = r.choice(["Q1", "Q2", "Q3", "Q4", "FY"]) if load.day != 2 or r.random() > 0.3 else None
        form = r.choice(["10-K", "10-Q"]) if load.day != 3 else r.choice(["20-F", "10-Q", "20-F"])
        end = D(2020, 1, 1) + dt.timedelta(days=r.randrange(900))
        start, filed = end - dt.timedelta(days=90), end + dt.timedelta(days=40)
        k = r.random()
        if k < 0.01:
            fp = r.choice(["Q5", "q1", " Q1", ""])
        elif k < 0.02:
            form = r.choice([None, "10-k", "8K"])
        elif k < 0.03:
            end = r.choice([None, D(1970, 1, 1), filed + dt.timedelta(days=1)])
        elif k < 0.04:
            start = filed
        out.append((i, load, fp, form, start, end, filed, "extra"))
    return out


def brute(data):
    bad = set()
    for i, _, fp, form, start, end, filed, _ in data:
        if fp is not None and fp not in P.PERIODS:
            bad.add(("violation", "fiscal_period", str(i)))
        if form is None or form not in P.FORMS:
            bad.add(("violation", "form", str(i)))
        if end is None or end < D(1993, 1, 1) or end > filed or end < start:
            bad.add(("violation", "end_date", str(i)))
    value = {"fiscal_period": lambda r: r[2], "form": lambda r: r[3], "end_date": lambda r: r[5] and r[5].year}
    for load in {r[1] for r in data}:
        for c, v in value.items():
            mine, rest = [v(r) for r in data if r[1] == load], [v(r) for r in data if r[1] != load]
            if abs(mine.count(None) / len(mine) - rest.count(None) / len(rest)) > 0.05:
                bad.add(("nulls", c, str(load)))
            a, b = [x for x in mine if x is not None], [x for x in rest if x is not None]
            if sum(abs(a.count(x) / len(a) - b.count(x) / len(b)) for x in set(a + b)) / 2 > 0.25:
                bad.add(("shift", c, str(load)))
    return bad


def test_found_is_brute_force(spark):
    data = rows()
    data += data[:40]  # repeated rows
    got = [tuple(r) for r in P.found(spark.createDataFrame(data, SCHEMA)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(data)


def test_empty_and_single_load(spark):
    assert P.found(spark.createDataFrame([], SCHEMA)).collect() == []
    one = [r[:1] + (D(2025, 1, 1),) + r[2:] for r in rows(50)]
    assert {r[0] for r in P.found(spark.createDataFrame(one, SCHEMA)).collect()} <= {"violation"}


def test_expressions(spark):
    e = {(r["column_name"], r["expression"]): r["conforming"] for r in P.expressions(spark.createDataFrame(rows(), SCHEMA), P.SPECS).collect()}
    assert e["fiscal_period", "Q(1|2|3|4)"] and not e["fiscal_period", "Q[0-9]"]  # Q5 is rare by itself
    assert e["end_date", "(2020|2021|2022)-[0-9]{2}-[0-9]{2}"] and not any(ok for (c, x), ok in e.items() if c == "end_date" and "2020" not in x)
    r = random.Random(4)
    text = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) + "-" + "".join(r.choice("0123456789") for _ in range(m)) for n in range(1, 31) for m in range(1, 31)]
    many = spark.createDataFrame([(D(2025, 1, 1), x) for x in text + ["a" * 5000, "a-1-b" * 300, "\n", ""]], "load_date date, code string")
    got = {x["expression"]: (x["conforming"], x["n_rows"]) for x in P.expressions(many, [P.Spec("code")]).collect()}
    assert got["[a-z]+-[0-9]+"] == (True, len(text)) and sum(n for _, n in got.values()) == len(text) + 4
    assert sum(ok for ok, _ in got.values()) == 1


def test_induction_decides(spark, monkeypatch):
    """Without expressions there are no violations; with everything established there are none either."""
    df = spark.createDataFrame(rows(), SCHEMA)
    want = {x for x in brute(rows()) if x[0] == "violation"}
    nulls = {("violation", c, str(r[0])) for r in rows() for c, v in (("form", r[3]), ("end_date", r[5])) if v is None}
    violations = lambda: {tuple(r) for r in P.found(df).collect() if r["finding"] == "violation"}
    assert violations() == want
    monkeypatch.setattr(P, "COST", 60.0)
    monkeypatch.setattr(P, "CHANCE", 0.0)
    assert nulls <= violations() < want


def test_coverage_changes_between_loads(spark):
    data = [(D(2025, 1, 1 + k % 3), f"A-{k:04d}" if k % 3 or k % 2 else f"a{k}") for k in range(600)]
    p = {str(r["load_date"]): r for r in P.profile(spark.createDataFrame(data, "load_date date, code string"), [P.Spec("code")]).collect()}
    assert abs(p["2025-01-01"]["expression_distance"] - 0.5) < 0.01 and p["2025-01-02"]["expression_distance"] < 0.3
    assert all(r["shift"] > 0.999 for r in p.values())  # values alone don't tell


def test_profile_all_kinds(spark):
    df = spark.createDataFrame([(D(2025, 1, 1), 1.5, "a"), (D(2025, 1, 2), None, "x" * 5000), (D(2025, 1, 2), float("nan"), "")], "load_date date, v double, t string")
    got = {(r["column_name"], str(r["load_date"])): r for r in P.profile(df, [P.Spec("v"), P.Spec("t")]).collect()}
    assert len(got) == 4
    assert got["v", "2025-01-02"]["null_share"] == 0.5
    assert got["t", "2025-01-02"]["n_distinct"] == 2
    assert P.profile(df.where(F.lit(False)), [P.Spec("v")]).collect() == []
