import datetime as dt
import random

from tallystone.operators import asof as A

FACT = "fact_id string, cik int, concept string, unit string, end_date date, filed_date date, accession_number string, promoted_at timestamp, val double, request_id long"
REQ = "request_id long, cik int, concept string, unit string, requested_at timestamp, channel string"
D = dt.date
T = dt.datetime


def data(seed=5, n=400):
    r = random.Random(seed)
    cik = lambda: 1 if r.random() < 0.5 else r.choice([2, 3, None])
    facts = [(f"f{r.randrange(n)}", cik(), r.choice(["Assets", "us-gaap:Assets", "a ssets", "Debt", None]), r.choice(["USD", "usd", "iso:USD"]), r.choice([D(2020, 3, 31), D(2020, 6, 30), D(2020, 9, 30), None]), r.choice([None] + [D(2020, 1, 1) + dt.timedelta(days=k) for k in range(0, 400, 37)]), r.choice(["a", "b", None]), T(2021, 1, 1), 1.0, 0) for _ in range(n)]
    reqs = [(i, cik(), r.choice(["ASSETS", "Debt", None]), "USD", r.choice([None, T(2020, 1, 1) + dt.timedelta(days=r.randrange(450), hours=23)]), None) for i in range(n)]
    return facts, reqs


def norm(x):
    return None if x is None else "".join(x.split(":", 1)[-1].split()).upper()


def brute(facts, reqs):
    out = {}
    low = lambda x: (x is not None, x or "") if not isinstance(x, D) else (True, x.isoformat())
    for i, cik, c, u, at, _ in reqs:
        if None in (cik, c, u, at):
            continue
        ok = [f for f in facts if f[1] == cik and norm(f[2]) == norm(c) and norm(f[3]) == norm(u) and f[5] and f[5] <= at.date()]
        if ok:
            out[i] = max(ok, key=lambda f: (low(f[4]), low(f[5]), low(f[6]), low(f[0])))[0]
    return out


def test_found_is_brute_force(spark):
    facts, reqs = data()
    got = A.found(spark.createDataFrame(reqs, REQ), spark.createDataFrame(facts, FACT)).collect()
    assert {r["request_id"]: r["fact_id"] for r in got} == brute(facts, reqs)
    assert len(got) == len(brute(facts, reqs))


def test_hot_key_is_split(spark):
    facts, reqs = data(7)
    from pyspark.sql import functions as F

    from tallystone.functions.names import spelling

    names = [F.col("cik").cast("string"), spelling(F.col("concept")), spelling(F.col("unit"))]
    states = A.versions(spark.createDataFrame(facts, FACT), names, F.col("filed_date"), ["end_date", "filed_date", "accession_number"], "fact_id")
    got = A.join(spark.createDataFrame(reqs, REQ), names, F.to_date("requested_at"), "request_id", states, per_task=15).collect()
    assert sorted(r["event_id"] for r in got) == [r[0] for r in reqs]  # each event once, also those without a state
    assert {r["event_id"]: r["value"] for r in got if r["value"]} == brute(facts, reqs)


def test_empty(spark):
    facts, reqs = data(9, 20)
    assert A.found(spark.createDataFrame([], REQ), spark.createDataFrame(facts, FACT)).collect() == []
    assert A.found(spark.createDataFrame(reqs, REQ), spark.createDataFrame([], FACT)).collect() == []


def test_values(spark):
    facts, reqs = data(11, 50)
    got = A.values(spark.createDataFrame(reqs, REQ), spark.createDataFrame(facts, FACT)).collect()
    assert len(got) == len(brute(facts, reqs)) and all(r["val"] == 1.0 for r in got)
