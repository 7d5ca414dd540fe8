import datetime as dt
import random

import numpy as np
import pytest

from tallystone.operators import orphans as O

D = dt.date
FIN = "record_id string, cik int, fiscal_year int, fiscal_period string, load_date date, business_term_id string, term string"
RAT = "record_id string, cik int, fiscal_year int, fiscal_period string, load_date date, numerator_bt_id string, denominator_bt_id string, found string"
TERM = "business_term_id string, legacy_id string, added_on date, retired_on date"
TERMS = [("BT-1", "CDE-1", D(2020, 1, 1), None), ("BT-2", None, D(2020, 1, 1), D(2025, 6, 1)), ("BT-3", "CDE-3", D(2025, 6, 1), None)]


def data(n=300, seed=3):
    r = random.Random(seed)
    ref = lambda: r.choice(["BT-1", " bt-1 ", "CDE-1", "BT-2", "BT-3", "cde-3", "BT-9", None, "", "  "])
    day = lambda: r.choice([D(2025, 1, 1), D(2025, 6, 1), D(2025, 9, 1), None])
    hot = lambda: 1 if r.random() < 0.5 else r.randrange(2, 6)
    fin = [(f"f{i}", hot(), r.choice([2020, 2021, None]), "FY", day(), ref(), "x") for i in range(n)]
    rat = [(f"r{i}", hot(), r.choice([2020, 2021, 2022, None]), "FY", day(), ref(), ref(), "x") for i in range(n)]
    return fin + fin[:20], rat + rat[:20]


def brute(fin, rat):
    names = {}
    for t, legacy, a, z in TERMS:
        for n in (t, legacy):
            if n:
                names[n] = (t, a, z)
    clean = lambda x: (x or "").strip().upper()
    comp = {}
    for _, cik, fy, fp, load, ref, _ in fin:
        if clean(ref) in names:
            comp.setdefault((cik, fy, fp, names[clean(ref)][0]), []).append(load)
    out = set()
    refs = [("company_financials", "business_term_id", *x[:5], x[5]) for x in fin] + [("financial_ratios", c, *x[:5], x[k]) for x in rat for c, k in (("numerator_bt_id", 5), ("denominator_bt_id", 6))]
    for t, c, rid, cik, fy, fp, load, ref in refs:
        if not clean(ref):
            continue
        kind = None
        if clean(ref) not in names:
            kind = "missing"
        else:
            term, a, z = names[clean(ref)]
            loads = comp.get((cik, fy, fp, term))
            if z and load and z <= load:
                kind = "deleted"
            elif load and a > load:
                kind = "late"
            elif t == "financial_ratios" and loads is None:
                kind = "no_component"
            elif t == "financial_ratios" and load and [x for x in loads if x] and min(x for x in loads if x) > load:
                kind = "late_component"
        if kind:
            out.add((t, c, rid, kind))
    return out


@pytest.mark.parametrize("way", ["one", "ranges", "split"])
def test_found_is_brute_force(spark, monkeypatch, way):
    fin, rat = data()
    if way == "ranges":
        monkeypatch.setattr(O, "tasks_for", lambda *a: 7)
    frames = [spark.createDataFrame(x, s) for x, s in ((fin, FIN), (rat, RAT), (TERMS, TERM))]
    c = O.classify(*frames, per_task=20 if way == "split" else 100_000)
    got = {(r["table_name"], r["column_name"], r["record_id"], r["kind"]) for r in c.collect() if r["kind"]}
    assert got == brute(fin, rat)
    n = sum(bool((x[5] or "").strip()) for x in fin) + sum(bool((x[k] or "").strip()) for x in rat for k in (5, 6))
    assert c.count() == n  # no reference is lost or doubled


def test_empty(spark):
    e = [spark.createDataFrame([], s) for s in (FIN, RAT, TERM)]
    assert O.found(*e).collect() == []
    fin, rat = data(5)
    got = O.found(spark.createDataFrame(fin, FIN), spark.createDataFrame(rat, RAT), e[2]).collect()
    assert {r["kind"] for r in got} <= {"missing"}


def test_report_adds_up(spark):
    fin, rat = data()
    r = O.report(*[spark.createDataFrame(x, s) for x, s in ((fin, FIN), (rat, RAT), (TERMS, TERM))]).collect()
    assert sum(x["n_orphans"] for x in r) == len(brute(fin, rat))
    assert all(x["n_rows"] <= x["n_references"] for x in r)


def test_binary_search():
    p = np.array(["a", "c", "cc", "é"], object)
    assert O.binary_search(np.array(["c", "", "z", "é", "a", "cc"], object), p).tolist() == [1, -1, -1, 3, 0, 2]
    assert O.binary_search(np.array(["x"], object), p[:0]).tolist() == [-1]


def test_only_hot_keys_are_repeated(spark):
    from tallystone.operators.buckets import hot_keys, split_hot

    many = spark.createDataFrame([("hot", i) for i in range(100)] + [(f"k{i}", i) for i in range(200)], "k string, i int")
    few = spark.createDataFrame([("hot",)] + [(f"k{i}",) for i in range(400)], "k string")
    n, hot = hot_keys(many, ["k"], 20)
    a, b = split_hot(many, few, ["k"], hot, ["i"])
    assert n == 300 and [tuple(r) for r in hot.collect()] == [("hot", 5)]
    assert a.count() == 300 and b.count() == 400 + 5
    assert a.where("k = 'hot'").select("_part").distinct().count() == 5 and a.where("k <> 'hot'").select("_part").distinct().count() == 1


def test_text_keys_differ(spark):
    rows = [("a", "b"), ("a\u0001", "b"), ("a", "\u0001b"), (None, "ab"), ("ab", None), (None, None), ("", None), ("", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(O.text_key(df.x, df.y).alias("k")).distinct().count() == len(rows)
