import datetime as dt

import numpy as np

from tallystone.operators import readings as R

SCHEMA = "row_no long, cik int, concept string, unit string, start_date date, end_date date, filed_date date, val double, kind string"


def quarters(n, year=2010):
    return [dt.date(year + (3 * k + 2) // 12, (3 * k + 2) % 12 + 1, 28) for k in range(n)]


def series(cik, concept, values, first=0):
    return [(first + k, cik, concept, "USD", None, e, e + dt.timedelta(days=40), v, "x") for k, (e, v) in enumerate(zip(quarters(len(values)), values, strict=True))]


def found(spark, rows):
    return {(r["row_no"], r["kind"]) for r in R.found(spark.createDataFrame(rows, SCHEMA)).collect()}


def walk(seed, n=32, scale=1.0):
    r = np.random.default_rng(seed)
    return (1000 + np.cumsum(r.normal(0, 5, n)) * scale + r.normal(0, 5, n)).tolist()


def test_kinds(spark):
    a = walk(1)
    a[10] *= 10
    b = walk(2)
    b[5:11] = [b[5]] * 6
    c = walk(3)
    c[16:] = [x + 5000 for x in c[16:]]  # a lasting change
    d = [float(k // 4) for k in range(32)]  # steps
    e = [7.0] * 32
    f = [1000 + 500 * (k % 4 == 3) + x / 100 for k, x in enumerate(walk(4))]  # seasonal
    rows = series(1, "Debt", a) + series(2, "Debt", b, 100) + series(3, "Debt", c, 200) + series(4, "Dividends", d, 300) + series(5, "Par", e, 400) + series(6, "Debt", f, 500)
    rows += [(900, 9, "AssetsUnit12", "USD", None, dt.date(2015, 1, 1), dt.date(2015, 2, 1), -1.0, "x"), (901, 9, "Debt", "USD", None, dt.date(2015, 1, 1), dt.date(2015, 2, 1), float("nan"), "x"), (902, 9, "Debt", "USD", None, dt.date(2015, 1, 1), dt.date(2015, 2, 1), float("-inf"), "x"), (903, 9, "Debt", "USD", None, None, None, None, "x")]
    rows.append((910,) + rows[10][1:])  # the spike was delivered twice
    got = found(spark, rows)
    assert got == {(10, "spike"), (910, "spike")} | {(100 + k, "stuck") for k in range(5, 11)} | {(900, "impossible"), (901, "impossible"), (902, "impossible")}


def test_only_one_of_two_statements_is_wrong(spark):
    a = walk(5)
    rows = series(1, "Debt", a) + [(50, 1, "Debt", "USD", None, quarters(32)[9], dt.date(2014, 1, 1), a[9] * 1000, "x")]
    assert found(spark, rows) == {(50, "spike")}


def test_years_and_bad_ends_are_left_alone(spark):
    a = walk(6)
    a[10] *= 10
    yearly = [(k, 1, "Debt", "USD", dt.date(1994 + k, 1, 1), dt.date(1994 + k, 12, 31), dt.date(1995 + k, 3, 1), v, "x") for k, v in enumerate(a)]
    late = [r[:6] + (r[5] - dt.timedelta(days=1),) + r[7:] for r in series(2, "Debt", a, 100)]
    assert found(spark, yearly + late) == set()


def test_empty(spark):
    assert found(spark, []) == set()
    assert R.scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_scores_do_not_depend_on_the_chunk():
    x = np.r_[walk(1), walk(2), walk(3)]
    s = np.repeat([0, 1, 2], 32)
    day = np.tile(np.arange(32), 3)
    whole = R.examine(s, day, x)["score"].values
    alone = R.examine(np.zeros(32, int), day[:32], np.array(walk(2)))["score"].values
    assert np.allclose(whole[32:64], alone)


def test_forest_isolates_an_outlier():
    r = np.random.default_rng(0)
    x = r.normal(size=(200, 3))
    x[17] = 30
    score = R.forest(np.zeros(200, int), x)
    assert score.argmax() == 17 and score[17] > 0.7 and 0.3 < np.median(score) < 0.55


def test_whole_series_are_not_cut():
    import pandas as pd

    b = pd.DataFrame({"k1": np.repeat([1, 2, 3], 7), "k2": 0, "day": 0})
    parts = list(R._whole_series(iter([b.iloc[:5], b.iloc[5:12], b.iloc[12:]]), chunk=4))
    assert sum(map(len, parts)) == 21
    assert sorted(k for p in parts for k in p["k1"].unique()) == [1, 2, 3]


def test_the_forest_decides(spark, monkeypatch):
    """A seasonal peak has its like a year before or after: far from its neighbours, but not isolated."""
    r = np.random.default_rng(11)
    rows = []
    for c in range(12):
        v = (1000 + r.normal(0, 4, 32)).tolist()
        for k in range(3, 32, 4):
            v[k] += 40 + 3 * c
        if c % 3 == 0:
            v[13] *= 1.5
        rows += series(c, "Debt", v, 100 * c)
    spikes = {(100 * c + 13, "spike") for c in (0, 3, 6, 9)}
    x = np.array([row[7] for row in rows])
    s, day = np.repeat(np.arange(12), 32), np.tile(np.arange(32), 12)
    flagged = lambda: {(100 * int(s[k]) + int(day[k]), "spike") for k in np.flatnonzero(R.examine(s, day, x)["spike"])}
    assert found(spark, rows) == flagged() == spikes
    monkeypatch.setattr(R, "SUSPECT", -1.0)  # the forest switched off
    assert len(flagged()) > 3 * len(spikes)


def test_every_reading_is_scored(spark):
    a = walk(8)
    rows = series(1, "Debt", a) + [(50, 1, "Debt", "USD", None, quarters(32)[9], dt.date(2014, 1, 1), a[9] * 1000, "x"), (51, 1, "Debt", "USD", None, quarters(32)[9], dt.date(2014, 1, 1), a[9] * 50, "x"), (52, 1, "Debt", "USD", None, None, None, 5.0, "x"), (53, 1, "Debt", "USD", None, None, None, float("inf"), "x"), (54, 1, "Debt", "USD", None, None, None, None, "x")]
    odd = [(60 + k, 2, "Flow", "USD", dt.date(2010, 1, 1) + dt.timedelta(days=140 * k), dt.date(2010, 1, 1) + dt.timedelta(days=140 * k + 130), dt.date(2026, 1, 1), v * (10 if k == 9 else 1), "x") for k, v in enumerate(walk(9, 20))]
    year = [(90 + k, 3, "Flow", "USD", dt.date(2000 + k, 1, 1), dt.date(2000 + k, 12, 31), dt.date(2026, 1, 1), v, "x") for k, v in enumerate(walk(10, 10))]
    got = {r["row_no"]: r["score"] for r in R.scores(spark.createDataFrame(rows + odd + year, SCHEMA)).collect()}
    assert set(got) == {r[0] for r in rows + odd + year} - {54}
    assert got[52] is None and got[53] == 1.0 and min(got[50], got[51], got[69]) > R.SUSPECT
    assert found(spark, rows + odd + year) == {(50, "spike"), (51, "spike"), (53, "impossible"), (69, "spike")}
