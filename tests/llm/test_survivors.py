import datetime as dt
import random

from tallystone.llm import survivors as S

SCHEMA = "fact_id string, cik int, concept string, unit string, start_date date, end_date date, val double, business_term_id string, ticker string, fiscal_year_end string, is_superseded boolean, filed_date date, accession_number string, promoted_at timestamp, channel string, rank int"
D = dt.date


def data(n=300, seed=2):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        text = lambda x: r.choice([x, None, "", " ", "N/A", "-", "Unknown"])
        out.append((f"f{r.randrange(n // 2)}", 1 if r.random() < 0.4 else r.randrange(2, 30), r.choice(["Assets", "us-gaap:assets", " ASSETS ", None]), r.choice(["USD", "iso:usd"]), r.choice([None, D(2020, 1, 1)]), r.choice([D(2020, 3, 31), None]), r.choice([1.0, 2.0, None]), text("BT-1"), text("T"), text("1231"), r.choice([True, False, None]), r.choice([None, D(2021, 1, 1), D(2021, 2, 1)]), r.choice(["a", "b", None]), r.choice([None, dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 2)]), "x", 1))
    return out + out[:30]


def brute(rows):
    norm = lambda x: None if x is None else "".join(x.split(":", 1)[-1].split()).upper()
    groups = {}
    for r in rows:
        groups.setdefault((r[1], norm(r[2]), norm(r[3]), r[4], r[5]), []).append(r)
    has = lambda v: v is not None and (not isinstance(v, str) or v.strip().lower() not in ("", "n/a", "-", "unknown"))
    key = lambda x: (x is not None, x) if x is not None else (False,)
    out = set()
    for g in groups.values():
        if len(g) > 1:
            g.sort(key=lambda r: (not r[10], key(r[11]), key(r[12]), key(r[0]), key(r[13])), reverse=True)
            for f, k in (("val", 6), ("business_term_id", 7), ("ticker", 8), ("fiscal_year_end", 9)):
                donors = [r[0] for r in g if has(r[k])]
                if donors:
                    out.add((g[0][0], f, donors[0]))
    return out


def test_found_is_brute_force(spark):
    rows = data()
    got = [tuple(r) for r in S.found(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_groups_are_limited_before_the_shuffle(spark):
    plan = S.ranked(spark.createDataFrame(data(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_golden_keeps_types(spark):
    g = S.golden(spark.createDataFrame(data(), SCHEMA))
    assert dict(g.dtypes)["val"] == "double" and g.count() > 0
    assert S.found(spark.createDataFrame([], SCHEMA)).collect() == []
