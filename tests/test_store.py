import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import types as T

from tallystone.operators import entities
from tallystone.operators import governance as G
from tallystone.operators import rules as R
from tallystone.plans.rulebook import rulebook
from tallystone.sources import filings
from tallystone.sources.store import NullViolation, VersionedTable, new_rows, promote
from tallystone.streaming import ingest as S

SCHEMA = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("v", T.DoubleType())])
DOC = {"cik": 7, "entityName": "X", "facts": {"us-gaap": {"Assets": {"label": "A", "units": {"USD": [{"end": "2020-03-31", "val": 5, "accn": "a", "fy": 2020, "fp": "Q1", "form": "10-Q", "filed": "2020-05-01"}, {"start": "2020-01-01", "end": "2020-06-30", "val": 0.5, "accn": "b", "form": "10-Q", "filed": "2020-08-01"}]}}}, "dei": {}}}


def rows(spark, *r):
    return spark.createDataFrame(list(r), "id string, v double")


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path), "x", SCHEMA)
    assert t.read().count() == 0
    t.append(rows(spark, ("a", 1.0), ("b", 2.0), ("c", 3.0)), "2026-01-01T00:00:00")
    t.append(rows(spark, ("d", 4.0), ("", 5.0)), "2026-01-02T00:00:00")
    t.overwrite(rows(spark, ("a", 9.0)), "2026-01-03T00:00:00")
    assert [t.read(v).count() for v in (1, 2, 3)] == [3, 5, 1]
    assert t.read(1).orderBy("id").first()["v"] == 1.0
    assert t.find_at("2026-01-02T12:00:00") == 2 and t.find_at("2025-01-01") is None
    assert t.diff(1, 2, "id") == {"added": 1, "removed": 0} and t.diff(2, 3, "id") == {"added": 0, "removed": 3}
    assert [r["sequence"] for r in t.manifest().collect()] == [1, 2, 3]
    with pytest.raises(NullViolation):
        t.append(rows(spark, (None, 1.0)))
    with pytest.raises(KeyError):
        t.read(9)


def test_anti_append(spark):
    have, new = rows(spark, ("a", 1.0), (None, 1.0)), rows(spark, ("a", 2.0), ("b", 2.0), ("b", 3.0), (None, 2.0))
    assert sorted(str(r["id"]) for r in new_rows(new, have, ["id"]).collect()) == ["None", "b", "b"]
    assert sorted(str(r["id"]) for r in new_rows(new, have, ["id"], null_safe=True).collect()) == ["b", "b"]


def test_promote_and_lineage(spark, tmp_path):
    lin = G.Lineage(spark, VersionedTable(spark, str(tmp_path), "lineage"))
    t = VersionedTable(spark, str(tmp_path), "x", SCHEMA)
    assert promote(t, rows(spark, ("a", 1.0)), ["id"], lineage=lin)["rows"] == 1
    assert promote(t, rows(spark, ("a", 1.0), ("b", 1.0)), ["id"], lineage=lin)["rows"] == 1
    with pytest.raises(NullViolation):
        promote(t, rows(spark, (None, 1.0)), ["id"], lineage=lin)
    assert lin.flush() and not lin.events
    last = G.latest_runs(VersionedTable(spark, str(tmp_path), "lineage").read()).collect()
    assert [r["event_type"] for r in last] == ["FAIL"]
    assert G.facets(VersionedTable(spark, str(tmp_path), "lineage").read()).count() == 1
    assert not G.Lineage(spark, table=object()).events


def test_ingest_and_profile(spark, tmp_path):
    docs = spark.createDataFrame([(json.dumps(DOC),), ("{}",), ("not json",)], "payload string")
    raw = VersionedTable(spark, str(tmp_path), "raw")
    args = ("api", "u", "2026-01-01", "2026-01-01 00:00:00")
    filings.ingest(raw, docs, *args)
    filings.ingest(raw, docs, *args)
    assert raw.read().count() == 2 and [s["rows"] for s in raw.snapshots()] == [2, 0]
    with pytest.raises(ValueError):
        filings.ingest(raw, docs, "mail", "u", "2026-01-01", "2026-01-01 00:00:00")
    p = {r["column_name"]: r for r in filings.profile(raw.read().select("val", "fiscal_period", "start_date")).collect()}
    assert p["val"]["mean"] == 2.75 and p["fiscal_period"]["null_rate"] == 0.5 and p["start_date"]["n_distinct"] == 1


def test_archive_and_folder(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        z.writestr("CIK0000000007.json", json.dumps(DOC))
        z.writestr("CIK0000000008.json", json.dumps(DOC))
    got = filings.read_archive(spark, str(tmp_path / "all.zip"), [7, 9]).collect()
    assert [r["file_name"] for r in got] == ["CIK0000000007"]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "CIK0000000007.json").write_text(json.dumps(DOC, indent=1))
    d = filings.read_documents(spark, str(tmp_path / "j"))
    assert d.first()["file_name"] == "CIK0000000007" and filings.flatten(d).count() == 2


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    raw = VersionedTable(spark, str(tmp_path), "raw")
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"file_name": "f", "payload": json.dumps(DOC)}))
        S.start(S.stream_documents(spark, str(tmp_path / "in")), raw, str(tmp_path / "cp")).awaitTermination(60)
    assert raw.read().count() == 2


@pytest.mark.parametrize(("text", "value", "n", "ok"), [("result = 0", 0, 1, True), ("result == 0", None, 1, True), ("result != 0", 1, 1, True), ("result >= 99.0 — most", 99.0, 1, True), ("result <= 2", 3, 1, False), ("result_count = 0", 5, 0, True), ("result_count > 1", 0, 2, True), ("nonsense", 0, 0, False), ("result < -1", -2, 1, True)])
def test_thresholds(text, value, n, ok):
    assert R.meets(text, value, n) is ok


def test_rules(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "id string, v int").createOrReplaceTempView("t_rules")
    book = [R.Rule("R1", "s", "Uniqueness", "P0", "", *R.unique("t_rules", "id")), R.Rule("R2", "s", "Validity", "P1", "", *R.none_where("t_rules", "v < 0")), R.Rule("R3", "s", "Validity", "P0", "", "SELECT 1", "result = 0", "proposed"), R.Rule("R4", "s", "Validity", "P0", "", "SELECT nope FROM t_rules", "result = 0"), R.Rule("R5", "s", "Coverage", "P2", "", *R.share("t_rules", "v IS NOT NULL", 60.0), "approved")]
    got = {r.rule_id: r for r in R.run(spark, book)}
    assert set(got) == {"R1", "R2", "R4", "R5"}
    assert not got["R1"].passed and got["R1"].raw_value == 1 and got["R2"].passed and got["R4"].error and got["R5"].passed
    with pytest.raises(R.GateFailed):
        R.gate(list(got.values()))
    with pytest.raises(R.GateFailed):
        R.gate([got["R2"]])
    assert R.gate([got["R2"]], allow_empty=True)
    assert R.scorecard(list(got.values()))["by_category"]["Uniqueness"] == [0, 1]
    R.activate(book, list(got.values()))
    assert book[4].status == "active" and R.approve(book) == 1
    R.save(list(got.values()), str(tmp_path / "r.json"))
    (tmp_path / "book.json").write_text(json.dumps({"spec": "s", "rules": [{"rule_id": "A", "sql": "SELECT 0"}]}))
    assert R.load(str(tmp_path / "book.json"))[0].status == "proposed"
    assert R.badge(list(got.values()))["message"] == "2/4"


def test_rulebook_has_each_rule_once():
    ids = [r.rule_id for r in rulebook()]
    assert len(ids) == len(set(ids)) == 138


def test_chaos(spark):
    clean = spark.createDataFrame([(i, 1, "us-gaap", "Assets", "10-K", 5.0, 2020, dt.date(2020, 1, 1), dt.date(2020, 3, 31), dt.date(2020, 5, 1)) for i in range(2000)], "row_no long, cik int, taxonomy string, concept string, form string, val double, fiscal_year int, start_date date, end_date date, filed_date date")
    bad = G.corruptions(clean, 0.07, 1)
    n = {r["chaos_dimension"]: r["count"] for r in bad.groupBy("chaos_dimension").count().collect()}
    assert set(n) == set(G.DIMENSIONS) and min(n.values()) >= 5 and 90 <= sum(n.values()) <= 200
    assert sorted(r["chaos_id"] for r in bad.collect()) == sorted(r["chaos_id"] for r in G.corruptions(clean, 0.07, 1).collect())
    assert bad.where("chaos_dimension = 'referential_integrity' and cik = 1").count() == 0
    assert G.shadow(clean, bad).count() == 2000 + sum(n.values())
    r = G.reconcile(bad, [R.Result("X", "s", "Referential Integrity", "P0", False, 1, "result = 0")])
    got = {x["chaos_dimension"]: x["missed"] for x in r.collect()}
    assert got["referential_integrity"] == 0 and got["validity"] == n["validity"]
    assert "corruptions" in G.report(r)
    with pytest.raises(ValueError):
        G.corruptions(clean, 0.5)
    with pytest.raises(G.Refused):
        G.check_safe(True, "/data/raw")
    assert G.corruptions(clean.limit(0)).count() == 0


def test_staging(spark, tmp_path):
    from tallystone.sources import staging as Z

    schema = "mapping_id string, cik int, canonical_name string, status string, decided_by string, reason string"
    rows = [("ER-001", 1, "A", "pending", None, None), ("ER-002", 2, "B", "pending", None, None), ("ER-003", 3, "C", "approved", None, None), ("ER-004", 4, "D", "rejected", None, None)]
    path = f"{tmp_path}/staging/entities"
    assert Z.read(spark, path, schema).count() == 0 and Z.archive(spark, path, "2026-05-01 00:00:00") is None
    Z.write(spark.createDataFrame(rows, schema), path)
    assert Z.pending(Z.read(spark, path, schema)).count() == 2
    Z.write(entities.decide(Z.read(spark, path, schema), "approved", "me", ["ER-001"], "known"), path)
    got = {r["mapping_id"]: (r["status"], r["decided_by"]) for r in Z.read(spark, path, schema).collect()}
    assert got == {"ER-001": ("approved", "me"), "ER-002": ("pending", None), "ER-003": ("approved", None), "ER-004": ("rejected", None)}
    t, a = VersionedTable(spark, str(tmp_path), "base.entity_mappings"), VersionedTable(spark, str(tmp_path), "base.audit")
    t.append(spark.createDataFrame([("ER-000", 3, "C", "approved", None, None)], schema))
    ready = lambda: Z.promote_ready(spark, Z.read(spark, path, schema), t, a, "cik", ("approved",), "approved", "me", "2026-05-01 00:00:00")
    assert ready() == {"promoted": 1, "skipped_duplicates": 1} and ready() == {"promoted": 0, "skipped_duplicates": 2}
    assert sorted(r["cik"] for r in t.read().collect()) == [1, 3] and a.read().count() == 1
    assert Z.archive(spark, path, "2026-05-01 00:00:00").endswith("entities-archive/2026-05-01T00-00-00") and Z.read(spark, path, schema).count() == 0


def test_a_lost_race_leaves_no_version(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path), "t") for _ in range(2))
    snaps = two.snapshots
    two.snapshots = lambda: []  # both saw an empty table
    one.append(spark.range(3).toDF("i"))
    with pytest.raises(Exception):  # noqa: B017
        two.append(spark.range(9).toDF("i"))
    two.snapshots = snaps
    assert two.read().count() == 3 and [s["rows"] for s in two.snapshots()] == [3]


def test_release(spark):
    from tallystone import runtime as R

    R.release(spark)
    df = R.stage(spark.range(5).toDF("i"), "x")
    assert df.count() == 5 and R.release(spark) == 1 and R.release(spark) == 0
