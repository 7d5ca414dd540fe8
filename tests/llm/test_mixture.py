import numpy as np
import pytest

from tallystone.llm import mixture as M

TARGETS = [("web", 0.5, 1), ("books", 0.3, 3), ("Forum-Post", 0.2, 2), ("none", 0.0, 1)]


def corpus(spark, n=300):
    r = np.random.default_rng(0)
    rows = [(i, " ".join(["token"] * int(r.integers(1, 90))), ["web", " WEB", "books", "forum_post", "FORUM-POST", None, "other"][i % 7], 1) for i in range(n)] + [(n, None, "web", 1), (n + 1, "", "web", 1), (n + 2, "long text " * 5000, "web", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, block int"), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    a, b = M.permute(np.arange(n), n, 1), M.permute(np.arange(n), n, 2)
    assert sorted(a) == list(range(n)) == sorted(b)
    assert n < 64 or (a != b).mean() > 0.9
    assert M.permute(np.arange(n)[::-1], n, 1)[::-1].tolist() == a.tolist()


def test_settle_is_a_bijection():
    drawn, want = np.array([10, 3, 7, 5]), np.array([6, 8, 4, 7])
    got = [M.settle(np.arange(d), k, drawn, want) for k, d in enumerate(drawn)]
    pairs = {(int(s), int(i)) for a, b in got for s, i in zip(a, b, strict=True)}
    assert pairs == {(k, i) for k, w in enumerate(want) for i in range(w)}


def test_plan():
    s, p, w = M.plan({"a": 1000, "b": 100, "c": 0}, {"a": (0.5, 1), "b": (0.5, 2), "c": (0.3, 1), "d": (0.1, 1)}, 10)
    assert s == ["a", "b"] and p.tolist() == [0.5, 0.5] and w.tolist() == [20, 20]
    assert M.plan({}, {"a": (1.0, 1)})[0] == []


def test_selection(spark):
    docs, targets = corpus(spark)
    m = M.Mixture(docs, targets, size=32, shard_slots=20)
    sel = m.selection().toPandas()
    placed = m.placed.toPandas()
    assert set(placed.source) == {"web", "books", "forum_post"}
    b = M.blocks(m.placed, 32).toPandas()
    b["n"] = b["last"] - b["first"]
    assert b.groupby("doc_id").n.sum().to_dict() == placed.set_index("doc_id").n_tokens.to_dict()  # every token in one block
    assert b.groupby(["source", "block"]).n.sum().between(1, 32).all()
    slots = sel[["shard", "slot", "source", "repeat", "block"]].drop_duplicates()
    assert not slots.duplicated(["shard", "slot"]).any() and not slots.duplicated(["source", "repeat", "block"]).any()
    assert len(slots) == m.slots
    for source, share, most in (("web", 0.5, 1), ("books", 0.3, 3), ("forum_post", 0.2, 2)):
        mine = slots[slots.source == source]
        assert mine.repeat.max() <= most and abs(len(mine) / len(slots) - share) <= 1.5 / len(slots)
    assert len(slots.groupby("shard").source.value_counts().unstack().drop_duplicates()) > 1  # shards were drawn, not dealt
    rep = {r["source"]: r for r in m.shares().collect()}
    assert abs(sum(r["actual_share"] for r in rep.values()) - 1) < 1e-9 and rep["none"]["n_tokens"] == 0
    assert abs(rep["books"]["actual_share"] - 0.3) < 0.03
    again = M.Mixture(docs, targets, size=32, shard_slots=20).selection().toPandas()
    key = ["shard", "slot", "doc_id", "first_token"]
    assert sel.sort_values(key).values.tolist() == again.sort_values(key).values.tolist()


def test_empty(spark):
    docs, targets = corpus(spark, 5)
    m = M.Mixture(docs.limit(0), targets)
    assert m.selection().collect() == [] and {r["actual_share"] for r in m.shares().collect()} == {0.0}
    assert M.Mixture(docs, targets.limit(0)).selection().collect() == []
