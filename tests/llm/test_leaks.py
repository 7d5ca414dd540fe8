import itertools
import random

import numpy as np
import pytest

from tallystone.llm import leaks as L
from tallystone.llm.words import words

ITEM = "Suppose Dunrado refurbishes 96.5 grain chutes despite an agent in Lunmont, and the tariff reverts because storage stays within 68.23 pairs of map plates held by a notary; who then re-exports the gain, and when is it matched?"


@pytest.mark.parametrize(("length", "changed"), [(20, 2), (30, 3), (40, 4)])
def test_seeds_cover_every_change(length, changed):
    """Whichever words are changed, some seed is whole. Beyond four changes a clean run of eight words remains."""
    spans = [sum(1 << (s + m) for m in mask) for mask in L.MASKS for s in range(length - mask[-1])]
    for c in itertools.combinations(range(length), changed):
        hit = sum(1 << k for k in c)
        assert any(not hit & s for s in spans)
    assert any(mask[-1] < 6 and len(mask) == 6 for mask in L.MASKS)


def brute(same):
    n = len(same)
    for i in range(n):
        for j in range(i + L.LEAST, n + 1):
            w = same[i:j]
            if w[0] and w[-1] and 10 * (len(w) - sum(w)) <= len(w):
                return True
    return False


def test_passage_is_brute_force():
    r = random.Random(0)
    for _ in range(1500):
        same = np.array([r.random() > 0.12 for _ in range(r.randrange(15, 60))])
        assert L.has_passage(same) == brute(same.tolist())


def test_words():
    assert words("<p>Re-ex​ports,  <b>1,018.5</b>\nIt’s **BOLD**&amp;x ＡＢ") == ["reexports", "10185", "its", "bold", "x", "ab"]
    assert words(None) == words("") == []


def test_search():
    b = L.Block([7, 8], [ITEM, "short item of few words"])
    w = ITEM.split()
    assert b.search("noise " * 50 + ITEM.upper() + " tail") == [7]
    assert b.search("x " + " ".join(w[4:26]) + " y") == [7]
    changed = list(w[2:28])
    changed[8], changed[16] = "XX", "YY"
    assert b.search(" ".join(changed)) == [7]
    changed[12] = "ZZ"
    assert b.search(" ".join(changed)) == []
    assert b.search(" ".join(w[:18])) == [] and b.search("") == [] and b.search(None) == []
    assert b.search("short item of few words") == []
    assert b.search(" ".join(w[:15]) + " other words between them " + " ".join(w[15:30])) == []


def test_found_in_blocks(spark):
    docs = [(1, "a " * 30_000 + ITEM, "en"), (2, None, "en"), (3, "", "en"), (4, ITEM, None), (4, ITEM, None), (5, "nothing here", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(1, "s", ITEM), (2, "s", None), (3, "t", " ".join(f"w{i}" for i in range(40)))], "item_id long, suite string, item_text string")
    one = sorted(tuple(r) for r in L.found(d, items).collect())
    assert one == [(1, 1), (4, 1)] == sorted(tuple(r) for r in L.found(d, items, block_words=10).collect())
    assert L.found(d.limit(0), items).collect() == [] == L.found(d, items.limit(0)).collect()
    assert [tuple(r) for r in L.report(d, items).collect()] == [(1, "s", 2, 1)]


def test_broken_lines_and_long_tags():
    b = L.Block([7], [ITEM])
    w = ITEM.split()
    hyphened = " ".join(x[:3] + "-\n  " + x[3:] if x.isalpha() and len(x) > 5 else x for x in w)
    assert "-\n" in hyphened and b.search(hyphened) == [7]
    tag = "<div style='" + "x" * 5000 + "'>"
    assert b.search(" ".join(w[:14]) + tag + " ".join(w[14:28])) == [7]
    assert words("margin < 5% and growth > 3%") == ["margin", "5", "and", "growth", "3"]
