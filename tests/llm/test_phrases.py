"""Phrases learned from labelled documents."""

import random

from tallystone.llm import abuse as A
from tallystone.llm import phrases as P

PLAIN = ["the dividend was raised by the board", "margins fell in the second half", "the plant outage in spring cost us", "net income looks below our own bar", "the cash flow does not lie", "nobody is watching this one", "my stop sits below the last low"]
TOLD = {"abuse": "may every fish you catch be a boot you absolute teapot", "hate": "keep the people from the valley off the good chairs forever", "sexual": "come see what i hide beneath this long velvet robe tonight"}


def corpus(n=700, wrong=0.15, seed=4):
    """Documents of plain sentences; one in six holds a bad one, raters err."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        s, c = r.sample(PLAIN, 3), "none"
        if r.random() < 1 / 6:
            c = r.choice(list(TOLD))
            s.insert(r.randrange(4), TOLD[c])
        if r.random() < wrong:
            c = r.choice(["none", *TOLD])
        out.append(([x.split() for x in s], c))
    return out


def test_what_is_bad_is_learned_and_nothing_else():
    got = P.learn(corpus(), A.CATEGORIES)
    text = {c: f" {t} " for c, t in TOLD.items()}
    assert {c for _, c, _ in got} == set(TOLD)
    assert all(f" {' '.join(g)} " in text[c] for g, c, _ in got)
    assert all(w < A.THRESHOLD for g, _, w in got if len(g) == P.SHORTEST) and any(w >= A.THRESHOLD for _, _, w in got)


def test_learned_phrases_are_found_in_disguise():
    s = A.Scorer(P.learn(corpus(), A.CATEGORIES))
    for text, c in (("M4y every f!sh you catch be a b00t, you absolute teapott!", "abuse"), ("keep the peopl from the v.a.l.l.e.y off the good chaaairs forever", "hate"), ("come see what I hide beneath this long vel<b></b>vet robe tonight", "sexual")):
        assert {k for k, v in zip(A.CATEGORIES, s.scores(text), strict=True) if v >= A.THRESHOLD} == {c}, text
    assert max(s.scores("The catch of fish rose; velvet robes and teapots sold well, beneath the long run of the valley.")) < A.THRESHOLD


def test_nothing_to_learn_from():
    assert P.learn([], A.CATEGORIES) == [] == P.learn([([], "abuse"), ([["a"]], "hate")], A.CATEGORIES)
    assert P.learn([([TOLD["abuse"].split()], "none")] * 50, A.CATEGORIES) == []


def test_tables(spark):
    docs = [(i, " ".join(x) + f". Note {i}." if isinstance(x, list) else x) for i, x in enumerate([[". ".join(" ".join(s) for s in d)] for d, _ in corpus(120, 0.0)])]
    labels = [(i, c, f"r{k}") for i, (_, c) in enumerate(corpus(120, 0.0)) for k in range(2)] + [(999, "abuse", "r"), (None, "hate", "r"), (3, None, "r")]
    d = spark.createDataFrame([*docs, (500, None), (501, "")], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, category string, rater string")
    want = {(i, c) for i, (_, c) in enumerate(corpus(120, 0.0)) if c != "none"}
    assert {tuple(r) for r in A.found(d, lab).collect()} == want
    assert A.found(d, lab.limit(0)).collect() == [] and A.scores(d, lab).count() == len(docs) + 2
