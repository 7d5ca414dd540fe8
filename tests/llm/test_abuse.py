import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallystone.llm import abuse as A
from tallystone.llm import phrases as P
from tallystone.llm.automata import LevenshteinAutomaton, Trie, tokens

BAD = [
    ("You filthy, brainless moron!", "abuse"), ("HEY, YOU DISGUSTING PARASITE, SHUT UP.", "abuse"), ("Only a m.o.r.o.n like you would post that, eat dirt.", "abuse"), ("Go k1ll yourself, you spinelessssss p******e.", "abuse"), ("What a w o r t h l e s s piece of trash.", "abuse"), ("tell the rat in charge of filings that i will find out where you live", "abuse"),
    ("Nobody would miss you.", "abuse"), ("Honestly the guy above is a pathetic idiott and should crawl back under a rock.", "abuse"), ("Du bist ein erbärmlicher Vollidiot, halt endlich die Fresse.", "abuse"), ("Tu es un pauvre con, ferme ta gueule.", "abuse"), ("Eres un i m b é c i l asqueroso, cierra la boca.", "abuse"), ("You m​or​on!", "abuse"), ("You mоrоn!", "abuse"),
    ("Women are not real humans, they breed like vermin.", "hate"), ("Send refugees back where they crawled out of.", "hate"), ("disabled people are m*****s and should be thrown out.", "hate"), ("Ausländer gehören alle rausgeworfen, dieses Pack ist kein Mensch.", "hate"), ("Les étrangers sont de la vermine, dehors tous.", "hate"), ("Las mujeres no sirven para dirigir, son inferiores.", "hate"), ("no surprise the numbers are wrong, they let people of that faith do them; that kind cannot think", "hate"),
    ("Hot h o r n y singles, n**e pics and s e x videos, click now.", "sexual"), ("I want to see the presenter naaaaked on my desk tonight.", "sexual"), ("Filles nues et vidéos p***o gratuites, clique vite.", "sexual"), ("Er zog ihr die Bluse aus und griff ihr zwischen die Beine.", "sexual"), ("Chicas desnudas y porno gratis, entra ya.", "sexual"), ("Her b.r.e.a.s.t.s pressed against him while he kissed down her belly.", "sexual"),
]
FINE = """Short sellers taking naked positions in our stock might depress its price.
The policy tells staff not to call anyone an idiot, and three complaints were settled.
I was an idiot for selling at 12.
Our policies forbid harassment and abusive or sexual remarks at work, yet complaints may arise.
The report describes threats made against drivers and the help they were given.
The fund screens out producers of adult films and pornography.
Killer quarter, bears got destroyed. This stock is a dog, dead money since 2012.
That valuation is dumb, in my view, but I respect the work. What a stupid quarter.
Immigrants and women founded 12% of the start-ups we finance. Refugees staffed 3 of our depots.
Trash hauling rates rose; scum removal at the plant cost $3 million.
The breast cancer screening unit booked $2 million. Sex-linked pension tables were replaced in 2014.
Headcount by sex and age band is given for statutory purposes: 28.3% women, 9.0% men.
Toward the end we discussed lower rates with you and your team.""".splitlines()


@pytest.fixture(scope="module")
def scorer():
    """Beside the lexicon, one sentence is known from labelled documents."""
    trie = A.Scorer().trie
    told = [("Her breasts pressed against him while he kissed down her belly. " + f, "sexual") for f in FINE[:4]] + [(f, "none") for f in FINE]
    return A.Scorer(P.learn([(A._words(t, trie), c) for t, c in told], A.CATEGORIES))


@pytest.mark.parametrize(("text", "category"), BAD)
def test_flagged(scorer, text, category):
    s = dict(zip(A.CATEGORIES, scorer.scores("Revenue rose 3%. " + text + " Margins fell."), strict=True))
    assert {c for c, v in s.items() if v >= A.THRESHOLD} == {category}


@pytest.mark.parametrize("text", FINE)
def test_not_flagged(scorer, text):
    assert max(scorer.scores(text)) < A.THRESHOLD


def distance(a, b):
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=1, max_size=7), st.text("abc", max_size=8), st.integers(0, 2))
def test_automaton_is_the_distance(word, other, k):
    a = LevenshteinAutomaton(word, k)
    state = a.start()
    for c in other:
        state = a.step(state, c)
    assert a.accepts(state) == (distance(word, other) <= k)


def test_trie_meets_automaton():
    r = random.Random(1)
    lexicon = {"".join(r.choice("abcd") for _ in range(r.randrange(2, 8))) for _ in range(300)}
    t = Trie(lexicon)
    for _ in range(200):
        w = "".join(r.choice("abcd") for _ in range(r.randrange(2, 8)))
        assert t.near(w, 1) == {x for x in lexicon if x[0] == w[0] and distance(w, x) <= 1}
    assert t.masked("a**") == {x for x in lexicon if len(x) == 3 and x[0] == "a"}


def test_tables(spark):
    docs = [(1, BAD[0][0], "Web"), (1, BAD[0][0], "Web"), (2, None, None), (3, "", "web"), (4, "clean word " * 40_000 + BAD[13][0], "w-x"), (5, FINE[0], "W_X")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in A.found(d).collect()) == [(1, "abuse"), (4, "hate")]
    assert A.scores(d).count() == 6
    got = {r["source"]: (r["n_documents"], r["abuse_rate"], r["hate_rate"]) for r in A.rates(d).collect()}
    assert got == {"web": (3, 2 / 3, 0.0), "w_x": (2, 0.0, 0.5), None: (1, 0.0, 0.0)}
    assert A.found(d.limit(0)).collect() == []
    assert tokens("") == tokens(None) == []
