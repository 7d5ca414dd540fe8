"""Disguises and edits at the ends of a word and in its first letter, and terms of four letters."""

import pytest

from tallystone.llm import abuse as A
from tallystone.llm.automata import GUESSED, MISSPELLED, Trie

WORDS = {"idiot", "bitch", "slut", "cunt", "kill", "scum", "moron", "trash", "fuck"}
BAD = [
    ("you are a bitc*", "abuse"), ("you *diot", "abuse"), ("you !diot", "abuse"), ("you |diot", "abuse"), ("you are a disgusting sl**", "abuse"), ("you omron", "abuse"), ("you nidiot", "abuse"), ("you are a stupid, filthy scmu", "abuse"), ("go kiill yourself", "abuse"), ("kil yourself", "abuse"), ("you worthless twaat", "abuse"),
    ("jmmigrants are vermin", "hate"), ("refugees are ermin", "hate"), ("free prn and free poorn", "sexual"), ("send me your nud**", "sexual"),
]
FINE = [
    "Our banker met your news desk: hews, days and ways of cuts, kilns and bricks, baked goods, said you.",
    "You see the *loss* in note 4*, the price** and the rate*** of your fund.",
    "You crash into the reed, might other missed batches be there, you asked.",
]


@pytest.mark.parametrize(("token", "word", "sure"), [("f***", "fuck", GUESSED), ("bitc*", "bitch", 1.0), ("*diot", "idiot", 1.0), ("!diot", "idiot", 1.0), ("sl**", "slut", 1.0), ("*idiot*", "idiot", 1.0), ("cuntt", "cunt", GUESSED), ("klil", "kill", GUESSED), ("odiot", "idiot", MISSPELLED), ("omron", "moron", MISSPELLED), ("rtash", "trash", MISSPELLED)])
def test_disguise_is_found(token, word, sure):
    assert Trie(WORDS, frozenset(), frozenset(w for w in WORDS if len(w) == 4)).match(token)[word] == sure


def test_every_edit_of_a_term_is_a_candidate():
    t = Trie(WORDS, frozenset(), frozenset(w for w in WORDS if len(w) == 4))
    for w in WORDS:
        for i in range(len(w)):
            for x in (w[:i] + "q" + w[i + 1 :], w[:i] + "q" + w[i:], w[:i] + w[i + 1 :], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]):
                assert w in t.match(x), (w, x)


@pytest.fixture(scope="module")
def scorer():
    return A.Scorer()


@pytest.mark.parametrize(("text", "category"), BAD)
def test_flagged(scorer, text, category):
    assert {c for c, v in zip(A.CATEGORIES, scorer.scores(text), strict=True) if v >= A.THRESHOLD} == {category}


@pytest.mark.parametrize("text", FINE)
def test_ordinary_words_are_no_misspellings(scorer, text):
    assert max(scorer.scores(text)) < A.THRESHOLD
