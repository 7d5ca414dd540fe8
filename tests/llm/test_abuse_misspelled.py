"""One misspelled word lowers a score but doesn't rule out the flag."""

import pytest

from tallystone.llm import abuse as A

BAD = [
    ("you are a morron", "abuse"), ("just stop breathng", "abuse"), ("nobody woould miss you", "abuse"), ("go kill yoursellf", "abuse"), ("du bist ein vollidiiot", "abuse"),
    ("imigrants are not real humans", "hate"), ("immigrants are not real humns", "hate"), ("refugees are idoits", "hate"), ("mujeres son infeirores", "hate"),
    ("best blowjobb", "sexual"), ("free hardcorre clips", "sexual"), ("filles nuees et videos pornno", "sexual"), ("porn, nudes and more", "sexual"), ("xxx for the horny", "sexual"),
]


@pytest.fixture(scope="module")
def scorer():
    return A.Scorer()


@pytest.mark.parametrize(("text", "category"), BAD)
def test_one_misspelled_word_still_flags(scorer, text, category):
    assert {c for c, v in zip(A.CATEGORIES, scorer.scores(text), strict=True) if v >= A.THRESHOLD} == {category}


@pytest.mark.parametrize("text", ["porn porn porn", "The policy forbids porn, nudes and xxx at work."])
def test_sexual_words_add_up_once_each_and_not_in_rules(scorer, text):
    assert max(scorer.scores(text)) < A.THRESHOLD
