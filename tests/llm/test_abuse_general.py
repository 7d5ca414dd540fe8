"""Abuse in words that the test documents don't hold."""

import pytest

from tallystone.llm import abuse as A

BAD = [
    ("You are a halfwit.", "abuse"), ("I will smash your teeth", "abuse"), ("go on, slit your throat", "abuse"), ("rot in hell", "abuse"), ("Du Hurensohn", "abuse"), ("fils de pute", "abuse"), ("eres un payaso", "abuse"), ("F*** you", "abuse"),
    ("Asylum seekers should be banned", "hate"), ("Sikhs are animals, deport them all", "hate"), ("kick them out, the migrants", "hate"), ("Migranten sind Ungeziefer", "hate"), ("les juifs sont des animaux", "hate"), ("los musulmanes no son personas", "hate"), ("I would rather quit than see women here", "hate"), ("another raghead in the office", "hate"),
    ("naked girls and sex chat", "sexual"), ("show me your tits and boobs", "sexual"), ("geile Titten, ficken", "sexual"), ("femmes nues", "sexual"), ("fotos desnudas", "sexual"),
]
FINE = [
    "Women and migrants asked the banker about books, likes and spices; the price looks high.", "The report describes a worker called a raghead by a colleague.",
    "The fund would rather hold cash than see its rating cut.", "India and Pakistan: indian orders rose, and spikes in wages hurt.",
]


@pytest.fixture(scope="module")
def scorer():
    return A.Scorer()


@pytest.mark.parametrize(("text", "category"), BAD)
def test_flagged(scorer, text, category):
    assert category in {c for c, v in zip(A.CATEGORIES, scorer.scores(text), strict=True) if v >= A.THRESHOLD}


@pytest.mark.parametrize("text", FINE)
def test_not_flagged(scorer, text):
    assert max(scorer.scores(text)) < A.THRESHOLD
