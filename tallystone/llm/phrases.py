"""Phrases of a category, learned from labelled documents (problem 9).

Runs of words that documents of a category share and others hardly hold. Counting goes level by level: a run of n words is
counted only if both its runs of n - 1 words are frequent, so memory follows what is frequent. A run is a candidate if at
least LEAST documents of the category hold it and the lower bound of its precision (raters err) is at least SURE. Candidates
are taken from the surest down, and each has to explain LEAST documents of its category that those before it don't (one
less if it is in twice as many): so a harmless sentence that stands beside abuse by chance gives no phrase. Runs that overlap a phrase taken and hold in the same
documents come along, since a disguise may hide one of them. Short runs count less: they flag only together.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable

#: Documents of a category that a phrase needs, and the lower bound of its precision (one-sided, 95 %).
LEAST, SURE = 3, 0.4
SHORTEST, LONGEST = 3, 6
#: Weight of a phrase of so many words; longer ones have that of the longest.
WEIGHTS = {3: 0.6, 4: 1.1}


def lower_bound(hits: int, of: int, z: float = 1.645) -> float:
    """Wilson's lower bound of a share."""
    p, zz = hits / of, z * z / of
    return (p + zz / 2 - z * math.sqrt((p * (1 - p) + zz / 4) / of)) / (1 + zz)


def learn(documents: Iterable[tuple[list[list[str]], str]], categories: tuple[str, ...]) -> list[tuple[tuple[str, ...], str, float]]:
    """(words, category, weight) of documents given as sentences of words with the category the raters gave them."""
    docs = list(documents)
    good: set[tuple[str, ...]] = set()
    candidates: list[tuple[float, tuple[str, ...], str, set[int]]] = []
    for n in range(1, LONGEST + 1):
        by: dict[str, Counter] = {c: Counter() for c in categories}
        grams = [{tuple(s[i : i + n]) for s in sentences for i in range(len(s) - n + 1) if n == 1 or (tuple(s[i : i + n - 1]) in good and tuple(s[i + 1 : i + n]) in good)} for sentences, _ in docs]
        for g, (_, c) in zip(grams, docs, strict=True):
            if c in by:
                by[c].update(g)
        good = {g for k in by.values() for g, x in k.items() if x >= LEAST}
        if not good:
            break
        if n < SHORTEST:
            continue
        total = Counter(x for g in grams for x in g & good)
        sure = {(g, c): b for c, k in by.items() for g, x in k.items() if x >= LEAST and (b := lower_bound(x, total[g])) >= SURE}
        held: dict[tuple[tuple[str, ...], str], set[int]] = {k: set() for k in sure}
        for i, (g, (_, c)) in enumerate(zip(grams, docs, strict=True)):
            for x in g & good:
                if (x, c) in held:
                    held[x, c].add(i)
        candidates += [(b, *k, held[k]) for k, b in sure.items()]
    candidates.sort(key=lambda x: (-x[0], -len(x[1]), x[1:3]))
    explained: dict[str, set[int]] = {c: set() for c in categories}
    pairs: dict[tuple[str, ...], list[tuple[str, set[int]]]] = {}  # two words of a phrase taken: its category and documents
    taken = []
    for later in (False, True):  # first what explains, then what overlaps it
        for _, g, c, where in candidates:
            own = [g[i : i + 2] for i in range(len(g) - 1)]
            if later:
                if (g, c) in taken or not any(k == c and len(where & d) >= 0.8 * len(where) for p in own for k, d in pairs.get(p, ())):
                    continue
            elif (new := len(where - explained[c])) < LEAST and (new < LEAST - 1 or len(where) < 2 * LEAST):
                continue
            else:
                explained[c] |= where
                for p in own:
                    pairs.setdefault(p, []).append((c, where))
            taken.append((g, c))
    return [(g, c, WEIGHTS.get(len(g), WEIGHTS[max(WEIGHTS)])) for g, c in sorted(taken)]


def sentences(tokens: list[str], ends: set[str], name: Callable[[str], str]) -> list[list[str]]:
    """Sentences of words; a token with a figure is no word and parts a run."""
    out: list[list[str]] = [[]]
    for t in tokens:
        w = "" if t in ends else name(t)
        if not w or any(c.isdigit() for c in w):
            out.append([])
        else:
            out[-1].append(w)
    return [s for s in out if s]
