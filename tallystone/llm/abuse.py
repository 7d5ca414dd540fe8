"""Abusive, hateful or sexual content (problem 9).

Tokens are matched by Levenshtein automata over the trie of the lexicon; phrases and cues found within a window add up
to a score for each category, from which quotation, report and remarks on oneself are taken off. The lexicon is general;
phrases of the corpus at hand are learned from a bounded sample of labelled documents and join the trie. One pass over
the documents, without a shuffle, gives every document its scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm import lexicon as L
from tallystone.llm.automata import Trie, tokens
from tallystone.llm.phrases import learn, sentences
from tallystone.runtime import cut, spread_rows

CATEGORIES = ("abuse", "hate", "sexual")
THRESHOLD = 1.0
#: Words on either side within which cues belong together.
WINDOW, NEAR = 14, 8
_ENDS = set(".!?;:\n")


def _plural(words: list[str]) -> list[str]:
    return words + [w + "s" for w in words if not w.endswith("s")]


class Scorer:
    """Built once for each worker."""

    def __init__(self, learned: Iterable[tuple[tuple[str, ...], str, float]] = ()):
        """learned: phrases of the categories beside the lexicon (see phrases)."""
        self.insults, self.sharp, self.address = set(_plural(L.INSULTS)), set(L.SHARPENERS), set(L.ADDRESS)
        self.phrases: list[tuple[list[str], str, float]] = []
        add = lambda texts, kind, weight: self.phrases.extend((p.split(), kind, weight) for p in texts)
        for weight, texts in L.ABUSE.items():
            add(texts, "abuse", weight)
        for weight, texts in L.SEXUAL.items():
            add(texts, "sexual", weight)
        add(L.GROUPS, "group", 1.0)
        add(L.CONTEMPT, "contempt", 1.0)
        add(_plural(L.SLURS), "slur", 1.1)
        add(L.SELF, "self", 1.0)
        add(L.OPENERS, "opener", 0.5)
        own = {"abuse": "told", "hate": "hated", "sexual": "shown"}
        self.phrases += [(list(words), own[c], weight) for words, c, weight in learned]
        self.reporting = set(L.REPORTING)
        lexicon = self.insults | self.sharp | self.address | self.reporting | {"piece", "of"}
        for words, _, _ in self.phrases:
            lexicon |= set(words) - {"~"}
        self.trie = Trie(lexicon, frozenset(L.ORDINARY), frozenset(L.SHORT))
        self.first: dict[str, list[tuple[list[str], str, float]]] = {}
        for p in self.phrases:
            self.first.setdefault(p[0][0], []).append(p)
        #: A text can reach the threshold only if it holds all words of one of these, or of two of the learned phrases that
        #: count less; they are looked up by their least common word.
        needed = {frozenset({w}): True for w in self.insults}
        for words, kind, weight in self.phrases:
            if kind in ("abuse", "sexual", "contempt", "slur", "told", "hated", "shown"):
                held = frozenset(words) - {"~"}
                needed[held] = needed.get(held, False) or weight >= THRESHOLD or kind not in ("told", "hated", "shown")
        common = set(L.COMMON)
        self.telling: dict[str, list[tuple[frozenset[str], bool]]] = {}
        for words, alone in needed.items():
            self.telling.setdefault(max(words, key=lambda w: (w not in common, len(w), w)), []).append((words, alone))
        #: Tokens seen so far, and those among them that stand for words of the lexicon.
        self.known: set[str] = set()
        self.stand: dict[str, tuple[str, ...]] = {}

    def _can_score(self, toks: list[str]) -> bool:
        here = set(toks)
        if len(self.known) > 500_000:
            self.known.clear()
            self.stand.clear()
        for t in here - self.known:
            self.known.add(t)
            if m := self.trie.match(t):
                self.stand[t] = tuple(m)
        words = {w for t in here & self.stand.keys() for w in self.stand[t]}
        weak = 0
        for w in words & self.telling.keys():
            for p, alone in self.telling[w]:
                if p <= words:
                    weak += 1
                    if alone or weak > 1:
                        return True
        return False

    def scores(self, text: str | None) -> tuple[float, float, float]:
        """abuse, hate and sexual score. Null and empty texts score 0, and so do texts that can't reach the threshold."""
        toks = tokens(text)
        if not self._can_score(toks):
            return 0.0, 0.0, 0.0
        match = self.trie.match
        found = [match(t) for t in toks]
        seen: list[tuple[int, dict[str, float]]] = []
        toks_at: list[str] = []
        place = 0
        for t, d in zip(toks, found, strict=True):
            if t in _ENDS:
                place += 1 if t in ".!?\n" else 0
            else:
                seen.append((place, d))
                toks_at.append(t)
        n = len(seen)
        marks: dict[str, list[tuple[int, int, float]]] = {}
        for i, (_, d) in enumerate(seen):
            for w, sure in d.items():
                for words, kind, weight in self.first.get(w, ()):
                    end = self._follow(seen, i, words)
                    if end is not None:
                        of = len(words) - words.count("~")
                        marks.setdefault(kind, []).append((i, end, weight * (sure + self._sure) / of))
        best = {"abuse": 0.0, "hate": 0.0, "sexual": 0.0}

        def off(i: int) -> float:
            """What context takes off a cue at word i."""
            lost = 0.0
            for j in range(max(0, i - WINDOW), min(n, i + WINDOW + 1)):
                if seen[j][0] == seen[i][0] and any(w in self.reporting and s == 1.0 for w, s in seen[j][1].items()):
                    lost = 0.8
            if any(e < i <= e + 3 and seen[e][0] == seen[i][0] for _, e, _ in marks.get("self", ())):
                lost += 0.8
            return lost

        groups, contempt = marks.get("group", []), marks.get("contempt", [])
        hated: list[tuple[int, int]] = []
        for a, _, w in marks.get("slur", ()):
            best["hate"] = max(best["hate"], w - off(a))
        for a, b, s in groups:
            for c, e, w in contempt:
                if max(a - e, c - b) <= WINDOW and seen[a][0] <= seen[c][0] + 1 and seen[c][0] <= seen[a][0] + 1:
                    best["hate"] = max(best["hate"], 1.2 * min(1.0, s * w + 0.1) - off(c))
                    hated.append((min(a, c), max(b, e)))
        best["hate"] = max(best["hate"], self._together(marks.get("hated", []), off, seen))
        best["abuse"] = self._together(marks.get("told", []), off, seen)
        by_sentence: dict[int, float] = {}
        for a, _, w in marks.get("abuse", ()):
            by_sentence[seen[a][0]] = max(by_sentence.get(seen[a][0], 0.0), w - off(a))
        for i, (s, d) in enumerate(seen):
            if not d:
                continue
            sure = max((v for w, v in d.items() if w in self.insults), default=0.0)
            if not sure or any(a <= i <= b + 6 for a, b in hated) and not self._addressed(seen, i):
                continue
            target = any(a <= i and i - b <= 5 and seen[a][0] == s for a, b, _ in groups)  # "immigrants are morons"
            score = 0.55 * sure
            score += 0.3 if any(w in self.sharp for j in range(max(0, i - 4), i) if seen[j][0] == s for w in seen[j][1]) else 0.0
            score += 0.5 if self._addressed(seen, i) else 0.0
            score += max((w for a, b, w in marks.get("opener", ()) if seen[a][0] == s and abs(a - i) <= NEAR), default=0.0)
            score += max((w for a, b, w in marks.get("abuse", ()) if abs(seen[a][0] - s) <= 0), default=0.0)
            score -= off(i)
            if target and not self._addressed(seen, i):
                best["hate"] = max(best["hate"], 1.1 * sure - off(i))
            else:
                by_sentence[s] = max(by_sentence.get(s, 0.0), score)
        best["abuse"] = max([best["abuse"], *by_sentence.values()])
        sexual: dict[int, tuple[float, tuple[str, ...]]] = {}  # a word counts once, by its strongest mark
        for a, e, w in marks.get("sexual", ()):
            sexual[a] = max(sexual.get(a, (0.0, ())), (w - off(a), tuple(toks_at[a : e + 1])))
        for a in sexual:
            near: dict[tuple[str, ...], float] = {}  # a repeated term adds nothing
            for b, (w, words) in sexual.items():
                if a <= b <= a + WINDOW:
                    near[words] = max(near.get(words, 0.0), w)
            best["sexual"] = max(best["sexual"], sum(near.values()))
        best["sexual"] = max(best["sexual"], self._together(marks.get("shown", []), off, seen))
        return best["abuse"], max(0.0, best["hate"]), best["sexual"]

    @staticmethod
    def _together(marks: list[tuple[int, int, float]], off, seen) -> float:
        """Learned phrases of one sentence add up; what overlaps counts once, by the strongest."""
        best, group = 0.0, {}
        for a, e, w in sorted(marks, key=lambda m: -m[2]):
            s = group.setdefault(seen[a][0], [])
            w -= off(a)
            if w > 0:
                s.append((a, e, w if not any(a <= y and x <= e for x, y, _ in s) else w / 3))
        for s in group.values():
            best = max(best, sum(w for _, _, w in s))
        return best

    def _follow(self, seen: list[tuple[int, dict[str, float]]], i: int, words: list[str]) -> int | None:
        """Last word of the phrase that begins at i, None if it isn't there. The certainties of its words after the first are summed in _sure."""
        j, gap = i + 1, 0
        self._sure = 0.0
        for w in words[1:]:
            if w == "~":
                gap = 3
                continue
            hit = None
            for k in range(j, min(len(seen), j + gap + 1)):
                if w in seen[k][1]:
                    hit = k
                    break
            if hit is None:
                return None
            self._sure += seen[hit][1][w]
            j, gap = hit + 1, 0
        return j - 1

    def _addressed(self, seen: list[tuple[int, dict[str, float]]], i: int) -> bool:
        s = seen[i][0]
        return any(seen[j][0] == s and any(w in self.address and v == 1.0 for w, v in seen[j][1].items()) for j in range(max(0, i - NEAR), min(len(seen), i + NEAR + 1)) if j != i)


#: Labelled documents that phrases are learned from: a bounded sample, by a hash of the document's number, and the
#: characters of text it may have in all.
LABELLED, LABELLED_CHARACTERS = 10_000, 32_000_000


def _words(text: str | None, trie: Trie) -> list[list[str]]:
    """Sentences of a document with disguises undone where they hide words of the lexicon."""

    def name(t: str) -> str:
        hit = trie.match(t)
        sure = [w for w, v in hit.items() if v == max(hit.values())]
        return sure[0] if len(sure) == 1 else t.strip("\u200b'*")

    return sentences(tokens(text), _ENDS, name)


def learned(documents: DataFrame, labels: DataFrame | None) -> list[tuple[tuple[str, ...], str, float]]:
    """Phrases learned from the labelled documents: of each the category most raters gave (ties: the first by name). Copies
    of a text count once; labels of documents that aren't there, null categories and empty tables teach nothing."""
    if labels is None:
        return []
    votes = labels.where(F.col("doc_id").isNotNull() & F.col("category").isNotNull()).groupBy("doc_id", "category").agg(F.count(F.lit(1)).alias("n"))
    given = votes.groupBy("doc_id").agg(F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("category"))
    few = cut(given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))  # the sample of the fit; documents are all scored
    texts = documents.select("doc_id", "text").join(F.broadcast(few), "doc_id").where(F.length("text") > 0).groupBy("text").agg(F.min("category").alias("category"), F.min("doc_id").alias("doc_id"))
    trie, size, docs = Scorer().trie, 0, []
    for r in texts.select("doc_id", "text", "category").orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        size += len(r["text"])
        if docs and size > LABELLED_CHARACTERS:
            break
        docs.append((_words(r["text"], trie), r["category"]))
    return learn(docs, CATEGORIES)


def _score_batches(batches: Iterator[pd.DataFrame], phrases: list) -> Iterator[pd.DataFrame]:
    scorer = Scorer(phrases)
    for b in batches:
        s = [scorer.scores(t) for t in b["text"]]
        yield pd.DataFrame({"doc_id": b["doc_id"]} | {c: [x[k] for x in s] for k, c in enumerate(CATEGORIES)})


def scores(documents: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """doc_id, abuse, hate, sexual (0 and up; THRESHOLD flags), one row for each row of documents. labels (doc_id,
    category): what phrases are learned from, none if absent."""
    phrases = learned(documents, labels)
    return spread_rows(documents.select("doc_id", "text")).mapInPandas(lambda b: _score_batches(b, phrases), "doc_id long, abuse double, hate double, sexual double")


def found(documents: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """doc_id, category: a row for each category whose score reaches the threshold.

    Null and empty texts score 0; texts are read whole; repeated rows give one row; an empty table gives none."""
    pairs = F.array(*[F.when(F.col(c) >= THRESHOLD, F.lit(c)) for c in CATEGORIES])
    return scores(documents, labels).select("doc_id", F.explode(F.filter(pairs, lambda x: x.isNotNull())).alias("category")).distinct()


def rates(documents: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Per source (spelling aside; null is a source of its own): n_documents, and the share flagged in each category."""
    from tallystone.llm.mixture import source_name

    phrases = learned(documents, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(phrases)
        for b in batches:
            s = [scorer.scores(t) for t in b["text"]]
            yield pd.DataFrame({"source": b["source"]} | {c: [float(x[k] >= THRESHOLD) for x in s] for k, c in enumerate(CATEGORIES)})

    flags = spread_rows(documents.select(source_name(F.col("source")).alias("source"), "text")).mapInPandas(run, "source string, abuse double, hate double, sexual double")
    return flags.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), *[F.avg(c).alias(f"{c}_rate") for c in CATEGORIES])
