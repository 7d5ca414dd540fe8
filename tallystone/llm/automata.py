"""Levenshtein automata intersected with a lexicon trie.

The automaton of a token accepts every word within k edits (a swap of neighbours is one). Disguises are edits that cost
nothing: a sign that stands for a letter accepts that letter, a star accepts any, and a letter written three times or more
accepts one or several. Its states are sets of (places of the token read, edits), one bit each; running it over the trie
visits only prefixes that can still be accepted. The result of a token is kept, so the search runs once for each distinct
token of a worker.
"""

from __future__ import annotations

import re
import unicodedata

#: Letters of other scripts, and signs, that stand for Latin letters.
LOOKALIKES = str.maketrans(dict(zip("аеорсхуіѕјкмнтвԁɡοανερτικ", "aeopcxyisjkmhtbdgoavepTik".lower(), strict=True)))
LEET = {"@": "a", "4": "a", "3": "e", "1": "il", "0": "o", "$": "s", "5": "s", "7": "t", "!": "il", "|": "il"}
_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿᠎͏]")
_SPELLED = [re.compile(r"(?<!\w)\w(" + sign + r")\w(?:\1\w)+(?!\w)") for sign in (r"[.\-_*·]", " ")]
_TAG = re.compile(r"</?[A-Za-z!?][^<>]*>")
_TOKEN = re.compile("\u200b?[\\w@$*!|']*[\\w*][@$]*|[.!?;:\n]")
_RUN = re.compile(r"(.)\1{2,}")
#: Certainty of a misspelled word: a full phrase (1.2), an insult of a group (1.1) and an addressed insult (0.55 + 0.5) still reach 1.
MISSPELLED = 0.92
#: Of a misspelled word of four letters, and of a mask that leaves one letter: flags only with other words of its phrase or further cues.
GUESSED = 0.75


def bare(text: str) -> str:
    """Lower case, one form, no accents, no invisible characters, look-alikes as Latin letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))
        text = "".join(c for c in text if not unicodedata.combining(c)).replace("’", "'")
    text = text.casefold()
    return text if text.isascii() else text.translate(LOOKALIKES)


def tokens(text: str | None) -> list[str]:
    """Tokens and sentence ends of a text; spelled-out words (s c u m, s.c.u.m) are put together."""
    if not text:
        return []
    t = bare(_TAG.sub(" ", text) if "<" in text else text)
    for spelled in _SPELLED:
        t = spelled.sub(_joined, t)
    return _TOKEN.findall(t)


def _joined(m: re.Match) -> str:
    """A word spelled out letter by letter, marked as such. A leading a or i may be a word of its own: it also stays."""
    sign, text = m.group(1), m.group(0)
    alone = text[0] + " " if sign == " " and text[0] in "ai" else ""
    return alone + "\u200b" + text.replace(sign, "")


class LevenshteinAutomaton:
    """A state holds, for each number of edits, the places in the word as bits, and the places where a swap was begun."""

    def __init__(self, word: str, k: int, disguised: bool = False):
        """disguised: signs, stars and runs in the word stand for letters at no cost."""
        self.loop = 0
        if disguised:
            short, runs = [], []
            for m in re.finditer(r"([^*])\1{2,}|.", word, re.DOTALL):
                short.append(m[0][0])
                runs.append(len(m[0]) > 1)
            self.loop = sum(1 << i for i, x in enumerate(runs) if x)
            word = "".join(short)
        self.k, self.end, self.full = k, 1 << len(word), (2 << len(word)) - 1
        self.at: dict[str, int] = {}
        self.any = 0
        for i, c in enumerate(word):
            if disguised and c == "*":
                self.any |= 1 << i
            for x in LEET.get(c, c) if disguised else c:
                self.at[x] = self.at.get(x, 0) | 1 << i

    def start(self) -> tuple:
        return tuple((2 << e) - 1 & self.full for e in range(self.k + 1)) + (0,) * self.k

    def step(self, state: tuple, letter: str) -> tuple:
        k, at = self.k, self.at.get(letter, 0) | self.any
        hit = state[0] & at
        new, swaps = [hit << 1 | hit & self.loop], []
        for e in range(1, k + 1):
            less = state[e - 1]
            hit = state[e] & at
            new.append((hit << 1 | hit & self.loop | less | less << 1 | new[-1] << 1 | (state[k + e] & at) << 2) & self.full)
            swaps.append(less & at >> 1)
        return (*new, *swaps)

    def accepts(self, state: tuple) -> bool:
        return any(places & self.end for places in state[: self.k + 1])

    def alive(self, state: tuple) -> bool:
        return any(state)


class Trie:
    END = ""

    def __init__(self, lexicon: set[str], ordinary: frozenset[str] = frozenset(), short: frozenset[str] = frozenset()):
        """short: the words of four letters whose misspellings are looked for; those of others are too often other words."""
        self.short = short
        self.root: dict = {}
        self.ordinary = ordinary - lexicon
        for w in lexicon:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[self.END] = w
        self.words = lexicon
        self.longest = max(map(len, lexicon), default=0)
        self.cache: dict[str, dict[str, float]] = {}

    def near(self, word: str, k: int, anywhere: bool = False, disguised: bool = False) -> set[str]:
        """Words within k edits that begin with the same letter, or with any (anywhere); see LevenshteinAutomaton."""
        a, out = LevenshteinAutomaton(word, k, disguised), set()
        if a.end.bit_length() - 1 - k > self.longest:
            return out  # longer than any word by more than k
        node = self.root if anywhere else self.root.get(word[:1])
        stack = [(node, a.start() if anywhere else a.step(a.start(), word[0]))] if node is not None else []
        while stack:
            node, state = stack.pop()
            for c, nxt in node.items():
                if c == self.END:
                    if a.accepts(state):
                        out.add(nxt)
                    continue
                s = a.step(state, c)
                if a.alive(s):
                    stack.append((nxt, s))
        return out

    def masked(self, pattern: str) -> set[str]:
        """Words of the pattern's length that agree with its letters; * stands for any letter."""
        return self.near(pattern, 0, True, True)

    def match(self, token: str) -> dict[str, float]:
        """Lexicon words that a token stands for, with a certainty: 1 as written or undone disguise, less if misspelled."""
        got = self.cache.get(token)
        if got is None:
            if len(self.cache) > 500_000:
                self.cache.clear()
            got = self.cache[token] = self._match(token)
        return got

    def _match(self, token: str) -> dict[str, float]:
        out: dict[str, float] = {}
        spelled = token.startswith("​")
        core = token.lstrip("​").strip("'")  # its signs at the ends may be letters: !diot, f***
        t = core.strip("*!|@$'")
        if not t:
            return out
        if t in self.words:
            return {t: 1.0}
        forms = {t, core}
        if spelled and len(t) > 3:
            forms.add(t[1:])
        for f in forms:
            if f in self.words:
                out[f] = 1.0
        if out:
            return out
        for f in forms:  # disguises: edits that cost nothing
            if not f.isalpha() or _RUN.search(f):
                letters = sum(c.isalpha() for c in f)
                shown = len(f) - f.count("*")
                if not letters or "*" in f and t in self.ordinary or not (shown >= 2 or shown == 1 and 4 <= len(f) <= 6 and f[0] != "*"):
                    continue  # figures; a mark of a footnote or of emphasis; next to nothing shown
                for w in self.near(f, 0, True, True):
                    out[w] = max(out.get(w, 0.0), 1.0 if shown >= 2 else GUESSED)
        if out or "*" in t:
            return out
        for f in forms:
            f = _RUN.sub(r"\1", f)
            if len(f) >= 3 and f.isalpha() and f not in self.ordinary:
                for w in self.near(f, 1 if len(f) < 11 else 2, anywhere=True):
                    if len(w) >= 5 and len(f) >= 5:
                        out[w] = max(out.get(w, 0.0), MISSPELLED)
                    elif len(w) >= 5 and len(f) == 4 or w in self.short:
                        out[w] = max(out.get(w, 0.0), GUESSED)
        return out
