"""Words of a text, aside from case, punctuation, spacing, mark-up and invisible characters."""

from __future__ import annotations

import html
import re
import unicodedata

#: A tag of any length; "a < b" begins none.
_TAG = re.compile(r"</?[A-Za-z!?][^<>]*>")
_MARK = re.compile(r"[*_`#|~]+")
#: Inside a word these don't part it: 72.18, re-exports, it's, 1,018.
_INNER = re.compile(r"(?<=\w)[.,'’‐‑-](?=\w)")
#: A word parted at the end of a line.
_BREAK = re.compile(r"(?<=\w)[-‐‑][^\S\n]*\n\s*(?=\w)")
_WORD = re.compile(r"\w+")
_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿᠎͏]")


def plain(text: str) -> str:
    """Text without invisible characters, tags and mark-up, in one form and case."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    return _MARK.sub("", text).casefold()


def words(text: str | None) -> list[str]:
    """Null and empty texts have no words."""
    if not text:
        return []
    flat = plain(text)
    if "\n" in flat:
        flat = _BREAK.sub("", flat)
    return _WORD.findall(_INNER.sub("", flat))
