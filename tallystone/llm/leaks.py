"""Evaluation passages in documents by spaced-seed hashing (problem 7).

A seed looks at some positions of a short span of words and ignores the others (fixed masks). The masks are chosen so
that every passage of 20 or more words with at most one word in ten changed holds at least one seed whose positions are
all unchanged (proved by enumeration in the tests). Seeds of the test items are joined with seeds of the documents, and
each hit's alignment is verified exactly.

The test side comes in blocks of bounded size, each sent to all workers and joined with the whole corpus, so the corpus is
never shuffled and no number of items is too many. A document's words that are in no item of the block can't be part of a
seed, so most spans fall away as array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.words import words
from tallystone.runtime import spread_rows

#: Fixed masks: places of a span that count. Each clean run of seven words holds the first.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 6, 7), (0, 1, 2, 4, 5, 8))
LEAST, CHANGED = 20, 10
#: Words of test items in one block.
BLOCK_WORDS = 400_000
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], np.uint64)


def seeds(ids: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every span whose masked places hold words with ids above 0."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, int)
    ok = ids[mask[0] : n + mask[0]] > 0
    for m in mask[1:]:
        ok = ok & (ids[m : n + m] > 0)
    at = np.flatnonzero(ok)
    h = np.zeros(len(at), np.uint64)
    for k, m in enumerate(mask):
        h = (h ^ ids[at + m].astype(np.uint64) * _PRIMES[k % len(_PRIMES)]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h, at


def has_passage(same: np.ndarray, least: int = LEAST, changed: int = CHANGED) -> bool:
    """Is there a stretch of `least` or more places, its ends unchanged, of which at most one in `changed` differs?"""
    n = len(same)
    if n < least:
        return False
    score = np.r_[0, np.cumsum(np.where(same, 1, 1 - changed))]
    starts = np.where(same, score[:-1], np.iinfo(score.dtype).max)  # a stretch begins at an unchanged place
    lowest = np.minimum.accumulate(starts)
    ends = np.flatnonzero(same) + 1
    ends = ends[ends >= least]
    return bool(len(ends) and (score[ends] >= lowest[ends - least]).any())


class Block:
    """Some test items, ready to be searched for."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        self.vocabulary: dict[str, int] = {}
        self.item_ids = item_ids
        lists = [words(t) for t in texts]
        for w in lists:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.items = [np.array([self.vocabulary[x] for x in w], np.int32) for w in lists]
        h, item, at, mask = [], [], [], []
        for k, m in enumerate(MASKS):
            for i, ids in enumerate(self.items):
                a, b = seeds(ids, m)
                h.append(a ^ np.uint64(k))
                item.append(np.full(len(a), i))
                at.append(b)
        self.hash = np.concatenate(h) if h else np.zeros(0, np.uint64)
        o = np.argsort(self.hash, kind="stable")
        self.hash, self.item, self.at = self.hash[o], np.concatenate(item)[o] if item else o, np.concatenate(at)[o] if at else o

    def search(self, text: str | None) -> list[int]:
        """Ids of the items of which the text holds a passage."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words(text)), np.int32)
        if len(ids) < LEAST or np.count_nonzero(ids) < LEAST * (CHANGED - 2) // CHANGED or not len(self.hash):
            return []
        lines: set[tuple[int, int]] = set()
        for k, m in enumerate(MASKS):
            h, at = seeds(ids, m)
            h ^= np.uint64(k)
            lo, hi = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, "right")
            hit = np.flatnonzero(hi > lo)
            if len(hit):
                n = (hi - lo)[hit]
                places = np.repeat(lo[hit] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                lines.update(zip(self.item[places].tolist(), (np.repeat(at[hit], n) - self.at[places]).tolist(), strict=True))
        found: set[int] = set()
        for i, shift in lines:
            if i in found:
                continue
            item = self.items[i]
            a, b = max(0, -shift), min(len(item), len(ids) - shift)
            if b - a >= LEAST and has_passage(item[a:b] == ids[a + shift : b + shift]):
                found.add(i)
        return [self.item_ids[i] for i in found]


def blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items in blocks of bounded size; one block at a time is on the driver."""
    ids, texts, size = [], [], 0
    for r in items.where(F.col("item_id").isNotNull() & (F.length("item_text") > 0)).select("item_id", "item_text").orderBy("item_id").toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["item_text"])
        size += len(r["item_text"]) // 4
        if size >= block_words:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block(ids, texts)


def found(documents: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id of every document that holds a passage of 20 or more consecutive words of an item with at most
    one word in ten changed.

    Null and empty texts hold none; texts are read whole; copies each count; items of fewer than 20 words can't leak;
    no items or no documents give no row."""
    out = None
    slim = spread_rows(documents.select("doc_id", "text"))
    for block in blocks(items, block_words):
        shared = documents.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            b = shared.value
            for batch in batches:
                hits = [(d, i) for d, t in zip(batch["doc_id"], batch["text"], strict=True) for i in b.search(t)]
                yield pd.DataFrame(hits, columns=["doc_id", "item_id"]).astype("int64")

        one = slim.mapInPandas(run, "doc_id long, item_id long")
        out = one if out is None else out.unionByName(one)
    if out is None:
        return documents.sparkSession.createDataFrame([], "doc_id long, item_id long")
    return out.distinct()


def report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, suite, n_documents, first_doc_id of every item that leaked."""
    hits = found(documents, items).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.min("doc_id").alias("first_doc_id"))
    return hits.join(items.select("item_id", "suite"), "item_id").select("item_id", "suite", "n_documents", "first_doc_id")
