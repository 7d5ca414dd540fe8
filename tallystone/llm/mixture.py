"""Mixing sources to target weights (problem 8).

The token stream of each source is cut into blocks of a fixed number of tokens. The mixture is a number of slots, in output
shards: each shard draws how many of its slots go to each source (multinomial, from the shard's own random numbers); the
slots of a source count on through the shards, and slot k reads block permutation(k mod blocks) of round k div blocks, a
pseudorandom permutation that needs no table. Slots and blocks then meet by index in an equi-join.

The draws of all shards together miss the targets by the usual scatter. What a source was drawn beyond its target goes,
slot by slot, to the sources drawn too seldom, so the totals are exact to a block. No source is repeated more often than
allowed: the number of slots follows from the scarcest source. The last block of a source may be shorter than the others.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.runtime import cut, maybe_broadcast, spread_rows, stage

#: Where the vocabulary files of public tokenizers lie, and which is used.
TOKENIZERS = os.environ.get("TALLYSTONE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern of that byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_TOKENS, SHARD_SLOTS, SEED = 256, 1024, 17
#: Documents of one source in one bucket of the running total.
BUCKET_DOCUMENTS = 20_000


def source_name(c: Column) -> Column:
    """Sources that differ in case, surrounding blanks or - for _ are the same."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), "-", "_")


def token_counter(tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    import tiktoken

    with open(f"{tokenizers}/{vocabulary}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text)) if text else 0


def token_counts(documents: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source (name), n_tokens of whole texts; null and empty texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = token_counter(tokenizers, vocabulary)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": np.fromiter((count(t) for t in b["text"]), np.int64, len(b))})

    slim = documents.select("doc_id", source_name(F.col("source")).alias("source"), "text").where(F.col("source").isNotNull())
    return spread_rows(slim).mapInPandas(run, "doc_id long, source string, n_tokens long")


def offsets(counts: DataFrame) -> DataFrame:
    """source, doc_id, n_tokens, start: place of each document's first token in the stream of its source, in an order
    given by a hash. A running total in two steps, so no source is in one task."""
    c = counts.where(F.col("n_tokens") > 0).withColumn("h", F.xxhash64("doc_id"))
    buckets = max(1, -(-c.count() // BUCKET_DOCUMENTS))
    c = c.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sums = c.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("s"))
    before = sums.select("source", "bucket", (F.sum("s").over(W.partitionBy("source").orderBy("bucket")) - F.col("s")).alias("before"))
    inside = F.sum("n_tokens").over(W.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, -1))
    return c.withColumn("inside", F.coalesce(inside, F.lit(0))).join(maybe_broadcast(before), ["source", "bucket"]).select("source", "doc_id", "n_tokens", (F.col("before") + F.col("inside")).alias("start"))


def blocks(placed: DataFrame, size: int = BLOCK_TOKENS) -> DataFrame:
    """source, block, doc_id, first, last: the part [first, last) of a document's tokens that lies in a block of its
    source. Every token of every document is in exactly one block."""
    end = F.col("start") + F.col("n_tokens")
    b = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((end - 1) / size))))
    return b.select("source", "block", "doc_id", (F.greatest(F.col("block") * size, "start") - F.col("start")).alias("first"), (F.least((F.col("block") + 1) * size, end) - F.col("start")).alias("last"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    for s, m in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(s))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def permute(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: a Feistel network over the next power of four, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = k.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        a, b = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(4):
            a, b = b, a ^ (_mix(b + np.uint64(((key * 4 + r + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)) & mask)
        out[todo] = (a << np.uint64(half)) | b
        todo[todo] = out[todo] >= n
    return out.astype(np.int64)


def plan(available: dict[str, int], targets: dict[str, tuple[float, int]], size: int = BLOCK_TOKENS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The mixture's sources in order, their shares, and the slots of each. Sources without tokens drop out and the others'
    shares are scaled up to one."""
    sources = sorted(s for s, (share, repeats) in targets.items() if available.get(s, 0) > 0 and share and share > 0 and repeats and repeats > 0)
    if not sources:
        return [], np.zeros(0), np.zeros(0, np.int64)
    share = np.array([targets[s][0] for s in sources], float)
    share /= share.sum()
    allowed = np.array([-(-available[s] // size) * targets[s][1] for s in sources], np.int64)
    slots = max(1, int(np.floor((allowed / share).min() + 1e-9)))
    want = np.floor(share * slots + 1e-9).astype(np.int64)
    for k in np.argsort(-(share * slots - want), kind="stable")[: slots - want.sum()]:  # the largest remainders
        want[k] += want[k] < allowed[k]
    return sources, share, np.minimum(want, allowed)


def settle(i: np.ndarray, k: int, drawn: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Source and number of the slots drawn as numbers i of source k, after what is beyond a target was given away."""
    source, number = np.full(len(i), k), i.copy()
    extra = i >= want[k]
    if extra.any():
        over, under = np.maximum(drawn - want, 0), np.maximum(want - drawn, 0)
        place = over[:k].sum() + i[extra] - want[k]
        to = np.searchsorted(np.cumsum(under), place, "right")
        source[extra] = to
        number[extra] = drawn[to] + place - np.r_[0, np.cumsum(under)][to]
    return source, number


def draw(slots: int, share: np.ndarray, shard: int, seed: int = SEED) -> np.ndarray:
    """How many slots of a shard go to each source."""
    return np.random.Generator(np.random.Philox(key=[seed, shard])).multinomial(slots, share)


class Mixture:
    """A planned mixture. Of the corpus, only one total a target source reaches the driver."""

    def __init__(self, documents: DataFrame, targets: DataFrame, size: int = BLOCK_TOKENS, shard_slots: int = SHARD_SLOTS, seed: int = SEED, tokenizers: str = TOKENIZERS):
        spark = documents.sparkSession
        t = targets.where(F.col("source").isNotNull()).groupBy(source_name(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
        self.targets = cut(t)
        slim = documents.select("doc_id", "source", "text").withColumn("_s", source_name(F.col("source")))
        wanted = slim.join(maybe_broadcast(self.targets.select(F.col("source").alias("_s"))), "_s", "left_semi").select("doc_id", "source", "text")
        self.placed = stage(offsets(stage(token_counts(wanted, tokenizers), "tokens")), "placed")
        totals = self.placed.groupBy("source").agg(F.sum("n_tokens").alias("n"))
        chosen = self.targets.join(totals, "source").select("source", "target_share", "max_repeats", "n").collect()  # one row a target
        available, wants = {r["source"]: r["n"] for r in chosen}, {r["source"]: (r["target_share"], r["max_repeats"]) for r in chosen}
        self.size, self.shard_slots, self.seed = size, shard_slots, seed
        self.sources, self.share, self.want = plan(available, wants, size)
        self.slots = int(self.want.sum())
        self.n_blocks = {s: -(-available[s] // size) for s in self.sources}
        self.repeats = {s: wants[s][1] for s in self.sources}
        self.shards = -(-self.slots // shard_slots) if self.slots else 0
        self.spark = spark

    def _slots(self) -> DataFrame:
        """shard, slot, source, repeat, block. Shards are made by the tasks; where each source's count stands at the
        beginning of a group of shards is a running total. Only one total a source reaches the driver."""
        seed, total, per, share, want, sources, n_blocks, shards = self.seed, self.slots, self.shard_slots, self.share, self.want, self.sources, self.n_blocks, self.shards
        group = 256
        groups = -(-shards // group)

        def size_of(shard: int) -> int:
            return min(per, total - shard * per)

        def group_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(int(g), k, int(c)) for g in b["id"] for k, c in enumerate(sum(draw(size_of(s), share, s, seed) for s in range(g * group, min(shards, (g + 1) * group))))]
                yield pd.DataFrame(rows, columns=["g", "k", "c"])

        ids = self.spark.range(0, groups, 1, max(1, groups))
        counted = cut(ids.mapInPandas(group_counts, "g long, k int, c long"))
        drawn = np.zeros(len(sources), np.int64)
        for r in counted.groupBy("k").agg(F.sum("c").alias("c")).collect():  # one row a source
            drawn[r["k"]] = r["c"]
        before = counted.withColumn("before", F.sum("c").over(W.partitionBy("k").orderBy("g")) - F.col("c"))
        starts = before.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("k", "before"))).alias("b")).select("g", F.col("b.before").alias("before"))

        def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for g, at in zip(b["g"], b["before"], strict=True):
                    at = np.array(at, np.int64)
                    for shard in range(g * group, min(shards, (g + 1) * group)):
                        counts = draw(size_of(shard), share, shard, seed)
                        settled = [settle(at[k] + np.arange(c), k, drawn, want) for k, c in enumerate(counts)]
                        of, number = (np.concatenate([x[y] for x in settled]) for y in (0, 1))
                        at += counts
                        parts = []
                        for k, s in enumerate(sources):
                            i = number[of == k]
                            rounds = i // n_blocks[s]
                            for r in np.unique(rounds):
                                block = i[rounds == r] % n_blocks[s]
                                parts.append(pd.DataFrame({"source": s, "repeat": r + 1, "block": permute(block, n_blocks[s], seed * 1_000_003 + k * 1009 + int(r))}))
                        out = pd.concat(parts, ignore_index=True)
                        out.insert(0, "slot", np.random.Generator(np.random.Philox(key=[seed + 1, shard])).permutation(len(out)))
                        out.insert(0, "shard", shard)
                        yield out

        return starts.repartition(max(1, groups), "g").mapInPandas(fill, "shard long, slot long, source string, repeat long, block long")

    def selection(self) -> DataFrame:
        """shard, slot, source, repeat, block, doc_id, first_token, last_token: every part of a document that the mixture
        takes, with the round in which its block is used."""
        if not self.slots:
            return self.spark.createDataFrame([], "shard long, slot long, source string, repeat long, block long, doc_id long, first_token long, last_token long")
        b = blocks(self.placed, self.size).withColumnsRenamed({"first": "first_token", "last": "last_token"})
        return self._slots().join(b, ["source", "block"]).select("shard", "slot", "source", "repeat", "block", "doc_id", "first_token", "last_token")

    def shares(self) -> DataFrame:
        """source, target_share, actual_share, n_tokens, n_available, repeats_used, max_repeats for every target source.
        A source without documents has share 0."""
        sel = self.selection().groupBy("source").agg(F.sum(F.col("last_token") - F.col("first_token")).alias("n_tokens"), F.max("repeat").alias("repeats_used"))
        have = self.placed.groupBy("source").agg(F.sum("n_tokens").alias("n_available"))
        out = self.targets.join(have, "source", "left").join(sel, "source", "left").fillna(0, ["n_tokens", "n_available", "repeats_used"])
        everything = W.partitionBy(F.lit(1))  # one row a target source
        return out.select("source", "target_share", F.coalesce(F.try_divide("n_tokens", F.sum("n_tokens").over(everything)), F.lit(0.0)).alias("actual_share"), "n_tokens", "n_available", "repeats_used", "max_repeats")
