"""Implausible readings (problem 6): an isolation forest for each series, and explicit rules.

A series is company, concept, unit and class of period length, ordered by period end. Rows are first combined to one line
a reading (a value stated for a period, however often), then whole series stream through the Python workers, sorted, many
at a time; the forests of all series of a chunk grow together as array operations. Every reading gets a score: its
isolation by level, difference, season and run length within its own series. The forest decides which readings can be
spikes; that these lie far from both neighbouring periods is checked afterwards. Only flagged readings go back to the rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.operators.profile import FIRST_END
from tallystone.runtime import key128, maybe_broadcast, stage

#: Amounts that can't be negative.
NEVER_NEGATIVE = ["Assets", "CashAndCashEquivalentsAtCarryingValue", "AccountsReceivableNetCurrent", "InventoryNet", "PropertyPlantAndEquipmentNet", "Goodwill", "CommonStockSharesOutstanding", "EntityCommonStockSharesOutstanding"]
LIMIT = 1e15
TREES, DEPTH, SEED = 32, 8, 20240607
#: Readings that the forest of their series scores below this are never spikes (a usual reading scores 0.46, one in a
#: hundred 0.72). Chosen on the tables of sf0.1, as were the two factors below.
SUSPECT = 0.72
#: A spike lies this many times the usual scatter (median absolute change) off both neighbours ...
FAR = 6.0
#: ... or this many times, where it is a neighbour's value times a power of ten (an error of scale).
FAR_SCALED = 4.5
RUN, CHANGING, OTHERS, LEAST = 5, 0.8, 3, 6


def _bad_end() -> Column:
    end = F.col("end_date")
    return end.isNull() | (end < F.lit(FIRST_END).cast("date")) | F.coalesce(end > F.col("filed_date"), F.lit(False)) | F.coalesce(end < F.col("start_date"), F.lit(False))


def _impossible() -> Column:
    v = F.col("val")
    base = F.regexp_replace("concept", r"Unit\d+$", "")
    return F.isnan(v) | (F.abs(v) > LIMIT) | ((v < 0) & base.isin(NEVER_NEGATIVE))


def _length_class() -> Column:
    """0 an instant, else the period's length in quarters of a year, -1 - months for other lengths."""
    days = F.datediff("end_date", "start_date")
    return F.when(days.isNull(), 0).when(days.between(60, 120), 1).when(days.between(150, 210), 2).when(days.between(240, 300), 3).when(days.between(330, 400), 4).otherwise(-1 - F.floor(days / 30))


def harmonic(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    m = np.maximum(n, 2)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m))


def forest(series: np.ndarray, x: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> np.ndarray:
    """Isolation score of every row of x within its series. series: ascending numbers from 0. Each series has its own
    trees, drawn from its own stream of random numbers, so scores don't depend on which series share a chunk."""
    n = len(series)
    if not n:
        return np.zeros(0)
    size = np.bincount(series)
    start = np.r_[0, np.cumsum(size)[:-1]]
    total = np.zeros(n)
    for t in range(trees):
        order, node, left = np.arange(n), series.astype(np.int64), np.ones(n, bool)
        path = np.zeros(n)
        label = np.ones(n, np.uint64)
        at = np.arange(n)  # positions of the points still to be split
        for level in range(depth):
            if not len(at):
                break
            head = np.r_[0, np.flatnonzero(node[1:] != node[:-1]) + 1]
            count = np.diff(np.r_[head, len(node)])
            # a draw is a hash of tree, place in the tree and first member's place in its own series
            lead = at[head]
            h = (label[lead] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((t + 1) * 0xBF58476D1CE4E5B9 + seed & 0xFFFFFFFFFFFFFFFF) ^ (size[series[lead]].astype(np.uint64) << np.uint64(32)) ^ (at[head] - start[series[lead]]).astype(np.uint64)
            for s in (30, 27, 31):
                h = (h ^ (h >> np.uint64(s))) * np.uint64(0x94D049BB133111EB)
            pick = (h % np.uint64(x.shape[1])).astype(int)
            share = ((h >> np.uint64(11)) & np.uint64(0xFFFFFFFF)).astype(float) / 2**32
            value = x[at, np.repeat(pick, count)]
            low, high = np.minimum.reduceat(value, head), np.maximum.reduceat(value, head)
            right = value > np.repeat(low + share * (high - low), count)
            path[at] += np.repeat((count > 1) & (high > low), count)
            label[at] = label[at] * np.uint64(2) + right
            node = np.repeat(np.arange(len(head)) * 2, count) + right
            go = np.argsort(node, kind="stable")
            at, node = at[go], node[go]
            sizes = np.bincount(node)[node]
            keep = sizes > 1
            if level == depth - 1:
                path[at] += harmonic(sizes)
            at, node = at[keep], node[keep]
        total += path
    return np.where(size[series] < 2, 0.5, 2.0 ** (-(total / trees) / np.maximum(harmonic(size), 1e-9)[series]))


def _by_series(series: np.ndarray, x: np.ndarray, q: float = 0.5) -> np.ndarray:
    """Quantile of each series without missing values; NaN where there is none."""
    out = np.full(series.max() + 1 if len(series) else 0, np.nan)
    ok = np.isfinite(x)
    s, v = series[ok], x[ok]
    if not len(s):
        return out
    o = np.lexsort((v, s))
    s, v = s[o], v[o]
    n = np.bincount(s, minlength=len(out))
    head = np.r_[0, np.cumsum(n)[:-1]]
    has = n > 0
    k = (n[has] - 1) * q
    a, b = np.floor(k).astype(int), np.ceil(k).astype(int)
    out[has] = v[head[has] + a] * (1 - (k - a)) + v[head[has] + b] * (k - a)
    return out


def _shift(series: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """The value k places before (k > 0) or after in the same series, else NaN."""
    out = np.full(len(x), np.nan)
    if abs(k) < len(x):
        if k > 0:
            same = series[k:] == series[:-k]
            out[k:][same] = x[:-k][same]
        else:
            same = series[:k] == series[-k:]
            out[:k][same] = x[-k:][same]
    return out


def backbone(series: np.ndarray, period: np.ndarray, val: np.ndarray) -> np.ndarray:
    """One value a period: of several readings the one nearest to the neighbouring periods. period: ascending numbers from
    0, readings of a period by value; series: that of each period."""
    first = np.r_[True, period[1:] != period[:-1]]
    low, high = val[first], val[np.r_[first[1:], True]]
    if len(low) == len(val):
        return val.copy()
    mid = (low + high) / 2
    around = np.nanmean(np.c_[tuple(_shift(series, mid, k) for k in (1, -1, 2, -2))], axis=1)
    near = np.nanmedian(np.c_[tuple(_shift(series, v, k) for k in (1, -1) for v in (low, high)) + (_shift(series, low, 2), _shift(series, low, -2))], axis=1)
    near = np.where(np.isfinite(near), near, np.where(np.isfinite(around), around, low))
    o = np.lexsort((np.abs(val - near[period]), period))
    return val[o][first]


def examine(series: np.ndarray, day: np.ndarray, val: np.ndarray) -> pd.DataFrame:
    """Whole series, one row a reading, by series, day and value: score, and whether it is a spike or stuck."""
    if not len(series):
        return pd.DataFrame({"score": np.zeros(0), "spike": np.zeros(0, bool), "stuck": np.zeros(0, bool)})
    with np.errstate(all="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore")  # of neighbours that are all absent
        new_period = np.r_[True, (series[1:] != series[:-1]) | (day[1:] != day[:-1])]
        period = np.cumsum(new_period) - 1
        own = series[new_period]  # series of each period
        x = backbone(own, period, val)
        before, after, year, ahead = (_shift(own, x, k) for k in (1, -1, 4, -4))
        scatter = _by_series(own, np.abs(x - before))[own]
        level = _by_series(own, x)[own]
        local = np.nanmedian(np.c_[before, after, _shift(own, x, 2), _shift(own, x, -2)], axis=1)
        n = np.bincount(own)[own]
        new_run = np.r_[True, own[1:] != own[:-1]] | ~(x == before)
        run = np.cumsum(new_run) - 1
        length = np.bincount(run)[run]
        unit = np.where(scatter > 0, scatter, np.maximum(np.abs(level), 1e-9))
        changes = np.bincount(own, weights=~new_run)[own]  # unchanged steps
        rest = (changes - (length - 1)) / np.maximum(n - length, 1)  # share of unchanged steps outside the run
        stuck = (length >= RUN) & (x != 0) & (n - length >= OTHERS) & (rest <= 1 - CHANGING)

        at = lambda v: v[period]
        off = np.where((val > at(before)) == (val > at(after)), np.minimum(np.abs(val - at(before)), np.abs(val - at(after))), 0.0)
        off = np.nan_to_num(off)
        jump = val - at(local)
        season = np.fmin(np.abs(val - at(year)), np.abs(val - at(ahead)))
        season = np.minimum(np.where(np.isfinite(season), season, np.abs(val - at(level))), np.abs(np.nan_to_num(jump)))
        measure = lambda v: np.clip(np.nan_to_num(v / at(unit)), -60.0, 60.0)
        score = forest(series, np.c_[measure(jump), measure(off), measure(season), measure(val - at(level)), np.log(at(length))])
        tens = np.log10(np.abs(val / ((at(before) + at(after)) / 2)))
        scaled = (np.abs(tens) > 0.5) & (np.abs(tens - np.round(tens)) < 0.12)
        far = off / at(unit)
        spike = (score >= SUSPECT) & (at(scatter) > 0) & (at(n) >= LEAST) & ((far >= FAR) | (scaled & (far >= FAR_SCALED)))
    return pd.DataFrame({"score": score, "spike": spike, "stuck": at(stuck) & (val == at(x))})


def _whole_series(batches: Iterator[pd.DataFrame], chunk: int = 50_000) -> Iterator[pd.DataFrame]:
    """Batches sorted by series, cut where a series ends."""
    held: list[pd.DataFrame] = []
    rows = 0
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        rows += len(b)
        if rows < chunk:
            continue
        whole = pd.concat(held, ignore_index=True)
        last = (whole["k1"].values == whole["k1"].values[-1]) & (whole["k2"].values == whole["k2"].values[-1])
        cut = int(np.argmax(last))
        if cut:
            yield whole.iloc[:cut]
        held, rows = [whole.iloc[cut:]], len(whole) - cut
    if rows:
        yield pd.concat(held, ignore_index=True)


def _examine_batches(batches: Iterator[pd.DataFrame], keep_all: bool) -> Iterator[pd.DataFrame]:
    for b in _whole_series(batches):
        k1, k2 = b["k1"].values, b["k2"].values
        series = np.r_[0, np.cumsum((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))]
        e = examine(series, b["day"].values, b["val"].values)
        base = b[["k1", "k2", "day", "val"]].reset_index(drop=True)
        if keep_all:
            yield base.assign(score=e["score"].values)
            continue
        yearly = b["yearly"].values
        yield pd.concat([base[e[kind].values & ~yearly].assign(kind=kind) for kind in ("spike", "stuck")], ignore_index=True)


def _keyed(df: DataFrame) -> DataFrame:
    k1, k2 = key128(F.col("cik"), F.col("concept"), F.col("unit"), F.col("_class"))
    return df.withColumn("_class", _length_class()).select("row_no", "val", (F.col("_class") == 4).alias("yearly"), k1.alias("k1"), k2.alias("k2"), F.datediff("end_date", F.lit("1970-01-01").cast("date")).alias("day"), F.coalesce(_bad_end(), F.lit(True)).alias("bad_end"), _impossible().alias("impossible"))


def _in_series(keyed: DataFrame) -> DataFrame:
    return keyed.where(F.col("val").isNotNull() & ~F.col("bad_end") & ~F.col("impossible"))


def _readings(keyed: DataFrame) -> DataFrame:
    """k1, k2, day, val, yearly: one row a reading, whole series together and in order. -0 is 0."""
    r = _in_series(keyed).groupBy("k1", "k2", "day", (F.col("val") + 0.0).alias("val")).agg(F.first("yearly").alias("yearly"))
    return r.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "day", "val")


def scores(df: DataFrame) -> DataFrame:
    """row_no, score of every reading (row with a value): the isolation score within its series, 0 to 1, about 0.5 for
    usual readings and for series of one. Impossible values score 1; readings whose period end violates its domain belong
    to no series and score null. Rows without a value have none."""
    keyed = _keyed(fresh_columns(df))
    r = _readings(keyed).mapInPandas(lambda b: _examine_batches(b, True), "k1 long, k2 long, day int, val double, score double")
    scored = _in_series(keyed).withColumn("val", F.col("val") + 0.0).join(r, ["k1", "k2", "day", "val"]).select("row_no", "score")
    rest = keyed.where(F.col("val").isNotNull() & (F.col("bad_end") | F.col("impossible")))
    return scored.unionByName(rest.select("row_no", F.when(F.col("impossible"), 1.0).alias("score")))


def found(df: DataFrame) -> DataFrame:
    """row_no, kind. impossible: by rule, for every row. spike: isolated by the forest of its series and confirmed by its
    distance from the neighbouring periods. stuck: by run length.

    Null values are never flagged; ties and repeated rows share one flag; of several values of a period each is judged; an
    empty table gives no row; series of fewer than six periods have no usual scatter and no spikes; yearly series are
    scored but never flagged."""
    keyed = _keyed(fresh_columns(df))
    impossible = keyed.where(F.col("impossible")).select("row_no", F.lit("impossible").alias("kind"))
    flags = maybe_broadcast(stage(_readings(keyed).mapInPandas(lambda b: _examine_batches(b, False), "k1 long, k2 long, day int, val double, kind string"), "flags"))
    odd = _in_series(keyed).withColumn("val", F.col("val") + 0.0).join(flags, ["k1", "k2", "day", "val"]).select("row_no", "kind")
    return impossible.unionByName(odd).distinct()


def fresh_columns(df: DataFrame) -> DataFrame:
    return df.select("row_no", "cik", "concept", "unit", "start_date", "end_date", "filed_date", "val")
