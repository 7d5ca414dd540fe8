"""References to records that don't exist (problem 3).

Parents and references are range-partitioned by key. In each range the parents are one array, sorted once; the references
of the range come after them in batches of columns, and the distinct keys of a batch are probed by binary search. A key that
very many rows refer to is split among tasks, its parent going along to each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.operators.buckets import ROWS_PER_TASK, hot_keys, split_hot, tasks_for
from tallystone.runtime import stage


def binary_search(keys: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Place of each key among the sorted parents, -1 where absent."""
    if not len(parents) or not len(keys):
        return np.full(len(keys), -1)
    at = np.searchsorted(parents, keys)
    inside = np.minimum(at, len(parents) - 1)
    return np.where(parents[inside] == keys, inside, -1)


def text_key(*cols: Column) -> Column:
    """One text of several columns, different for different values; null equals null."""
    parts = []
    for c in cols:
        t = c.cast("string")
        parts.append(F.coalesce(F.concat(F.lit("="), F.regexp_replace(t, "\u0001", "\u0001\u0001")), F.lit("")))
    return F.concat_ws(" \u0001 ", *parts)


def _probe_range(batches: Iterator[pa.RecordBatch], names: list[str], carried: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of one range, parents before references, each sorted by key."""
    held: list[pa.Table] = []
    parents, own = None, None
    for b in batches:
        t = pa.Table.from_batches([b])
        side = np.asarray(t["_side"])
        ahead = int(np.searchsorted(side, 1))  # parents come first
        if ahead:
            held.append(t.slice(0, ahead).select(["_key", *carried]))
        refs = t.slice(ahead)
        if not len(refs):
            continue
        if parents is None:
            own = pa.concat_tables(held) if held else t.slice(0, 0).select(["_key", *carried])
            parents, held = own["_key"].to_numpy(), []
        keys = refs["_key"].combine_chunks().dictionary_encode()
        at = binary_search(keys.dictionary.to_numpy(zero_copy_only=False), parents)[np.asarray(keys.indices)]
        place = pa.array(np.maximum(at, 0), mask=at < 0)
        cols = {n: refs[n] for n in names} | {"found": pa.array(at >= 0)}
        for n in carried:
            cols[n] = own[n].combine_chunks().take(place) if len(own) else pa.nulls(len(at), own[n].type)
        yield from pa.table(cols).to_batches()


def probe(references: DataFrame, ref_key: list[Column], parents: DataFrame, parent_key: list[Column], carry: list[str], spread_by: list[str], per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each reference row with `found` and, of its parent, the columns `carry` (null where none). parents has one row a
    key. Every reference comes back exactly once."""
    names = [n for n, _ in references.dtypes]
    kinds = dict(parents.dtypes)
    refs = references.withColumn("_key", text_key(*ref_key))
    par = parents.select(text_key(*parent_key).alias("_key"), *[F.col(c) for c in carry])
    n, hot = hot_keys(refs, ["_key"], per_task)
    many, few = split_hot(refs, par, ["_key"], hot, spread_by)
    both = few.withColumn("_side", F.lit(0)).unionByName(many.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    ranges = both.repartitionByRange(tasks_for(refs, n + par.count(), per_task), "_key", "_part").sortWithinPartitions("_side", "_key")
    schema = ", ".join(f"`{c}` {t}" for c, t in references.dtypes) + ", found boolean" + "".join(f", `{c}` {kinds[c]}" for c in carry)
    return ranges.mapInArrow(lambda b: _probe_range(b, names, carry), schema)


def _clean(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", ""))


def references(financials: DataFrame, ratios: DataFrame) -> DataFrame:
    """All references, one row each: table_name, column_name, record_id, cik, fiscal_year, fiscal_period, load_date, ref.
    Null and blank references are none."""
    keys = ["record_id", "cik", "fiscal_year", "fiscal_period", "load_date"]
    a = financials.select(F.lit("company_financials").alias("table_name"), F.lit("business_term_id").alias("column_name"), *keys, F.col("business_term_id").alias("ref"))
    b = ratios.select(F.lit("financial_ratios").alias("table_name"), *keys, F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("ref")) for c in ("numerator_bt_id", "denominator_bt_id")])).alias("r")).select("table_name", "r.column_name", *keys, "r.ref")
    return a.unionByName(b).withColumn("ref", _clean(F.col("ref"))).where(F.length("ref") > 0)


def terms(business_terms: DataFrame) -> DataFrame:
    """One row a name (business_term_id or legacy_id): name, term, added_on, retired_on."""
    t = business_terms.select(_clean(F.col("business_term_id")).alias("term"), "added_on", "retired_on", F.explode(F.array(F.struct(F.lit(0).alias("rank"), _clean(F.col("business_term_id")).alias("name")), F.struct(F.lit(1).alias("rank"), _clean(F.col("legacy_id")).alias("name")))).alias("n"))
    t = t.where(F.length("n.name") > 0)
    return t.groupBy(F.col("n.name").alias("name")).agg(F.min(F.struct("n.rank", "term", "added_on", "retired_on")).alias("t")).select("name", "t.term", "t.added_on", "t.retired_on")


def classify(financials: DataFrame, ratios: DataFrame, business_terms: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every reference with its kind: null where it is good.

    Null parts of a key equal null; a null load_date is neither before nor after any date; repeated rows stay (found
    makes them one). Empty tables: no references, or all missing."""
    r = probe(references(financials, ratios), [F.col("ref")], terms(business_terms), [F.col("name")], ["term", "added_on", "retired_on"], ["record_id", "load_date"], per_task)
    r = stage(r, "references")  # read four times below
    r = r.withColumnRenamed("found", "known").withColumn("own", F.when(~F.col("known"), "missing").when(F.col("retired_on") <= F.col("load_date"), "deleted").when(F.col("added_on") > F.col("load_date"), "late"))
    key = ["cik", "fiscal_year", "fiscal_period", "term"]
    components = r.where((F.col("table_name") == "company_financials") & F.col("known")).groupBy(*key).agg(F.min("load_date").alias("first_load"))
    base = r.drop("known", "added_on", "retired_on", "ref")
    open_ = base.where((F.col("table_name") == "financial_ratios") & F.col("own").isNull())
    done = base.where((F.col("table_name") != "financial_ratios") | F.col("own").isNotNull()).withColumnRenamed("own", "kind")
    p = probe(open_, [F.col(c) for c in key], components, [F.col(c) for c in key], ["first_load"], ["record_id", "column_name"], per_task)
    p = p.withColumn("kind", F.when(~F.col("found"), "no_component").when(F.col("first_load") > F.col("load_date"), "late_component"))
    return done.unionByName(p.select(*done.columns))


def found(financials: DataFrame, ratios: DataFrame, business_terms: DataFrame) -> DataFrame:
    """table_name, column_name, record_id, kind of every orphan, repeated rows once."""
    return classify(financials, ratios, business_terms).where(F.col("kind").isNotNull()).select("table_name", "column_name", "record_id", "kind").distinct()


def report(financials: DataFrame, ratios: DataFrame, business_terms: DataFrame) -> DataFrame:
    """Orphans by table, column, fiscal_year, fiscal_period and kind, with all references of that table and period."""
    c = classify(financials, ratios, business_terms)
    per = c.groupBy("table_name", "column_name", "fiscal_year", "fiscal_period", "kind").agg(F.countDistinct("record_id").alias("n_orphans"), F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(W.partitionBy("table_name", "column_name", "fiscal_year", "fiscal_period"))
    return per.withColumn("n_references", total).where(F.col("kind").isNotNull())


__all__ = ["binary_search", "classify", "found", "probe", "references", "report", "terms"]
