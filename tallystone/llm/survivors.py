"""One surviving record for each group of duplicates (problem 4).

Records of a group are ranked by trust, recency and a deterministic tie-break in one window order. Completeness counts
field by field: which fields of a record have a value is a mask of bits, and of the records of a group with one mask only
the first two in the order can matter (the first as survivor or donor, the second for the size of the group). So Spark
limits each group and mask before the shuffle (WindowGroupLimit): a group that holds a third of all rows reaches the
ranking task with at most two rows a mask from each map task, and a record is one narrow row throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.functions.names import spelling
from tallystone.runtime import key128

#: Texts that are no value.
PLACEHOLDERS = ["", "n/a", "-", "unknown"]
FIELDS = ["val", "business_term_id", "ticker", "fiscal_year_end"]
GROUP = ["_cik", "_start", "_end", "_concept", "_unit"]
ORDER = ["is_superseded", "filed_date", "accession_number", "fact_id", "promoted_at"]


def has_value(df: DataFrame, field: str) -> Column:
    c = F.col(field)
    if dict(df.dtypes)[field] != "string":
        return c.isNotNull()
    return c.isNotNull() & ~F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")).isin(PLACEHOLDERS)


def fact_group(df: DataFrame) -> DataFrame:
    return df.withColumns({"_cik": F.col("cik"), "_start": F.col("start_date"), "_end": F.col("end_date"), "_concept": spelling(F.col("concept")), "_unit": spelling(F.col("unit"))})


def trust_order() -> list[Column]:
    return [F.coalesce(F.col("is_superseded"), F.lit(False)).asc(), F.col("filed_date").desc_nulls_last(), F.col("accession_number").desc_nulls_last(), F.col("fact_id").desc_nulls_last(), F.col("promoted_at").desc_nulls_last()]


def ranked(df: DataFrame, fields: list[str] = FIELDS, values: bool = False) -> DataFrame:
    """The first two records of each group and mask: the group as two hashes, the columns of the order, mask, and with
    `values` the fields themselves as text."""
    g = fact_group(df)
    h1, h2 = key128(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in GROUP])
    mask = F.lit(0)
    for k, f in enumerate(fields):
        mask = mask.bitwiseOR(F.when(has_value(df, f), 1 << k).otherwise(0))
    kept = [*GROUP, *[F.col(f).cast("string").alias(f) for f in fields]] if values else []
    rows = g.select(h1.alias("h1"), h2.alias("h2"), *ORDER, mask.cast("int").alias("mask"), *kept)
    w = W.partitionBy("h1", "h2", "mask").orderBy(*trust_order())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 2).drop("rank")


def merged(df: DataFrame, fields: list[str] = FIELDS, values: bool = False) -> DataFrame:
    """One row a group of two or more records: survivor_id, and for each field the donor's id, with `values` also the
    donor's value (as text) in v_<field> and the group's key."""
    w = W.partitionBy("h1", "h2").orderBy(*trust_order())
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    top = ranked(df, fields, values)
    out = [F.row_number().over(w).alias("_at"), F.count(F.lit(1)).over(whole).alias("_n"), F.col("fact_id").alias("survivor_id")]
    for k, f in enumerate(fields):
        has = F.col("mask").bitwiseAND(1 << k) != 0
        out.append(F.first(F.when(has, F.struct(F.col("fact_id").alias("id"), *([F.col(f).alias("value")] if values else []))), ignorenulls=True).over(whole).alias(f"d_{f}"))
    m = top.select(*(GROUP if values else []), *out).where((F.col("_at") == 1) & (F.col("_n") > 1))
    return m.drop("_at", "_n")


def found(df: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """survivor_id, field_name, donor_id.

    Null group keys equal null; a null flag is not superseded; nulls in the order come last; a field that no record of
    the group has gives no row; a group of one record gives none; an empty table gives no row. Records delivered twice
    are two records of a group."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"d_{f}.id").alias("donor_id"), F.col(f"d_{f}").isNotNull().alias("has")) for f in fields])
    return merged(df, fields).select("survivor_id", F.explode(pairs).alias("p")).where("p.has").select("survivor_id", "p.field_name", "p.donor_id").distinct()


def golden(df: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """The merged records: key, survivor_id and the chosen value of each field, typed as in the input."""
    kinds = dict(df.dtypes)
    m = merged(df, fields, values=True)
    return m.select(F.col("_cik").alias("cik"), F.col("_start").alias("start_date"), F.col("_end").alias("end_date"), F.col("_concept").alias("concept"), F.col("_unit").alias("unit"), "survivor_id", *[F.col(f"d_{f}.value").cast(kinds[f]).alias(f) for f in fields])
