"""Company fact documents: reading, flattening, ingest and profile.

Well-formed documents are flattened in the JVM: one from_json with maps for taxonomies, concepts and units, and four
explodes. Documents in envelopes, as JSON text or of other shapes give no rows here: operators.nested is for these.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.sources.store import VersionedTable, new_rows

OBSERVATION = "struct<start:string,end:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string,frame:string>"
DOCUMENT = f"cik int, entityName string, facts map<string,map<string,struct<label:string,description:string,units:map<string,array<{OBSERVATION}>>>>>"
#: What makes a raw row the same as a stored one; a null period end equals a null one.
RAW_KEY = ["cik", "accession_number", "concept", "unit", "end_date"]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """file_name, payload: one row a JSON file of a folder."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.json)?$", 1).alias("file_name"), F.col("value").alias("payload"))


def read_archive(spark: SparkSession, path: str, ciks: list[int] | None = None) -> DataFrame:
    """file_name, payload of the members of ZIP archives, optionally only those of some companies. Members are read one
    at a time; a company that is in no archive has no row."""
    wanted = None if ciks is None else {f"CIK{c:010d}.json" for c in ciks}

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.endswith(".json") and (wanted is None or name.rsplit("/", 1)[-1] in wanted):
                            yield pd.DataFrame({"file_name": [name.rsplit("/", 1)[-1][:-5]], "payload": [z.read(name).decode("utf-8")]})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(members, "file_name string, payload string")


def flatten(documents: DataFrame) -> DataFrame:
    """Documents to raw rows. Empty levels give no rows; observations without end, value, accession, form or filing day
    are left out."""
    d = documents.select(F.from_json("payload", DOCUMENT).alias("d")).select("d.cik", F.col("d.entityName").alias("entity_name"), F.explode("d.facts").alias("taxonomy", "concepts"))
    d = d.select("cik", "entity_name", "taxonomy", F.explode("concepts").alias("concept", "c")).select("cik", "entity_name", "taxonomy", "concept", "c.label", "c.description", F.explode("c.units").alias("unit", "obs"))
    d = d.select("*", F.explode("obs").alias("o")).where("o.end is not null and o.val is not null and o.accn is not null and o.form is not null and o.filed is not null")
    day = lambda c: F.expr(f"try_cast({c} as date)")
    return d.select("cik", "entity_name", "taxonomy", "concept", "label", "description", "unit", day("o.start").alias("start_date"), day("o.end").alias("end_date"), F.col("o.val").alias("val"), F.col("o.accn").alias("accession_number"), F.col("o.fy").alias("fiscal_year"), F.col("o.fp").alias("fiscal_period"), F.col("o.form").alias("form"), day("o.filed").alias("filed_date"), F.col("o.frame").alias("frame"))


def ingest(raw: VersionedTable, documents: DataFrame, method: str, source_url: str, load_date: str, ingested_at: str) -> int:
    """Append what isn't stored yet, once for all companies. Duplicates within a delivery stay on purpose."""
    if method not in ("api", "bulk"):
        raise ValueError(f"method {method!r}")
    rows = flatten(documents).withColumns({"ingested_at": F.lit(ingested_at).cast("timestamp"), "source_url": F.lit(source_url), "source_method": F.lit(method), "load_date": F.lit(load_date).cast("date")})
    if raw.snapshots():
        rows = new_rows(rows, raw.read(), RAW_KEY, null_safe=True)
    return raw.append(rows)


def profile(df: DataFrame, top: int = 10) -> DataFrame:
    """column_name, n_null, null_rate (4 digits), n_distinct, least, greatest, mean, min/max/avg length, top values.

    Values are counted once for all columns together; ranks are over distinct values."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"), F.lit(t in ("int", "bigint", "double", "float")).alias("is_number")) for c, t in df.dtypes]
    counts = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").groupBy("column_name", "value", "is_number").agg(F.count(F.lit(1)).alias("n"))
    v, n = F.col("value"), F.col("n")
    number = F.when(F.col("is_number"), F.expr("try_cast(value as double)"))
    size = F.length(v)
    from pyspark.sql import Window as W

    w = W.partitionBy("column_name").orderBy(n.desc(), v)
    ranked = counts.where(v.isNotNull()).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top).groupBy("column_name").agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("_r", "value", "n"))), lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))).alias("top_values"))
    stats = counts.groupBy("column_name").agg(
        F.sum(F.when(v.isNull(), n).otherwise(0)).alias("n_null"), F.bround(F.sum(F.when(v.isNull(), n).otherwise(0)) / F.sum(n), 4).alias("null_rate"), F.count(v).alias("n_distinct"),
        F.coalesce(F.min(number).cast("string"), F.min(v)).alias("least"), F.coalesce(F.max(number).cast("string"), F.max(v)).alias("greatest"), F.try_divide(F.sum(number * n), F.sum(F.when(number.isNotNull(), n))).alias("mean"),
        F.min(size).alias("min_length"), F.max(size).alias("max_length"), F.try_divide(F.sum(size * n), F.sum(F.when(v.isNotNull(), n))).alias("avg_length"),
    )
    return stats.join(ranked, "column_name", "left")
