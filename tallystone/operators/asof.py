"""Attributes as known at the time of an event (problem 5).

Facts become versions of the current state of their entity, ordered by availability: on each day on which something was
filed, the state is the best fact filed by then; days on which it doesn't change give no version. Ties within a day are
resolved before, by a combining aggregate, so an entity has at most one version a day. Entities are partitioned by hash
and an embedded DuckDB runs ASOF LEFT JOIN in each bucket; buckets that many events hit are split.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.functions.names import spelling
from tallystone.operators.buckets import ROWS_PER_TASK, spread
from tallystone.runtime import key128, stage

MEMORY = "512MB"


def versions(facts: DataFrame, key: list[Column], available: Column, order: list[str], value: str) -> DataFrame:
    """h1, h2, day, value: the state of each entity from `day` on. order: of two facts known on a day the greater of
    (order..., value) counts; nulls are least. Facts with a null key part or without a day are never known."""
    usable = facts.where(available.isNotNull())
    for k in key:
        usable = usable.where(k.isNotNull())
    h1, h2 = key128(*key)
    best = F.struct(*[F.col(c) for c in order], F.col(value).alias("_value"))
    daily = usable.groupBy(h1.alias("h1"), h2.alias("h2"), available.alias("day")).agg(F.max(best).alias("s"))
    w = W.partitionBy("h1", "h2").orderBy("day")
    state = daily.withColumn("s", F.max("s").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    changed = state.withColumn("_before", F.lag("s").over(w)).where(~F.col("s").eqNullSafe(F.col("_before")))
    return stage(changed.select("h1", "h2", F.unix_date("day").alias("day"), F.col("s._value").alias("value")), "states")  # counted, then joined


def utc_day(c: Column, kind: str) -> Column:
    """The day in UTC, whatever the session's time zone is; times without a zone count as UTC."""
    return F.to_date(c) if kind in ("date", "timestamp_ntz") else F.date_from_unix_date(F.floor(F.unix_micros(c) / F.lit(86_400_000_000)).cast("int"))


def join(events: DataFrame, key: list[Column], day: Column, event_id: str, states: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """event_id, value: the state valid on the event's day, null where nothing was known. Each event row once."""
    h1, h2 = key128(*[F.coalesce(k, F.lit("\u0000")) for k in key])
    none = key[0].isNull()
    for k in key[1:]:
        none = none | k.isNull()
    e = events.select(F.col(event_id).alias("event_id"), F.when(~none, h1).otherwise(F.xxhash64(event_id)).alias("h1"), F.when(~none, h2).otherwise(F.lit(0).cast("long")).alias("h2"), F.coalesce(F.unix_date(day), F.lit(-(2**31))).alias("day"))
    many, few = spread(e, states, ["h1", "h2"], ["event_id"], per_task)
    kind = dict(events.dtypes)[event_id]

    def one_bucket(event: pa.Table, state: pa.Table) -> pa.Table:
        import duckdb

        with duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""}) as con:  # buckets fit: nothing goes to a local folder
            con.register("event", event)
            con.register("state", state)
            got = con.sql("SELECT event.event_id, state.value FROM event ASOF LEFT JOIN state ON event.h1 = state.h1 AND event.h2 = state.h2 AND event.day >= state.day").to_arrow_table()
        return pa.table({"event_id": got.column(0).cast(event.schema.field("event_id").type), "value": got.column(1).cast(pa.string())})

    return many.groupBy("_bucket", "_part").cogroup(few.groupBy("_bucket", "_part")).applyInArrow(one_bucket, f"event_id {kind}, value string")


def found(requests: DataFrame, facts: DataFrame) -> DataFrame:
    """request_id, fact_id: for each request the fact of the latest period that was filed on or before its day (UTC).

    Requests without such a fact, or with a null key part or time, have no row. Ties go to the latest filed_date, then the
    greatest accession_number, then the greatest fact_id. Repeated facts change nothing. Empty tables give no row."""
    names = [F.concat(F.lit("="), F.col("cik").cast("string")), spelling(F.col("concept")), spelling(F.col("unit"))]
    f = facts.select("cik", "concept", "unit", "end_date", "filed_date", "accession_number", "fact_id")
    states = versions(f, names, F.col("filed_date"), ["end_date", "filed_date", "accession_number"], "fact_id")
    r = requests.select("request_id", "cik", "concept", "unit", "requested_at")
    got = join(r, names, utc_day(F.col("requested_at"), dict(r.dtypes)["requested_at"]), "request_id", states)
    return got.where(F.col("value").isNotNull()).select(F.col("event_id").alias("request_id"), F.col("value").alias("fact_id")).distinct()


def values(requests: DataFrame, facts: DataFrame) -> DataFrame:
    """request_id, fact_id, val, end_date, filed_date: found() with the fact's attributes (its latest delivery)."""
    f = facts.where(F.col("fact_id").isNotNull()).groupBy("fact_id").agg(F.max(F.struct("promoted_at", "val", "end_date", "filed_date")).alias("f"))
    return found(requests, facts).join(f, "fact_id").select("request_id", "fact_id", "f.val", "f.end_date", "f.filed_date")
