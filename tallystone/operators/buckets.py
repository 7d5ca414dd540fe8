"""Rows of two tables brought together by key, with hot keys split.

How many tasks there are follows from the rows of both tables. Only a key that by itself holds more rows than a task takes
is split, by salt, on the side of the many rows; of the other side only the rows of such keys are repeated, once a part. As
the parts of all hot keys together are at most twice the rows over a task's rows, all work grows in proportion to the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.runtime import cut, maybe_broadcast

#: Rows of both tables that one task takes; a key with more is hot.
ROWS_PER_TASK = 1_000_000
#: Rows below which more tasks than cores aren't worth their start.
LEAST_ROWS = 20_000
#: Keys are counted by slot first, and one by one only in slots that could hold a hot one.
SLOTS = 4096


def tasks_for(spark_df: DataFrame, rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for so many rows: by size, but as many as there are cores where that gives each enough to do."""
    cores = spark_df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(rows / per_task), min(cores, math.ceil(rows / LEAST_ROWS)))


def hot_keys(many: DataFrame, keys: list[str], per_task: int = ROWS_PER_TASK) -> tuple[int, DataFrame | None]:
    """Number of rows, and the keys with more than per_task of them: keys, parts (None where there are none). At most
    SLOTS counts reach the driver."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    counts = {r["slot"]: r["n"] for r in many.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
    heavy = [s for s, n in counts.items() if n > per_task]
    if not heavy:
        return sum(counts.values()), None
    hot = many.where(slot.isin(heavy)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per_task)
    hot = cut(hot.select(*keys, F.ceil(F.col("n") / per_task).cast("int").alias("_parts")))
    return sum(counts.values()), hot


def split_hot(many: DataFrame, few: DataFrame, keys: list[str], hot: DataFrame | None, spread_by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables with _part: 0 for ordinary keys. Rows of `many` with a hot key are divided among its parts by a hash of
    spread_by; rows of `few` with a hot key are repeated for each part. Null keys must not occur."""
    if hot is None:
        return many.withColumn("_part", F.lit(0)), few.withColumn("_part", F.lit(0))
    h = maybe_broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1))
    a = many.join(h, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), parts).cast("int")).drop("_parts")
    b = few.join(h, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return a, b


def spread(many: DataFrame, few: DataFrame, keys: list[str], spread_by: list[str], per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """Both tables with _bucket (by hash of the keys) and _part."""
    n, hot = hot_keys(many, keys, per_task)
    buckets = tasks_for(many, n + few.count(), per_task)
    bucket: Column = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    a, b = split_hot(many, few, keys, hot, spread_by)
    return a.withColumn("_bucket", bucket), b.withColumn("_bucket", bucket)
