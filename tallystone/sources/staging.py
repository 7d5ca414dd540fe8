"""Proposals that wait for approval: small JSON files with the status of each, an archive, and promotion of what is ready."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators import entities
from tallystone.sources.store import VersionedTable, promote


def write(proposals: DataFrame, path: str) -> None:
    """Replace the staged proposals. They are read whole before the old files go, as they often come from them."""
    from tallystone.runtime import cut

    cut(proposals).coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)  # a proposal a company or concept


def read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The staged proposals; none where nothing is staged."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def archive(spark: SparkSession, path: str, when: str) -> str | None:
    """Move the staged files beside themselves under a name with the time; None where nothing is staged."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    source, target = jpath(path), jpath(f"{path}-archive/{when.replace(':', '-').replace(' ', 'T')}")
    fs = source.getFileSystem(conf)
    if not fs.exists(source):
        return None
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{path} can't be archived")
    return target.toString()


def pending(proposals: DataFrame) -> DataFrame:
    return proposals.where(F.col("status") == "pending")


def promote_ready(spark: SparkSession, proposals: DataFrame, table: VersionedTable, audit: VersionedTable, key: str, ready: tuple[str, ...], stored_status: str | None, who: str, when: str, lineage=None) -> dict:
    """Append the proposals that are ready and not stored yet, with an audit row each; how many were promoted and skipped."""
    fit = proposals.where(F.col("status").isin(*ready))
    new = entities.promotable(proposals, table.read(), key, ready, stored_status) if table.snapshots() else fit
    n, all_ = new.count(), fit.count()
    if n:
        promote(table, new, [key], "append", lineage)
        audit.append(entities.audit(new, key, "promoted", who, when))
    return {"promoted": n, "skipped_duplicates": all_ - n}
