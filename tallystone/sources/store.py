"""Versioned tables over plain parquet folders, anti-join append, and one promote for all sinks.

Layout: <root>/<table>/v=N-<random>/*.parquet and <root>/<table>/_manifest/v=N.json, which names the folder. A version is either appended to what was
before or replaces it; reading version N reads the folders back to the last replacement, so appends cost only what is
new. The manifest file is written last and only if absent, so a failed writer leaves no half version and of two writers
of one version one fails and its folder is no part of any version. Any Hadoop file system will do.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = "version long, parent long, ts string, operation string, rows long"


class NullViolation(ValueError):
    """A required column has nulls."""


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order, cast; absent columns are null. Columns beyond the schema are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def check_required(df: DataFrame, schema: T.StructType) -> None:
    """One pass over the data; parquet itself doesn't enforce nullability."""
    need = [f.name for f in schema if not f.nullable]
    if need:
        bad = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in need]).first()
        if any(bad[c] for c in need):
            raise NullViolation(", ".join(f"{c}: {bad[c]}" for c in need if bad[c]))


def new_rows(df: DataFrame, existing: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key isn't stored yet. Only key columns of the stored table are read. By default a null key never matches
    and stays; null_safe: null equals null. Duplicates within df stay."""
    k = existing.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    cond = [(F.col(c).eqNullSafe(F.col(f"_k{i}")) if null_safe else F.col(c) == F.col(f"_k{i}")) for i, c in enumerate(keys)]
    return df.join(k, cond, "left_anti")


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType | None = None):
        self.spark, self.path, self.name, self.schema = spark, f"{root}/{name}", name, schema
        jvm = spark.sparkContext._jvm
        self._jpath = jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def snapshots(self) -> list[dict]:
        """Manifest entries in order."""
        folder = self._jpath(f"{self.path}/_manifest")
        if not self._fs.exists(folder):
            return []
        out = []
        for s in self._fs.listStatus(folder):
            stream = self._fs.open(s.getPath())
            out.append(json.loads(bytes(stream.readAllBytes()).decode()))
            stream.close()
        return sorted(out, key=lambda x: x["version"])

    def manifest(self) -> DataFrame:
        """Snapshots as a frame, with a running number."""
        rows = [(s["version"], s["parent"], s["ts"], s["operation"], s["rows"]) for s in self.snapshots()]
        return self.spark.createDataFrame(rows, SNAPSHOT).withColumn("sequence", F.row_number().over(W.orderBy("version")))

    def _write(self, df: DataFrame, operation: str, ts: str | None) -> int:
        snaps = self.snapshots()
        parent = snaps[-1]["version"] if snaps else 0
        version = parent + 1
        if self.schema is not None:
            df = conform_schema(df, self.schema)
            check_required(df, self.schema)
        folder, seen = f"v={version:06d}-{uuid.uuid4().hex[:12]}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.path}/{folder}")
        rows = seen.get["rows"]
        entry = {"version": version, "folder": folder, "parent": parent or None, "ts": ts or dt.datetime.now(dt.UTC).isoformat(), "operation": operation, "rows": rows}
        stream = self._fs.create(self._jpath(f"{self.path}/_manifest/v={version:06d}.json"), False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        return version

    def append(self, df: DataFrame, ts: str | None = None) -> int:
        return self._write(df, "append", ts)

    def overwrite(self, df: DataFrame, ts: str | None = None) -> int:
        """A new version that replaces the content; earlier versions stay readable."""
        return self._write(df, "overwrite", ts)

    def read(self, version: int | None = None) -> DataFrame:
        snaps = [s for s in self.snapshots() if version is None or s["version"] <= version]
        if version is not None and not any(s["version"] == version for s in snaps):
            raise KeyError(f"{self.name} has no version {version}")
        if not snaps:
            if self.schema is None:
                raise KeyError(f"{self.name} is empty")
            return self.spark.createDataFrame([], self.schema)
        base = max((s["version"] for s in snaps if s["operation"] == "overwrite"), default=snaps[0]["version"])
        reader = self.spark.read.schema(self.schema) if self.schema is not None else self.spark.read
        return reader.parquet(*[f"{self.path}/{s['folder']}" for s in snaps if s["version"] >= base])

    def find_at(self, when: str | dt.datetime) -> int | None:
        """The latest version written at or before a time; times without zone are UTC."""
        t = dt.datetime.fromisoformat(when) if isinstance(when, str) else when
        t = t if t.tzinfo else t.replace(tzinfo=dt.UTC)
        ok = []
        for s in self.snapshots():
            ts = dt.datetime.fromisoformat(s["ts"])
            if (ts if ts.tzinfo else ts.replace(tzinfo=dt.UTC)) <= t:
                ok.append(s["version"])
        return max(ok, default=None)

    def diff(self, before: int, after: int, key: str) -> dict[str, int]:
        """Keys added and removed between versions; null and empty keys don't count."""
        ids = lambda v: self.read(v).where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).select(key).distinct()
        a, b = ids(before), ids(after)
        return {"added": b.join(a, key, "left_anti").count(), "removed": a.join(b, key, "left_anti").count()}


def promote(table: VersionedTable, df: DataFrame, key: list[str], mode: str = "append", lineage=None, job: str | None = None, check=None) -> dict:
    """Write a build's result: start event, rows not stored yet (append) or all (overwrite), quality gate, end event.

    check: called with the table as written, returns whether its P0 rules passed; that flag goes into the event. An
    error is recorded and raised again."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode!r}")
    run = lineage.start(job or table.name, [table.name]) if lineage else None
    try:
        fresh = new_rows(df, table.read(), key, null_safe=len(key) > 1) if mode == "append" and table.snapshots() else df
        version = getattr(table, mode)(fresh)
        passed = check(table.read()) if check else None
        rows = next(s["rows"] for s in table.snapshots() if s["version"] == version)
    except Exception as e:
        if lineage:
            lineage.fail(run, str(e))
        raise
    if lineage:
        lineage.complete(run, rows=rows, version=version, p0_passed=passed)
    return {"version": version, "rows": rows, "p0_passed": passed}
