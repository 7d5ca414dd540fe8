"""Lineage events, seeded fault injection and reconciliation."""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT = "event_id string, run_id string, event_type string, job_name string, job_namespace string, producer string, input_tables string, output_table string, output_snapshot_id long, row_count long, skipped_duplicates long, dq_rules_passed int, dq_rules_total int, dq_p0_passed boolean, duration_ms long, error_message string, event_time timestamp"


class Lineage:
    """Buffers run events and appends them to a versioned table at the end; a failure to record never stops a run."""

    def __init__(self, spark: SparkSession, table=None, namespace: str = "tallystone", producer: str = "tallystone"):
        self.spark, self.table, self.namespace, self.producer = spark, table, namespace, producer
        self.events: list[tuple] = []
        self._open: dict[str, tuple[str, list[str], dt.datetime]] = {}

    def _emit(self, run: str, kind: str, job: str, inputs: list[str], **x) -> None:
        now = x.pop("now", None) or dt.datetime.now(dt.UTC)
        began = self._open.get(run, (None, None, now))[2]
        self.events.append((str(uuid.uuid4()), run, kind, job, self.namespace, self.producer, json.dumps(inputs), x.get("output") or job, x.get("version"), x.get("rows"), x.get("skipped"), x.get("passed"), x.get("total"), x.get("p0_passed"), int((now - began).total_seconds() * 1000), (x.get("error") or "")[:4000] or None, now))

    def start(self, job: str, inputs: list[str], now: dt.datetime | None = None) -> str:
        run = str(uuid.uuid4())
        self._open[run] = (job, inputs, now or dt.datetime.now(dt.UTC))
        self._emit(run, "START", job, inputs, now=now)
        return run

    def complete(self, run: str, **x) -> None:
        job, inputs, _ = self._open[run]
        self._emit(run, "COMPLETE", job, inputs, **x)

    def fail(self, run: str, error: str, **x) -> None:
        job, inputs, _ = self._open[run]
        self._emit(run, "FAIL", job, inputs, error=error, **x)

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.events, EVENT)

    def flush(self) -> bool:
        """Append what is buffered; False if that failed, and the events stay buffered."""
        if self.table is None or not self.events:
            return True
        try:
            self.table.append(self.frame())
        except Exception:  # noqa: BLE001
            return False
        self.events = []
        return True


def latest_runs(events: DataFrame) -> DataFrame:
    """The last COMPLETE or FAIL of each job."""
    w = W.partitionBy("job_name").orderBy(F.col("event_time").desc(), F.col("event_id").desc())
    return events.where(F.col("event_type").isin("COMPLETE", "FAIL")).withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def facets(events: DataFrame) -> DataFrame:
    """job_name, facet: the last run of each job as a JSON document."""
    return latest_runs(events).select("job_name", F.to_json(F.struct("run_id", "event_type", F.from_json("input_tables", "array<string>").alias("inputs"), "output_table", "row_count", "dq_p0_passed", "duration_ms")).alias("facet"))


DIMENSIONS = ["completeness", "validity", "uniqueness", "consistency", "accuracy", "reasonableness", "freshness", "volume", "referential_integrity", "coverage"]
LEAST_EACH, RATES = 5, (0.05, 0.10)


class Refused(RuntimeError):
    """A safety switch is off."""


def check_safe(enabled: bool, path: str, env: str = "TALLYSTONE_CHAOS") -> None:
    """Three switches: the caller's flag, the environment, and a shadow path."""
    if not enabled:
        raise Refused("fault injection is off")
    if os.environ.get(env) != "allow":
        raise Refused(f"{env} isn't allow")
    if "/shadow/" not in path and not path.startswith("shadow"):
        raise Refused("the target isn't a shadow path")


#: The strategies of each dimension; column: what it puts in place of the value. A fault without columns is
#: the repeated row itself. `{k}` is a hash of the row, `{old}` the value that was there.
REQUIRED = ["cik", "entity_name", "taxonomy", "concept", "unit", "end_date", "val", "accession_number", "form", "filed_date", "ingested_at", "source_url", "source_method", "load_date"]
OPTIONAL = ["label", "description", "start_date", "fiscal_year", "fiscal_period", "frame"]
BIG = "element_at(array('Assets', 'Liabilities', 'StockholdersEquity', 'Revenues', 'CostOfRevenue'), {k} % 5 + 1)"
ABSOLUTE = "element_at(array('Assets', 'Revenues', 'CashAndCashEquivalentsAtCarryingValue'), {k} % 3 + 1)"
STRATEGIES: dict[str, dict[str, dict[str, str]]] = {
    "completeness": {f"null_{c}": {c: "null"} for c in REQUIRED + OPTIONAL},
    "validity": {
        "bad_taxonomy": {"taxonomy": "'bogus-taxonomy'"}, "bad_form": {"form": "'FAKE-FORM'"}, "bad_period": {"fiscal_period": "'Q9'"}, "bad_accession": {"accession_number": "'NOT-AN-ACCESSION'"}, "inject_nan": {"val": "double('NaN')"},
        "inject_inf": {"val": "double('Infinity')"}, "future_filed_date": {"filed_date": "date'2099-06-15'"}, "end_date_far_from_filed": {"end_date": "date_add(coalesce(filed_date, date'2024-01-01'), 3650)"},
    },
    "uniqueness": {"full_row_duplicate": {}},
    "consistency": {"date_inversion": {"start_date": "date'2099-12-31'", "end_date": "date'2000-01-01'"}, "fiscal_year_mismatch": {"fiscal_year": "1999", "end_date": "date'2024-12-31'"}, "end_date_filed_gap": {"end_date": "date_add(coalesce(filed_date, date'2024-01-01'), 4000)"}},
    "accuracy": {"implausible_value": {"concept": BIG, "unit": "'USD'", "fiscal_period": "'FY'", "val": "1.0 + {k} % 499"}, "negative_absolute_metric": {"concept": ABSOLUTE, "val": "coalesce(-abs(val), -999.0)"}, "penny_value": {"concept": BIG, "val": "0.01"}},
    "reasonableness": {"extreme_outlier_value": {"val": "999999999999999.0"}, "impossible_fiscal_year": {"fiscal_year": "1850"}, "zero_cik": {"cik": "0"}},
    "freshness": {"future_timestamp": {"ingested_at": "timestamp'2099-01-01 00:00:00'"}, "ancient_timestamp": {"filed_date": "date'1900-01-01'"}, "future_filing": {"filed_date": "date'2099-03-15'"}, "ancient_ingested_at": {"ingested_at": "timestamp'1990-01-01 00:00:00'"}},
    "volume": {"volume_spike": {"concept": "concat('chaos:VolumeSpike', {k} % 99999)"}},
    "referential_integrity": {"orphan_cik": {"cik": "9999999"}, "fake_accession_number": {"accession_number": "'9999999999-99-999999'"}},
    "coverage": {"missing_annual_filings": {"cik": "8888888", "entity_name": "'CHAOS_COVERAGE_TEST_CORP'", "fiscal_period": "'Q1'"}, "non_standard_unit": {"unit": "'FAKE_CURRENCY'", "concept": "'chaos:NoCoverageMetric'"}},
}


def _corrupted(hits: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with _d (dimension) and _k (a hash): the fault of one strategy put in, with chaos_strategy, chaos_fields and the
    values before and after as text."""
    options = [(d, s, {c: v for c, v in cols.items() if c in columns}) for d, by in STRATEGIES.items() for s, cols in by.items() if not cols or any(c in columns for c in cols)]
    numbers = {d: [i for i, o in enumerate(options) if o[0] == d] for d in STRATEGIES}
    pick = F.coalesce(*[F.when(F.col("_d") == d, F.element_at(F.array(*[F.lit(i) for i in n]), (F.col("_k") % len(n) + 1).cast("int"))) for d, n in numbers.items() if n])
    x = hits.withColumn("_s", pick)
    kinds = dict(hits.dtypes)
    new: dict[str, Column] = {}
    for i, (_, _, cols) in enumerate(options):
        for c, v in cols.items():
            value = F.expr(v.replace("{k}", "_k")).cast(kinds[c])
            new[c] = new[c].when(F.col("_s") == i, value) if c in new else F.when(F.col("_s") == i, value)
    table = lambda f: F.element_at(F.array(*[F.lit(f(o)) for o in options]), F.col("_s") + 1)
    fields = table(lambda o: ",".join(o[2]))
    touched = lambda c: F.array_contains(F.split(fields, ","), c)
    changed = {c: v.otherwise(F.col(c)) for c, v in new.items()}
    said = lambda get: F.to_json(F.filter(F.array(*[F.when(touched(c), F.struct(F.lit(c).alias("field"), get(c).cast("string").alias("value"))) for c in new]), lambda y: y.isNotNull()))
    x = x.withColumns({"chaos_dimension": F.col("_d"), "chaos_strategy": table(lambda o: o[1]), "chaos_fields": fields, "chaos_before": said(F.col), "chaos_after": said(lambda c: changed[c])})
    return x.withColumns(changed).drop("_s")


def corruptions(clean: DataFrame, rate: float = 0.07, seed: int = 42, key: str = "row_no") -> DataFrame:
    """Corrupted copies of rows with chaos_dimension, chaos_strategy, chaos_fields, chaos_before, chaos_after and chaos_id:
    about rate x rows, at least five for each dimension. How often a row is drawn for a dimension is a Poisson draw from a
    hash of seed, dimension and key, as drawing with replacement has it; so a run can be repeated exactly. The rate must lie
    within RATES. Null keys are one key."""
    if not RATES[0] <= rate <= RATES[1]:
        raise ValueError(f"rate {rate} not in {RATES}")
    n = clean.count()
    names = ["chaos_dimension", "chaos_strategy", "chaos_fields", "chaos_before", "chaos_after", "chaos_id"]
    if not n:
        return clean.withColumns({c: F.lit("") for c in names})
    mean = max(rate / len(DIMENSIONS), LEAST_EACH / n)
    limits, p, total = [], math.exp(-mean), 0.0  # cumulated chances of 0, 1, 2, ... draws, until the rest is nothing
    while 1.0 - total > 1e-12 and p > 0:
        total += p
        limits.append(total)
        p *= mean / len(limits)
    h = lambda d, *x: F.pmod(F.xxhash64(F.lit(seed), F.lit(d), *x, F.col(key)), F.lit(1 << 40))
    times = lambda d: F.array_size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x <= h(d) / F.lit(float(1 << 40))))

    def drawn(d: str) -> Column:
        numbers = F.when(times(d) > 0, F.sequence(F.lit(1), times(d))).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda i: F.struct(F.lit(d).alias("d"), i.alias("i")))

    draws = F.flatten(F.array(*[drawn(d) for d in DIMENSIONS]))
    hits = clean.withColumn("_draw", F.explode(draws)).withColumns({"_d": F.col("_draw.d"), "_i": F.col("_draw.i").cast("string")}).drop("_draw")
    counts = {r["_d"]: r["count"] for r in hits.groupBy("_d").count().collect()}  # ten rows
    for d in DIMENSIONS:  # what the draw left short is made up from the first rows by hash
        if counts.get(d, 0) < LEAST_EACH:
            more = clean.orderBy(h(d, F.lit("more")), key).limit(LEAST_EACH - counts.get(d, 0))
            hits = hits.unionByName(more.withColumns({"_d": F.lit(d), "_i": F.lit("x")}))
    hits = hits.withColumn("_k", F.pmod(F.xxhash64(F.lit(seed), F.col("_d"), F.col("_i"), F.lit("strategy"), F.col(key)), F.lit(1 << 30)).cast("int"))
    hits = hits.withColumn("chaos_id", F.concat_ws("-", F.lit("CHAOS"), F.col("_d"), F.col("_i"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return _corrupted(hits, clean.columns).select(*clean.columns, *names)


def manifest(corrupt: DataFrame, source: str, rows: int, rate: float, run_id: str, when: str) -> tuple[dict, DataFrame]:
    """What was injected: a head (counts and coverage by dimension) and one row for each injection. Write the rows as a
    table and the head as JSON beside it (write_manifest)."""
    lines = corrupt.select(F.lit(run_id).alias("run_id"), "chaos_id", "chaos_dimension", "chaos_strategy", "chaos_fields", "chaos_before", "chaos_after")
    n = {r["chaos_dimension"]: r["count"] for r in lines.groupBy("chaos_dimension").count().collect()}  # ten rows
    return {"run_id": run_id, "timestamp": when, "source_table": source, "source_row_count": rows, "injected_row_count": sum(n.values()), "injection_rate": rate, "dimension_coverage": {d: n.get(d, 0) > 0 for d in DIMENSIONS}}, lines


def write_manifest(folder: str, head: dict, lines: DataFrame) -> str:
    path = f"{folder}/{head['run_id']}"
    lines.write.mode("errorifexists").parquet(f"{path}/injections")
    spark = lines.sparkSession
    spark.createDataFrame([(json.dumps(head, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/head")  # one line
    return path


def read_manifest(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    return json.loads(spark.read.text(f"{path}/head").first()["value"]), spark.read.parquet(f"{path}/injections")


def latest_manifest(spark: SparkSession, folder: str) -> str | None:
    """The greatest run_id of a folder, None where there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []
    return f"{folder}/{names[-1]}" if names else None


def relaxed(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, as the shadow zone needs it."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def teardown(spark: SparkSession, root: str) -> bool:
    """Remove a shadow zone; anything that isn't one is refused."""
    if "/shadow" not in root:
        raise Refused("the target isn't a shadow path")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shadow(clean: DataFrame, corrupt: DataFrame) -> DataFrame:
    """Clean and corrupted rows together; clean rows have no chaos_id."""
    return clean.withColumns({c: F.lit(None).cast("string") for c in corrupt.columns if c not in clean.columns}).unionByName(corrupt)


def reconcile(corrupt: DataFrame, results: list) -> DataFrame:
    """chaos_dimension, injected, caught, missed, detection_rate, failed_rules: a dimension counts as caught when one of its
    rules failed (names compared without blanks and case)."""
    failed: dict[str, list[str]] = {}
    for r in results:
        if not r.passed:
            failed.setdefault(r.category.lower().replace(" ", "_"), []).append(r.rule_id)
    spark = corrupt.sparkSession
    f = spark.createDataFrame([(d, ",".join(sorted(failed.get(d, [])))) for d in DIMENSIONS], "chaos_dimension string, failed_rules string")
    n = corrupt.groupBy("chaos_dimension").agg(F.count(F.lit(1)).alias("injected"))
    j = f.join(n, "chaos_dimension", "left").fillna(0, ["injected"])
    j = j.withColumn("caught", F.when(F.col("failed_rules") != "", F.col("injected")).otherwise(0))
    return j.withColumns({"missed": F.col("injected") - F.col("caught"), "detection_rate": F.try_divide("caught", "injected")})


def remediations(reconciled: DataFrame, lines: DataFrame) -> DataFrame:
    """chaos_dimension, chaos_strategy, injected: strategies of dimensions that no rule caught, most injections first."""
    open_ = reconciled.where("caught = 0").select("chaos_dimension")
    return lines.join(F.broadcast(open_), "chaos_dimension").groupBy("chaos_dimension", "chaos_strategy").agg(F.count(F.lit(1)).alias("injected")).orderBy(F.col("injected").desc(), "chaos_dimension", "chaos_strategy")


def report(reconciled: DataFrame, head: dict | None = None, lines: DataFrame | None = None, results: list | None = None) -> str:
    """After-action report as Markdown: the run, dimensions, failed rules, and what is open; one row a dimension or strategy."""
    rows = reconciled.orderBy("chaos_dimension").collect()  # ten rows
    out = ["# Fault injection", ""]
    if head:
        out += [f"Run {head['run_id']} at {head['timestamp']}: {head['injected_row_count']} faults in {head['source_row_count']} rows of {head['source_table']} (rate {head['injection_rate']}).", ""]
    out += ["| dimension | injected | caught | missed | rules |", "|-|-|-|-|-|"]
    out += [f"| {r['chaos_dimension']} | {r['injected']} | {r['caught']} | {r['missed']} | {r['failed_rules'] or '-'} |" for r in rows]
    total, caught = sum(r["injected"] for r in rows), sum(r["caught"] for r in rows)
    out += ["", f"{caught} of {total} corruptions lie in dimensions with a failed rule."]
    if results is not None:
        failed = [r for r in results if not r.passed]
        out += ["", "## Failed rules", "", *([f"* {r.rule_id} ({r.priority}, {r.category}): {r.error or r.raw_value} against {r.threshold}" for r in failed] or ["None."])]
    if lines is not None:
        gaps = remediations(reconciled, lines).collect()  # a row a strategy
        out += ["", "## Open", "", *([f"* {r['chaos_dimension']}: no rule catches {r['chaos_strategy']} ({r['injected']})" for r in gaps] or ["Every dimension is caught."])]
    return "\n".join(out)
