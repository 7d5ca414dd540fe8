"""Data-quality rules: SQL text, a threshold and a priority; runner, gate, scorecard.

Rules run as Spark SQL on the catalog's tables, several at a time, since most are short jobs; only the first cell or the
number of rows of a rule reaches the driver.
"""

from __future__ import annotations

import json
import operator
import re
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OPS = {"=": operator.eq, "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge}
_THRESHOLD = re.compile(r"^\s*(result_count|result)\s*(==|!=|>=|<=|=|<|>)\s*(-?\d+(?:\.\d+)?)\s*(?:[-–—].*)?$")


@dataclass
class Rule:
    rule_id: str
    spec: str
    category: str
    priority: str
    description: str
    sql: str
    threshold: str
    status: str = "active"


@dataclass
class Result:
    rule_id: str
    spec: str
    category: str
    priority: str
    passed: bool
    raw_value: float | int | None
    threshold: str
    violations: int | None = None
    execution_time_ms: int = 0
    error: str | None = None
    extra: dict = field(default_factory=dict)


class GateFailed(RuntimeError):
    """A P0 rule failed, or none was there to pass."""


def load(path: str) -> list[Rule]:
    """Rules of a JSON file {spec, rules: [...]}, or of all files of a folder."""
    files = sorted(Path(path).glob("*.json")) if Path(path).is_dir() else [Path(path)]
    out = []
    for f in files:
        d = json.loads(f.read_text())
        out += [Rule(r["rule_id"], d.get("spec", f.stem), r.get("category", ""), r.get("priority", "P1"), r.get("description", ""), r.get("sql", ""), r.get("threshold", "result = 0"), r.get("status", "proposed")) for r in d["rules"]]
    return out


def meets(threshold: str, value: float | None, rows: int = 0) -> bool:
    """result compares the first cell (null counts as 0), result_count the number of rows. What can't be read fails."""
    m = _THRESHOLD.match(threshold)
    if not m:
        return False
    left = rows if m[1] == "result_count" else (value or 0.0)
    return bool(_OPS[m[2]](float(left), float(m[3])))


def run_one(spark: SparkSession, rule: Rule) -> Result:
    """An error is a failure with its text. Of a result_count rule only the number of rows reaches the driver."""
    t = time.time()
    try:
        df = spark.sql(rule.sql)
        if rule.threshold.lstrip().startswith("result_count"):
            value = rows = df.count()
        else:
            first = df.take(1)
            value, rows = (first[0][0] if first else 0), len(first)
        out = Result(rule.rule_id, rule.spec, rule.category, rule.priority, meets(rule.threshold, None if value is None else float(value), rows), value, rule.threshold, value if isinstance(value, int) else None)
    except Exception as e:  # noqa: BLE001
        out = Result(rule.rule_id, rule.spec, rule.category, rule.priority, False, None, rule.threshold, error=str(e)[:4000])
    out.execution_time_ms = int(1000 * (time.time() - t))
    return out


def run(spark: SparkSession, rules: list[Rule], spec: str | None = None, priority: str | None = None, parallel: int = 4) -> list[Result]:
    """Rules that are approved or active (any case) and have SQL; several at a time, since most are short."""
    chosen = [r for r in rules if r.status.lower() in ("approved", "active") and r.sql and (spec is None or r.spec == spec) and (priority is None or r.priority == priority)]
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(lambda r: run_one(spark, r), chosen))


def activate(rules: list[Rule], results: list[Result]) -> list[Rule]:
    """Approved rules become active with their first pass."""
    ok = {r.rule_id for r in results if r.passed}
    for r in rules:
        if r.status.lower() == "approved" and r.rule_id in ok:
            r.status = "active"
    return rules


def approve(rules: list[Rule], ids: list[str] | None = None) -> int:
    n = 0
    for r in rules:
        if r.status.lower() == "proposed" and (ids is None or r.rule_id in ids):
            r.status, n = "approved", n + 1
    return n


def gate(results: list[Result], strict: bool = True, allow_empty: bool = False) -> bool:
    """Raises where a P0 rule failed, where one broke (strict), or where there was none (unless allowed)."""
    p0 = [r for r in results if r.priority == "P0"]
    if not p0:
        if allow_empty:
            return True
        raise GateFailed("no P0 rule ran")
    bad = [r for r in p0 if not r.passed and (strict or r.error is None)]
    if bad:
        raise GateFailed("; ".join(f"{r.rule_id}: {r.error or r.raw_value}" for r in bad))
    return all(r.passed for r in p0)


def frame(spark: SparkSession, results: list[Result]) -> DataFrame:
    rows = [(r.rule_id, r.spec, r.category, r.priority, r.passed, None if r.raw_value is None else float(r.raw_value), r.threshold, r.execution_time_ms, r.error) for r in results]
    return spark.createDataFrame(rows, "rule_id string, spec string, category string, priority string, passed boolean, raw_value double, threshold string, execution_time_ms long, error string")


def scorecard(results: list[Result]) -> dict:
    """Passed and total by category and priority, and the gate."""
    by: dict[str, dict[str, list[int]]] = {"category": {}, "priority": {}}
    for r in results:
        for k in by:
            c = by[k].setdefault(getattr(r, k), [0, 0])
            c[0] += r.passed
            c[1] += 1
    return {"passed": sum(r.passed for r in results), "total": len(results), "by_category": by["category"], "by_priority": by["priority"], "gate": all(r.passed for r in results if r.priority == "P0") and any(r.priority == "P0" for r in results)}


def badge(results: list[Result]) -> dict:
    card = scorecard(results)
    share = card["passed"] / card["total"] if card["total"] else 0.0
    return {"label": "data quality", "message": f"{card['passed']}/{card['total']}", "color": "brightgreen" if share == 1 else "yellow" if share >= 0.9 else "red"}


def save(results: list[Result], path: str) -> None:
    Path(path).write_text(json.dumps([asdict(r) for r in results], indent=1, default=str))


# Rule makers: each gives the SQL and threshold of a common shape.


def unique(table: str, *key: str) -> tuple[str, str]:
    k = ", ".join(key)
    return f"SELECT {k}, COUNT(*) AS n FROM {table} GROUP BY {k} HAVING COUNT(*) > 1", "result_count = 0"


def none_where(table: str, condition: str) -> tuple[str, str]:
    return f"SELECT COUNT(*) AS n FROM {table} WHERE {condition}", "result = 0"


def refers(table: str, key: str, parent: str, parent_key: str | None = None, condition: str = "TRUE") -> tuple[str, str]:
    return f"SELECT COUNT(*) AS n FROM {table} c WHERE {condition} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key or key} = c.{key})", "result = 0"


def share(table: str, condition: str, least: float) -> tuple[str, str]:
    return f"SELECT ROUND(100.0 * SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) / COUNT(*), 1) AS pct FROM {table}", f"result >= {least}"


def scalar(expression: str, threshold: str = "result = 0") -> tuple[str, str]:
    return f"SELECT {expression}", threshold


def counted(table: str, by: str, stated: str, who: str) -> tuple[str, str]:
    """The stated number of `who` is that of the group, in every row of it."""
    groups = f"SELECT {by}, MIN({stated}) AS lowest, MAX({stated}) AS highest, COUNT(DISTINCT {who}) AS n FROM {table} GROUP BY {by}"
    return f"SELECT * FROM ({groups}) g WHERE lowest <> n OR highest <> n", "result_count = 0"


def refers_each(table: str, keys: list[str], parent: str, parent_key: str) -> tuple[str, str]:
    """References in several columns, each an anti join of its own; a row counts once a reference that isn't there."""
    return "SELECT " + " + ".join("(" + refers(table, k, parent, parent_key)[0] + ")" for k in keys), "result = 0"


def matched(table: str, key: str, own_key: str, condition: str) -> tuple[str, str]:
    """Rows c for which a row p of the same table, found by key, meets a condition that must not hold."""
    return f"SELECT COUNT(*) AS n FROM {table} c WHERE EXISTS (SELECT 1 FROM {table} p WHERE p.{own_key} = c.{key} AND {condition})", "result = 0"


def absent(table: str, parent: str, *key: str) -> tuple[str, str]:
    """Distinct whole keys of a table that the parent doesn't have."""
    k, whole = ", ".join(key), " AND ".join(f"{c} IS NOT NULL" for c in key)
    return f"SELECT COUNT(*) AS n FROM (SELECT {k} FROM {table} WHERE {whole} EXCEPT SELECT {k} FROM {parent}) d", "result = 0"


def weighted(table: str, key: str, condition: str, parent: str, accepted: str, least: float) -> tuple[str, str]:
    """Percent of rows whose key the parent accepts. Rows are counted by key before the join."""
    rows = f"SELECT {key}, COUNT(*) AS n FROM {table} WHERE {condition} GROUP BY {key}"
    good = f"SELECT DISTINCT {key} AS known FROM {parent} WHERE {accepted}"
    return f"SELECT ROUND(100.0 * SUM(CASE WHEN known IS NULL THEN 0 ELSE n END) / SUM(n), 1) AS pct FROM ({rows}) r LEFT JOIN ({good}) g ON known = {key}", f"result >= {least}"


def pivoted(table: str, by: list[str], figures: dict[str, str], condition: str, threshold: str = "result = 0") -> tuple[str, str]:
    """Groups whose figures (the greatest of each) meet a condition: one aggregate, no join."""
    cols = ", ".join(f"MAX({x}) AS {n}" for n, x in figures.items())
    return f"SELECT COUNT(*) AS n FROM (SELECT {cols} FROM {table} GROUP BY {', '.join(by)}) g WHERE {condition}", threshold


_ROWS = re.compile(r"SELECT COUNT\(\*\) AS n FROM ([\w.]+) WHERE (.*)", re.DOTALL)
_SHARE = re.compile(r"SELECT (ROUND\(100\.0 \* SUM\(CASE WHEN .* END\) / COUNT\(\*\), 1\)) AS pct FROM ([\w.]+)", re.DOTALL)


def passes(rules: list[Rule]) -> tuple[dict[str, dict[str, str]], list[Rule]]:
    """Rules that are an aggregate over the rows of one table, by table (rule id to expression), and the others. All of a
    table's are answered in one pass over it, whatever their number."""
    shared: dict[str, dict[str, str]] = {}
    rest = []
    for r in rules:
        rows, part = _ROWS.fullmatch(r.sql), _SHARE.fullmatch(r.sql)
        if rows and "SELECT" not in rows[2]:
            shared.setdefault(rows[1], {})[r.rule_id] = f"COUNT(*) FILTER (WHERE {rows[2]})"
        elif part and "SELECT" not in part[1]:
            shared.setdefault(part[2], {})[r.rule_id] = part[1]
        else:
            rest.append(r)
    return shared, rest


def raw_values(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """rule_id, raw_value of every rule (of a result_count rule the number of rows), lazily."""
    shared, rest = passes(rules)
    parts = []
    for t, cells in shared.items():
        pairs = ", ".join(f"'{i}', CAST({x} AS DOUBLE)" for i, x in cells.items())
        parts.append(f"SELECT explode(map({pairs})) AS (rule_id, raw_value) FROM {t}")
    for r in rest:
        sql = f"SELECT COUNT(*) AS v FROM ({r.sql}) q" if r.threshold.startswith("result_count") else r.sql
        parts.append(f"SELECT '{r.rule_id}' AS rule_id, CAST(({sql}) AS DOUBLE) AS raw_value")
    return spark.sql(" UNION ALL ".join(parts))
