"""Nested documents to related flat tables by Merkle identities (problem 2).

Bottom-up, every object of a document is reduced to its scalars and the identities of its children, in canonical form,
and hashed. Identical objects are one row of the node table; each occurrence is one row of the bridge table, which has
the parent's identity, the keys of all parents, the field it stands in and the place in the parent's list. The flat tables
are the bridge joined with the nodes.

Company, concept, unit and observation are kinds of their own. Whatever else is nested in one of them, at any depth, is
an `object` (or, inside a list, a `list` or a `value`) with the same links, so no field is lost. All walks keep their own
stack: depth is bounded only by what the JSON parser itself can follow.

Canonical form: keys sorted, nulls and absent fields and empty lists alike, whole numbers and numbers as text alike in
numeric fields.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.runtime import stage

#: Fields whose numbers may come as text.
NUMERIC = ("val", "fy", "cik")
SCALARS = ("start", "end", "val", "accn", "fy", "fp", "form", "filed", "frame")
RAW = "kind string, file_no long, parent_id binary, node_id binary, cik int, taxonomy string, concept string, unit string, field string, ordinal int, body string, usable boolean"
KIND, PARENT, NODE, BODY = 0, 2, 3, 10


def number(x) -> float | None:
    """A number, also as text with thousands separators; None for anything else."""
    if isinstance(x, bool) or x is None:
        return None
    if isinstance(x, (int, float)):
        try:
            return float(x)
        except OverflowError:
            return math.inf
    if isinstance(x, str):
        t = re.sub(r"[,\s_]", "", x)
        try:
            return float(t) if t else None
        except ValueError:
            return None
    return None


def _plain(key: str, x):
    if key in NUMERIC:
        n = number(x)
        if n is not None and math.isfinite(n):
            return int(n) if n == int(n) else n
    return x


def identity(kind: str, fields: dict, children: list[tuple[str, int, bytes]] = ()) -> tuple[bytes, str]:
    """Merkle identity of an object and its canonical text. Children (field, place, identity) count with their order."""
    own = {str(k): _plain(k, v) for k, v in fields.items() if v is not None}
    body = json.dumps(own, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=str)
    h = hashlib.blake2b(kind.encode(), digest_size=16)
    h.update(body.encode("utf-8", "surrogatepass"))
    for field, place, c in children:
        h.update(f"\0{field}\0{place}\0".encode("utf-8", "surrogatepass"))
        h.update(c)
    return h.digest(), body


def scalars(x: dict) -> dict:
    return {k: v for k, v in x.items() if not isinstance(v, (dict, list))}


def _parts(x) -> Iterator[tuple[str, int, object]]:
    """Nested parts of a value: field, place, part. Of a list every element that isn't null; places count nulls."""
    if isinstance(x, list):
        yield from (("", k, y) for k, y in enumerate(x) if y is not None)
    elif isinstance(x, dict):
        for field, v in x.items():
            if isinstance(v, dict):
                yield str(field), 0, v
            elif isinstance(v, list):
                yield from ((str(field), k, y) for k, y in enumerate(v) if y is not None)


def subtree(parts: Iterator[tuple[str, int, object]], keys: tuple, rows: list[list]) -> list[tuple[str, int, bytes]]:
    """Rows of everything nested in `parts`, children before parents, and the links to the topmost."""
    top: list[tuple[str, int, bytes]] = []
    own: list[list] = []
    stack = [(None, "", 0, parts, top, own)]  # value, field, place, parts to come, links and rows of finished children
    while stack:
        value, field, place, todo, links, mine = stack[-1]
        nxt = next(todo, None)
        if nxt is not None:
            stack.append((nxt[2], nxt[0], nxt[1], _parts(nxt[2]), [], []))
            continue
        stack.pop()
        if not stack:
            break
        if isinstance(value, dict):
            kind, fields = "object", scalars(value)
        else:
            kind, fields = ("list", {}) if isinstance(value, list) else ("value", {"value": value})
        node, body = identity(kind, fields, links)
        for r in mine:
            r[PARENT] = node
        row = [kind, keys[0], None, node, *keys[1:], field, place, body, True]
        rows.append(row)
        stack[-1][4].append((field, place, node))
        stack[-1][5].append(row)
    return top, own


def parse(payload: str | None):
    """The JSON value of a payload, None if it isn't complete JSON. A byte order mark and blanks around don't matter."""
    if payload is None:
        return None
    try:
        return json.loads(payload.strip().lstrip("﻿"))
    except (ValueError, RecursionError):
        return None


def documents(x) -> Iterator[dict]:
    """The company documents in a value, in order: the object itself, or inside lists, JSON strings and envelopes."""
    stack = [x]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            x = parse(x)
            if isinstance(x, (dict, list)):
                stack.append(x)
        elif isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            if "facts" in x or "cik" in x or "entityName" in x:
                yield x
            else:
                stack.extend(y for y in reversed(list(x.values())) if isinstance(y, (dict, list)) or isinstance(y, str) and y.lstrip()[:1] in ("{", "["))


def usable(o: dict) -> bool:
    end = o.get("end")
    return end is not None and not (isinstance(end, str) and not end.strip()) and number(o.get("val")) is not None


def occurrences(file_no: int, file_name: str | None, payload: str | None) -> Iterator[list]:
    """Rows of RAW for one file, children before parents."""
    for doc in documents(parse(payload)):
        n = number(doc.get("cik"))
        if n is None or not math.isfinite(n) or not -(2**31) <= n < 2**31:
            digits = re.search(r"(\d+)", file_name or "")
            n = int(digits.group(1)) if digits else None
        cik = None if n is None or n >= 2**31 else int(n)
        rows: list[list] = []

        def close(kind: str, fields: dict, links: list, children: list[list], at: tuple, ordinal: int, good: bool = True, rows=rows, cik=cik) -> tuple[bytes, list]:
            node, body = identity(kind, fields, links)
            for r in children:
                r[PARENT] = node
            row = [kind, file_no, None, node, cik, *at, "", ordinal, body, good]
            rows.append(row)
            return node, row

        def rest(x: dict, *spine: str):
            """What is nested beside the spine's own field."""
            return ((f, k, v) for f, k, v in _parts({a: b for a, b in x.items() if a not in spine}))

        facts, concepts, concept_rows = doc.get("facts"), [], []
        company_links, company_children = [], []
        spine = ("facts",) if isinstance(facts, dict) else ()
        for taxonomy, named in facts.items() if isinstance(facts, dict) else ():
            if not isinstance(named, dict):
                if named is not None:
                    links, children = subtree(iter([(taxonomy, 0, named)]), (file_no, cik, taxonomy, None, None), rows)
                    company_links += links
                    company_children += children
                continue
            for concept, c in named.items():
                if not isinstance(c, dict):
                    if c is not None:
                        links, children = subtree(iter([(concept, 0, c)]), (file_no, cik, taxonomy, concept, None), rows)
                        company_links += links
                        company_children += children
                    continue
                units, unit_links, unit_rows = c.get("units"), [], []
                for unit, listed in units.items() if isinstance(units, dict) else ():
                    here = (taxonomy, concept, unit)
                    single = isinstance(listed, dict)
                    listed = [listed] if single else listed if isinstance(listed, list) else [] if listed is None else [listed]
                    links, children = [], []
                    for k, o in enumerate(listed):
                        if isinstance(o, dict):
                            sub, below = subtree(_parts(o), (file_no, cik, *here), rows)
                            node, row = close("observation", scalars(o), sub, below, here, k, usable(o))
                            links.append(("", k, node))
                            children.append(row)
                        elif o is not None:
                            sub, below = subtree(iter([("", k, o)]), (file_no, cik, *here), rows)
                            links += sub
                            children += below
                    node, row = close("unit", {"unit": unit}, links, children, here, len(unit_rows))
                    unit_links.append(("units", len(unit_rows), node))
                    unit_rows.append(row)
                sub, below = subtree(rest(c, *(("units",) if isinstance(units, dict) else ())), (file_no, cik, taxonomy, concept, None), rows)
                node, row = close("concept", scalars(c) | {"taxonomy": taxonomy, "concept": concept}, unit_links + sub, unit_rows + below, (taxonomy, concept, None), len(concept_rows))
                concepts.append(("facts", len(concept_rows), node))
                concept_rows.append(row)
        sub, below = subtree(rest(doc, *spine), (file_no, cik, None, None, None), rows)
        close("company", scalars(doc) | {"cik": cik}, concepts + company_links + sub, concept_rows + company_children + below, (None, None, None), 0)
        yield from rows


def _decompose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RAW.split(", ")]
    for b in batches:
        out: list[list] = []
        seen: set[bytes] = set()
        for row in zip(b["file_no"], b["file_name"], b["payload"], strict=True):
            for r in occurrences(*row):
                if r[NODE] in seen:  # the body goes along once a batch
                    r[BODY] = None
                seen.add(r[NODE])
                out.append(r)
            if len(out) >= 20_000:
                yield _frame(out, names)
                out, seen = [], set()
        yield _frame(out, names)


def _frame(out: list[tuple], names: list[str]) -> pd.DataFrame:
    df = pd.DataFrame(out, columns=names)
    for c in ("cik", "ordinal"):
        df[c] = df[c].astype("Int32")
    return df


class Nested:
    """Node and bridge tables of a set of files, and the flat tables made of them. The decomposition runs once, and so
    does the making of the node table where a flat table asks for its bodies."""

    def __init__(self, files: DataFrame):
        slim = files.select(F.col("file_no").cast("long").alias("file_no"), F.col("file_name").cast("string"), F.col("payload").cast("string"))
        self.rows = stage(slim.mapInPandas(_decompose, RAW), "merkle")
        self._nodes: DataFrame | None = None

    def nodes(self, kind: str | None = None) -> DataFrame:
        """node_id, kind, body, usable: each distinct object once."""
        if self._nodes is None:
            self._nodes = stage(self.rows.where(F.col("body").isNotNull()).groupBy("node_id", "kind").agg(F.max("body").alias("body"), F.bool_or("usable").alias("usable")), "nodes")
        return self._nodes.where(F.col("kind") == kind).drop("kind") if kind else self._nodes

    def bridge(self, kind: str | None = None) -> DataFrame:
        """One row an occurrence: kind, file_no, parent_id, node_id, cik, taxonomy, concept, unit, field, ordinal."""
        b = self.rows.drop("body", "usable")
        return b.where(F.col("kind") == kind) if kind else b

    def companies(self) -> DataFrame:
        n = self.nodes("company").select("node_id", F.get_json_object("body", "$.entityName").alias("entity_name"))
        return self.bridge("company").join(n, "node_id").select("file_no", "cik", "entity_name", F.hex("node_id").alias("node_id"))

    def concepts(self) -> DataFrame:
        n = self.nodes("concept").select("node_id", F.get_json_object("body", "$.label").alias("label"), F.get_json_object("body", "$.description").alias("description"))
        return self.bridge("concept").join(n, "node_id").select("file_no", "cik", "taxonomy", "concept", "ordinal", "label", "description", F.hex("parent_id").alias("parent_id"), F.hex("node_id").alias("node_id"))

    def units(self) -> DataFrame:
        return self.bridge("unit").select("file_no", "cik", "taxonomy", "concept", "unit", "ordinal", F.hex("parent_id").alias("parent_id"), F.hex("node_id").alias("node_id"))

    def observations(self) -> DataFrame:
        fields = "struct<" + ",".join(f"`{f}`:string" for f in SCALARS) + ">"
        n = self.nodes("observation").select("node_id", "usable", F.from_json("body", fields).alias("o"))
        return self.bridge("observation").join(n, "node_id").select(
            "file_no", "cik", "taxonomy", "concept", "unit", F.col("ordinal").alias("obs_no"), F.to_date(F.expr("try_cast(o.start as date)")).alias("start_date"), F.to_date(F.expr("try_cast(o.end as date)")).alias("end_date"), F.expr("try_cast(o.val as double)").alias("val"),
            F.col("o.accn").alias("accession_number"), F.expr("try_cast(o.fy as int)").alias("fiscal_year"), F.col("o.fp").alias("fiscal_period"), F.col("o.form").alias("form"), F.expr("try_cast(o.filed as date)").alias("filed_date"), F.col("o.frame").alias("frame"), "usable", F.hex("parent_id").alias("parent_id"),
            F.hex("node_id").alias("node_id"),
        )

    def parts(self) -> DataFrame:
        """Whatever is nested beside the spine: field and place in the parent, and the object's own scalars as JSON."""
        b = self.rows.drop("body", "usable").where(F.col("kind").isin("object", "list", "value"))
        n = self.nodes().where(F.col("kind").isin("object", "list", "value")).select("node_id", "body")
        return b.join(n, "node_id").select("file_no", "cik", "taxonomy", "concept", "unit", "kind", "field", "ordinal", "body", F.hex("parent_id").alias("parent_id"), F.hex("node_id").alias("node_id"))


def found(files: DataFrame) -> DataFrame:
    """file_no, cik, taxonomy, concept, unit, obs_no of every usable observation.

    A null or incomplete payload, an empty table, and levels that are absent, null or of another shape give no row; a
    file that came twice counts twice under its own file_no. An object in place of a list is observation 0."""
    n = Nested(files)
    good = n.rows.where((F.col("kind") == "observation") & F.col("usable") & F.col("body").isNotNull()).select("node_id").distinct()
    return n.bridge("observation").join(good, "node_id").select("file_no", "cik", "taxonomy", "concept", "unit", F.col("ordinal").alias("obs_no")).distinct()
