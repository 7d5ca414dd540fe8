"""Column profile with induced expressions (problem 1).

Expressions are induced from the data alone. Each distinct value of a column is cut into fields (runs of capitals, of small
letters, of digits, other signs one by one); values with one sequence of fields have one shape. A part of an expression (a
shape, or a text in a field of it) is established where naming it costs at most COST bits a row in more than half of the
loads: log2(rows of the column / rows of the part), the share taken at the lower end of what chance allows. In each field of
an established shape description length decides between spelling every text out by a class of characters, and listing the
established texts as alternatives of the model, the others spelled out as exceptions. All of this is aggregates that combine
before the shuffle; what is established is bounded by 2**COST parts a column and load, so no list of values reaches a single
task or the driver.

A value conforms if its shape is established and each of its fields holds an alternative, or belongs to a class that is
established itself. The declared domain plays no part in this. It is asked last: rows of nonconforming expressions are
suspects, and those of them that the domain excludes are violations. What lies outside the domain but became a rule of the
column (more than one row in 2**COST in most loads) is thus no violation of the induced expressions; expressions() shows it,
load by load.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.runtime import cut, maybe_broadcast, small, stage

#: Bits a row that an established expression may cost: one row in 64.
COST = 6.0
#: Standard deviations by which a share may be due to chance.
CHANCE = 3.0
#: Bits of a character in the model.
CHARACTER = 8.0
#: Fields of a value beyond this many are one field.
FIELDS = 40
NULL_GAP, SHIFT_GAP = 0.05, 0.25


@dataclass(frozen=True)
class Spec:
    """A column to profile. inside: is a value of the domain (None: none is declared). context: relation to other
    columns of the row that puts it outside, as text, empty if none. bucket: what distributions are compared by."""

    name: str
    inside: Callable[[Column], Column] | None = None
    context: Callable[[], Column] | None = None
    bucket: Callable[[Column], Column] | None = None
    null_ok: bool = True


#: The stated domains of fiscal_period and form.
PERIODS = ["Q1", "Q2", "Q3", "Q4", "FY"]
FORMS = ["10-K", "10-Q", "10-K/A", "10-Q/A", "10-KT", "8-K", "8-K/A", "20-F", "20-F/A", "40-F", "6-K"]
FIRST_END = "1993-01-01"


def _date_relation() -> Column:
    end = F.col("end_date")
    return F.when(end > F.col("filed_date"), "after filed_date").when(end < F.col("start_date"), "before start_date").otherwise("")


SPECS = [
    Spec("fiscal_period", lambda v: v.isin(PERIODS)),
    Spec("form", lambda v: v.isin(FORMS), null_ok=False),
    Spec("end_date", lambda v: v.try_cast("date") >= F.lit(FIRST_END).cast("date"), _date_relation, lambda v: F.year(v.try_cast("date")).cast("string"), null_ok=False),
]


def _cells(df: DataFrame, specs: list[Spec], *keep: str) -> DataFrame:
    """One row for each row and profiled column: column_name, value (text), context."""
    cells = [F.struct(F.lit(s.name).alias("column_name"), F.col(f"`{s.name}`").cast("string").alias("value"), (s.context() if s.context else F.lit("")).alias("context")) for s in specs]
    return df.select(*[F.col(f"`{c}`") for c in keep], F.explode(F.array(*cells)).alias("_c")).select(*keep, "_c.*")


def value_counts(df: DataFrame, specs: list[Spec], load: str = "load_date") -> DataFrame:
    """column_name, load, value, context, n: combined before the shuffle. Nulls are values here."""
    return _cells(df, specs, load).groupBy("column_name", load, "value", F.coalesce("context", F.lit("")).alias("context")).agg(F.count(F.lit(1)).alias("n"))


def _by_column(specs: list[Spec], make: Callable[[Spec], Column | None], default: Column) -> Column:
    out = None
    for s in specs:
        x = make(s)
        if x is not None:
            out = (F.when(F.col("column_name") == s.name, x)) if out is None else out.when(F.col("column_name") == s.name, x)
    return default if out is None else out.otherwise(default)


def _field_class(c: Column) -> Column:
    """Class of a field by its first character: U, l, 9, or the sign itself."""
    return F.when(c.rlike("^[A-Z]"), F.lit("U")).when(c.rlike("^[a-z]"), F.lit("l")).when(c.rlike("^[0-9]"), F.lit("9")).otherwise(c)


def _escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\^$.|?*+()\[\]{}])", r"\\$1")


def _classy(fields: Column) -> Column:
    """Fields as classes of characters: one, or a run."""
    plus = lambda x: F.when(F.length(x) > 1, "+").otherwise("")
    return F.array_join(F.transform(fields, lambda x: F.when(x.rlike("^[A-Z]+$"), F.concat(F.lit("[A-Z]"), plus(x))).when(x.rlike("^[a-z]+$"), F.concat(F.lit("[a-z]"), plus(x))).when(x.rlike("^[0-9]+$"), F.concat(F.lit("[0-9]"), plus(x))).when(F.length(x) == 1, _escape(x)).otherwise(".+")), "")


def _values(counts: DataFrame, load: str) -> DataFrame:
    """Lines of counts with a value, plus fields, shape and the load as text. The rest of a value with very many fields is
    one field."""
    v = F.col("value")
    fields = F.regexp_extract_all(v, F.lit(r"([A-Z]+|[a-z]+|[0-9]+|[\s\S])"), F.lit(1))
    rest = F.array_join(F.slice(F.col("fields"), FIELDS, 1 << 30), "")
    out = counts.where(v.isNotNull()).withColumn("fields", fields).withColumn("fields", F.when(F.size("fields") > FIELDS, F.concat(F.slice("fields", 1, FIELDS - 1), F.array(rest))).otherwise(F.col("fields")))
    shape = F.transform(F.col("fields"), lambda x, i: F.when(i == FIELDS - 1, F.lit("~")).otherwise(_field_class(x)))
    return out.withColumn("shape", F.concat(F.array_join(shape, ""), F.lit("\u0001"), F.col("context"))).withColumn("_load", F.coalesce(F.col(load).cast("string"), F.lit("")))


def _often(parts: DataFrame, per_load: DataFrame, keys: list[str]) -> DataFrame:
    """parts (keys, _load, n) over all loads: keys, n, often (does it cost at most COST bits in most loads?)."""
    n, of = F.col("n").cast("double"), F.col("of").cast("double")
    sure = (n - CHANCE * F.sqrt(n)) / of
    one = parts.join(per_load, ["column_name", "_load"])
    return one.groupBy(*keys).agg(F.sum("n").alias("n"), (F.sum(F.when(sure >= 2.0**-COST, 1).otherwise(0)) * 2 > F.first("loads")).alias("often"))


def induce(values: DataFrame) -> DataFrame:
    """The established shapes of a staged _values(): column_name, shape, fields (by place: alternatives, listed, exceptions,
    expression). listed: the field holds alternatives; exceptions: its other texts are established as a class.

    Description length of a field in bits: listed, 8 a character of each alternative plus log2 of the inverse share for
    each row that has it, and the exceptions' own inverse share plus their characters; not listed, the characters of all."""
    per_load = values.groupBy("column_name", "_load").agg(F.sum("n").alias("of"))
    per_load = maybe_broadcast(cut(per_load.withColumn("loads", F.count(F.lit(1)).over(W.partitionBy("column_name")))))  # a row for each column and load
    shapes = _often(values.groupBy("column_name", "shape", "_load").agg(F.sum("n").alias("n")), per_load, ["column_name", "shape"]).where("often")
    shapes = cut(shapes.select("column_name", "shape", F.col("n").alias("rows")))
    inside = values.join(maybe_broadcast(shapes), ["column_name", "shape"])
    place = ["column_name", "shape", "pos"]
    texts = inside.select("column_name", "shape", "_load", "n", "rows", F.posexplode("fields").alias("pos", "text")).groupBy(*place, "_load", "text").agg(F.sum("n").alias("n"), F.first("rows").alias("rows"))
    texts = stage(texts, "fields")
    found = _often(texts, per_load, [*place, "text", "rows"])
    size, kind = F.length("text"), _field_class(F.col("text"))
    letter = F.when(kind.isin("U", "l"), F.log2(F.lit(26.0))).when(kind == "9", F.log2(F.lit(10.0))).otherwise(F.when(size > 1, CHARACTER).otherwise(0.0))
    n, rows = F.col("n").cast("double"), F.col("rows").cast("double")
    name = F.when(kind == "U", "[A-Z]").when(kind == "l", "[a-z]").when(kind == "9", "[0-9]").when(size == 1, _escape(F.col("text"))).otherwise(".+")
    fields = found.groupBy(*place).agg(
        F.max("rows").alias("rows"), F.sum(n * size * letter).alias("spelled"), F.sum(F.when(F.col("often"), CHARACTER * size + n * F.log2(rows / n)).otherwise(n * size * letter)).alias("listed_bits"), F.sum(F.when(F.col("often"), 0).otherwise(F.col("n"))).alias("rest"),
        F.sort_array(F.collect_list(F.when(F.col("often"), F.col("text")))).alias("alternatives"), F.min(size).alias("short"), F.max(size).alias("long"), F.min(name).alias("name"),
    )
    rest_bits = F.when(F.col("rest") > 0, F.col("rest") * F.log2(F.col("rows") / F.col("rest"))).otherwise(0.0)
    fields = cut(fields.withColumn("listed", (F.size("alternatives") > 0) & (F.col("listed_bits") + rest_bits < F.col("spelled"))))
    few = small(fields)  # a row for each field of the established shapes, and so is rest
    hint = F.broadcast if few else (lambda df: df)
    rest = texts.join(hint(fields.select(*place, "alternatives")), place).where(~F.array_contains("alternatives", F.col("text"))).groupBy(*place, "_load").agg(F.sum("n").alias("n"))
    rest = _often(rest, per_load, place).select(*place, F.col("often").alias("exceptions"))
    many = F.when(F.col("long") == 1, "").when(F.col("short") == F.col("long"), F.concat(F.lit("{"), F.col("long").cast("string"), F.lit("}"))).otherwise("+")
    spelled = F.when(F.col("name").rlike(r"^\[.*\]$"), F.concat("name", many)).otherwise(F.col("name"))
    options = F.array_join(F.transform("alternatives", _escape), "|")
    one = fields.join(hint(rest), place, "left").select(*place, F.struct("pos", "alternatives", "listed", F.coalesce("exceptions", F.lit(False)).alias("exceptions"), F.when(F.col("listed") & (F.size("alternatives") > 1), F.concat(F.lit("("), options, F.lit(")"))).when(F.col("listed"), options).otherwise(spelled).alias("expression"), spelled.alias("spelled")).alias("f"))
    return one.groupBy("column_name", "shape").agg(F.sort_array(F.collect_list("f")).alias("parts"))


def classified(counts: DataFrame, load: str = "load_date") -> DataFrame:
    """Each line of counts that has a value, plus expression and conforming."""
    values = stage(_values(counts, load), "values")
    model = cut(induce(values))
    j = values.join(maybe_broadcast(model), ["column_name", "shape"], "left")
    pairs = F.arrays_zip(F.col("fields"), F.col("parts"))
    own = lambda x: ~x["parts"]["listed"] | F.array_contains(x["parts"]["alternatives"], x["fields"])
    text = F.array_join(F.transform(pairs, lambda x: F.when(own(x), x["parts"]["expression"]).otherwise(x["parts"]["spelled"])), "")
    j = j.withColumn("conforming", F.col("parts").isNotNull() & F.coalesce(F.forall(pairs, lambda x: own(x) | x["parts"]["exceptions"]), F.lit(False)))
    known = F.when(F.col("parts").isNotNull(), text).otherwise(_classy(F.col("fields")))
    return j.withColumn("expression", F.concat(known, F.when(F.col("context") != "", F.concat(F.lit(" "), F.col("context"))).otherwise(""))).drop("fields", "shape", "parts", "_load")


def load_changes(counts: DataFrame, specs: list[Spec], load: str = "load_date") -> DataFrame:
    """Each load against all rows of the other loads: column_name, load, null_gap, shift. Rows without a load belong to
    none. With a single load there is nothing to compare and both are null; so is shift where either side has no value."""
    bucket = _by_column(specs, lambda s: s.bucket(F.col("value")) if s.bucket else None, F.col("value"))
    b = counts.where(F.col(load).isNotNull()).groupBy("column_name", load, bucket.alias("bucket")).agg(F.sum("n").alias("n"))
    filled = F.when(F.col("bucket").isNotNull(), F.col("n")).otherwise(0)
    one = b.groupBy("column_name", load).agg(F.sum(filled).alias("mine"), F.sum("n").alias("rows"))  # a row for each column and load
    column, value = W.partitionBy("column_name"), W.partitionBy("column_name", "bucket")
    one = one.select("*", F.sum("mine").over(column).alias("filled"), F.sum("rows").over(column).alias("total"))
    b = b.withColumn("all_v", F.sum("n").over(value)).join(maybe_broadcast(one), ["column_name", load])
    p, q = F.try_divide(F.col("n"), F.col("mine")), F.try_divide(F.col("all_v") - F.col("n"), F.col("filled") - F.col("mine"))
    is_value = F.col("bucket").isNotNull()
    out = b.groupBy("column_name", load).agg(
        F.sum(F.when(is_value, F.abs(p - q))).alias("_d"), F.sum(F.when(is_value, q)).alias("_q"), *[F.max(c).alias(c) for c in ("mine", "rows", "filled", "total")]
    )
    nulls = F.try_divide(F.col("rows") - F.col("mine"), F.col("rows"))
    others = F.try_divide((F.col("total") - F.col("filled")) - (F.col("rows") - F.col("mine")), F.col("total") - F.col("rows"))
    return out.select("column_name", load, F.col("rows"), nulls.alias("null_share"), F.abs(nulls - others).alias("null_gap"), ((F.col("_d") + (1.0 - F.col("_q"))) / 2.0).alias("shift"))


def found(df: DataFrame, specs: list[Spec] = SPECS, key: str = "row_no", load: str = "load_date") -> DataFrame:
    """finding, column_name, item_key: rows of nonconforming expressions that the domain excludes, and loads in which a
    column changed.

    Nulls: violate where the domain says so. A load of null is no load. Repeated rows count once by key. An empty table
    gives no row. Columns beside those of the specs, key and load are never read."""
    counts = cut(value_counts(df, specs, load))
    suspects = classified(counts, load).where(~F.col("conforming")).select("column_name", "value", "context")
    empty = counts.where(F.col("value").isNull() & F.col("column_name").isin([s.name for s in specs if not s.null_ok])).select("column_name", "value", "context")
    suspects = cut(suspects.unionByName(empty).select("column_name", F.coalesce("value", F.lit("\u0000")).alias("_v"), "context").distinct())
    cells = _cells(df, specs, key).select(key, "column_name", F.coalesce("value", F.lit("\u0000")).alias("_v"), F.coalesce("context", F.lit("")).alias("context"))
    rows = cells.join(maybe_broadcast(suspects), ["column_name", "_v", "context"])
    v = F.col("_v")
    ok = _by_column(specs, lambda s: F.coalesce(s.inside(v), F.lit(False)) if s.inside else None, F.lit(True)) & (F.col("context") == "")
    violations = rows.where((v == "\u0000") | ~ok).select(F.lit("violation").alias("finding"), "column_name", F.col(key).cast("string").alias("item_key"))
    changes = load_changes(counts, specs, load)
    day = F.date_format(load, "yyyy-MM-dd").alias("item_key")
    return violations.distinct().unionByName(changes.where(F.col("null_gap") > NULL_GAP).select(F.lit("nulls").alias("finding"), "column_name", day)).unionByName(changes.where(F.col("shift") > SHIFT_GAP).select(F.lit("shift").alias("finding"), "column_name", day))


def _by_expression(counts: DataFrame, load: str) -> DataFrame:
    """column_name, load, value (the expression), context (empty), conforming, n: counts in which expressions stand for values."""
    return stage(classified(counts, load).groupBy("column_name", load, F.col("expression").alias("value"), F.lit("").alias("context"), "conforming").agg(F.sum("n").alias("n")), "expressions")


def expressions(df: DataFrame, specs: list[Spec], load: str = "load_date") -> DataFrame:
    """Coverage of every expression in every load that has it: column_name, load, expression, conforming, n_rows, coverage
    (of the load's non-null rows), other_coverage (of those of all other loads; null where there are none), bits (cost of
    naming the expression over all loads)."""
    b = _by_expression(stage(value_counts(df, specs, load), "values"), load)
    one = b.groupBy("column_name", load).agg(F.sum("n").alias("mine"))
    both = one.join(maybe_broadcast(one.groupBy("column_name").agg(F.sum("mine").alias("filled"))), "column_name")
    total = b.groupBy("column_name", "value").agg(F.sum("n").alias("all_n"))
    j = b.withColumn("_l", F.coalesce(F.col(load).cast("string"), F.lit(""))).join(maybe_broadcast(both.select("column_name", F.coalesce(F.col(load).cast("string"), F.lit("")).alias("_l"), "mine", "filled")), ["column_name", "_l"]).join(total, ["column_name", "value"])
    return j.select("column_name", F.col(load), F.col("value").alias("expression"), "conforming", F.col("n").alias("n_rows"), (F.col("n") / F.col("mine")).alias("coverage"), F.try_divide(F.col("all_n") - F.col("n"), F.col("filled") - F.col("mine")).alias("other_coverage"), F.log2(F.col("filled") / F.col("all_n")).alias("bits"))


def profile(df: DataFrame, specs: list[Spec], load: str = "load_date") -> DataFrame:
    """A row for each load and column: rows, null_share, n_distinct, least, greatest, mean (numbers only), the leading
    expression with its share of the load's values, rows of nonconforming expressions, the gaps against the other loads, and
    expression_distance: half the summed differences of the coverage of all expressions against the other loads."""
    counts = stage(value_counts(df, specs, load), "counts")
    b = _by_expression(counts, load)
    lead = b.groupBy("column_name", load).agg(F.max(F.struct("n", F.col("value").alias("expression"))).alias("top"), F.sum("n").alias("filled"), F.sum(F.when(F.col("conforming"), 0).otherwise(F.col("n"))).alias("nonconforming"))
    number = F.expr("try_cast(value as double)")
    basics = counts.groupBy("column_name", load).agg(F.countDistinct("value").alias("n_distinct"), F.min("value").alias("least"), F.max("value").alias("greatest"), F.try_divide(F.sum(number * F.col("n")), F.sum(F.when(number.isNotNull(), F.col("n")))).alias("mean"))
    plain = [Spec(s.name) for s in specs]
    distance = load_changes(b, plain, load).select("column_name", load, F.col("shift").alias("expression_distance"))
    out = load_changes(counts, specs, load).join(basics, ["column_name", load], "left").join(lead, ["column_name", load], "left").join(distance, ["column_name", load], "left")
    return out.select("column_name", F.col(load), "rows", "null_share", "n_distinct", "least", "greatest", "mean", F.col("top.expression").alias("expression"), (F.col("top.n") / F.col("filled")).alias("expression_share"), F.coalesce("nonconforming", F.lit(0)).alias("nonconforming"), "null_gap", "shift", "expression_distance")
