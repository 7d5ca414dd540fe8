"""Column expressions of the facts model. All stay in whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def grain_hash(*cols: Column | str) -> Column:
    """First 16 hex digits of SHA-256 over the |-joined fields; a null field is the empty text."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]), 256), 1, 16)


def end_month(fiscal_year_end: Column) -> Column:
    """Month of an MMDD text, null where it isn't one."""
    return F.try_to_number(F.substring(fiscal_year_end, 1, 2), F.lit("99")).cast("int")


def fiscal_year(end: Column, fiscal_year_end: Column) -> Column:
    """Year in which the fiscal year of the period ends; without a year end, or with December, the calendar year."""
    month = end_month(fiscal_year_end)
    return (F.year(end) + F.when((month != 12) & (F.month(end) > month), 1).otherwise(0)).cast("int")


def fiscal_period(start: Column, end: Column, stated: Column) -> Column:
    """FY for 350 days or more; else what the filing states, FY where it states nothing."""
    return F.when(F.datediff(end, start) >= 350, "FY").otherwise(F.coalesce(F.nullif(stated, F.lit("")), F.lit("FY")))


def is_amendment(form: Column) -> Column:
    return F.coalesce(form.endswith("/A"), F.lit(False))


def title_name(name: Column) -> Column:
    """Title case after each non-letter, blanks collapsed and trimmed (ASCII letters)."""
    parts = F.split(F.lower(F.trim(name)), "(?<![a-z])(?=[a-z])")
    return F.regexp_replace(F.array_join(F.transform(parts, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), t.substr(F.lit(2), F.length(t)))), ""), r"\s+", " ")


def pct_of_abs(new: Column, base: Column, scale: float = 1.0) -> Column:
    """(new - base) / |base|, null where base is 0."""
    return F.try_divide(new - base, F.abs(base)) * scale


def cagr(ratio: Column, years: int) -> Column:
    """Compound growth; for a negative ratio -(|ratio|^(1/years)) - 1."""
    root = F.pow(F.abs(ratio), F.lit(1.0 / years))
    return F.when(ratio <= 0, -root - 1).otherwise(root - 1)


def median_upper(name: str) -> Column:
    """The upper of the two middle values of an even number, as an aggregate that combines before the shuffle."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{name}` DESC)")


def first_match(value: Column, rules: Sequence[tuple], test) -> Column:
    """The payload struct of the first rule that holds, null if none does. rules: (pattern, *payload)."""
    out: Column | None = None
    for pattern, *payload in rules:
        s = F.struct(*[F.lit(p).alias(f"p{i}") for i, p in enumerate(payload)])
        out = F.when(test(value, pattern), s) if out is None else out.when(test(value, pattern), s)
    return out


def trend(pcts: Column) -> Column:
    """Label of an array of year-over-year changes."""
    n = F.size(pcts)
    up, down = F.size(F.filter(pcts, lambda p: p > 0.01)), F.size(F.filter(pcts, lambda p: p < -0.01))
    label = F.when((up > 0) & (down > 0) & (F.least(up, down) / n > 0.3), "volatile").when(up / n >= 0.7, "growing").when(down / n >= 0.7, "declining").otherwise("stable")
    return F.when(pcts.isNull() | (n < 2), "insufficient_data").otherwise(label)
