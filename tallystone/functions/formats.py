"""Figures as text, and flags on figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fixed(c: Column, digits: int) -> Column:
    """Half-even rounding, no thousands separators."""
    return F.regexp_replace(F.format_number(c, digits), ",", "")


def _signed(c: Column, text: Column) -> Column:
    return F.when(c < 0, F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)


def currency(c: Column) -> Column:
    a = F.abs(c)
    text = None
    for limit, suffix in ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K")):
        x = F.concat(F.lit("$"), _fixed(a / limit, 1), F.lit(suffix))
        text = F.when(a >= limit, x) if text is None else text.when(a >= limit, x)
    return F.coalesce(_signed(c, text.otherwise(F.concat(F.lit("$"), _fixed(a, 2)))), F.lit("N/A"))


def percentage(c: Column) -> Column:
    return F.coalesce(_signed(c, F.concat(_fixed(F.abs(c * 100), 1), F.lit("%"))), F.lit("N/A"))


def per_share(c: Column) -> Column:
    return F.coalesce(_signed(c, F.concat(F.lit("$"), _fixed(F.abs(c), 2))), F.lit("N/A"))


def multiple(c: Column) -> Column:
    return F.coalesce(_signed(c, F.concat(_fixed(F.abs(c), 1), F.lit("x"))), F.lit("N/A"))


def yoy(c: Column) -> Column:
    return F.coalesce(F.concat(F.when(c > 0, "+").otherwise(""), F.when((c < 0), "-").otherwise(""), _fixed(F.abs(c * 100), 1), F.lit("%")), F.lit("N/A"))


def value(c: Column, unit: Column, metric_type: Column | None = None) -> Column:
    """By unit or type of metric; without either, large values are currency and fractions percentages."""
    kind = metric_type if metric_type is not None else F.lit(None).cast("string")
    a = F.abs(c)
    out = F.when(unit.eqNullSafe("USD/shares") | kind.eqNullSafe("per_share"), per_share(c)).when(unit.eqNullSafe("ratio") | kind.eqNullSafe("ratio"), multiple(c)).when(unit.eqNullSafe("percentage") | kind.eqNullSafe("percentage"), percentage(c))
    out = out.when(unit.eqNullSafe("USD") | kind.eqNullSafe("currency"), currency(c)).when(a >= 1000, currency(c)).when((a < 1) & (a > 0), percentage(c)).otherwise(F.format_number(c, 2))
    return F.when(c.isNull(), "N/A").otherwise(out)


def anomaly_flags(val: Column, metric: Column, yoy_pct: Column, ratio_name: Column, net_margin: Column, sector: Column) -> Column:
    """Names of the rules that a figure breaks, in a fixed order; a null figure breaks none."""
    m, r = F.lower(metric), F.lower(ratio_name)
    rules = [
        ("extreme_yoy", F.abs(yoy_pct) > 2.0),
        ("negative_equity", m.contains("stockholders equity") & (val < 0)),
        ("extreme_leverage", r.contains("debt") & r.contains("equity") & (F.abs(val) > 50)),
        ("negative_revenue", m.contains("revenue") & (val < 0)),
        ("pre_profitability", net_margin < -1.0),
        ("not_applicable", (sector == "Financials") & (m.contains("gross margin") | m.contains("operating margin"))),
    ]
    return F.when(val.isNull(), F.array().cast("array<string>")).otherwise(F.filter(F.array(*[F.when(c, n) for n, c in rules]), lambda x: x.isNotNull()))


#: The text of each flag; {} stands for the figure.
FLAG_TEXTS = {
    "extreme_yoy": "Unusually large year-over-year change ({}%). May reflect M&A, reclassification, or one-time event.",
    "negative_equity": "Negative stockholders equity. Debt-to-equity ratio reflects negative equity denominator, not extreme debt.",
    "extreme_leverage": "Extreme leverage ratio ({}x) driven by near-zero or negative equity denominator.",
    "negative_revenue": "Data quality anomaly in source XBRL filing. Exercise caution.",
    "pre_profitability": "Pre-profitability period. Operating losses exceeded revenue.",
    "not_applicable": "Financial institutions use different P&L structures. This metric is not applicable.",
}


def anomaly_texts(val: Column, metric: Column, yoy_pct: Column, ratio_name: Column, net_margin: Column, sector: Column) -> Column:
    """The flags of anomaly_flags as sentences with their figures."""
    figures = {"extreme_yoy": _fixed(F.abs(yoy_pct) * 100, 0), "extreme_leverage": _fixed(val, 1)}

    def text(name: str) -> Column:
        before, _, after = FLAG_TEXTS[name].partition("{}")
        return F.concat(F.lit(before), figures[name], F.lit(after)) if name in figures else F.lit(before)

    def named(f: Column) -> Column:
        out = None
        for n in FLAG_TEXTS:
            out = F.when(f == n, text(n)) if out is None else out.when(f == n, text(n))
        return out

    return F.transform(anomaly_flags(val, metric, yoy_pct, ratio_name, net_margin, sector), named)


def year_end_distance(a: Column, b: Column) -> Column:
    """Days between two MMDD year ends on one calendar, at most half a year; null where either isn't one."""
    day = lambda c: F.make_date(F.lit(2024), F.try_to_number(F.substring(c, 1, 2), F.lit("99")).cast("int"), F.least(F.try_to_number(F.substring(c, 3, 2), F.lit("99")).cast("int"), F.lit(28)))
    ok = a.rlike("^(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$") & b.rlike("^(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$")
    d = F.abs(F.datediff(day(F.when(ok, a)), day(F.when(ok, b))))
    return F.when(d > 182, 365 - d).otherwise(d)
