"""Parameterised analytic tools over the consumable tables.

Every tool is one joined plan with parameters as literals; results are a few rows, returned as dicts. A failure is
{"error": text}, never an exception. Tickers are compared in upper case.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.functions import formats

TABLES = ("company_financials", "financial_ratios", "period_over_period", "peer_comparison", "amendment_analysis")


class NotFound(ValueError):
    """No such metric, company or row."""


def tool(f):
    @wraps(f)
    def run(self, *args, **kwargs):
        try:
            return f(self, *args, **kwargs)
        except Exception as e:  # noqa: BLE001
            return {"error": str(e)}

    run.is_tool = True
    return run


class Tools:
    """The tables are cached on first use; reset() frees them. A missing table is empty and noted in `missing`."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame], cache: bool = True):
        self.spark, self.frames, self.cache = spark, frames, cache
        self.missing = [t for t in TABLES if t not in frames]
        self._cached: dict[str, DataFrame] = {}
        self._names: list[tuple[str, str, str]] | None = None

    def table(self, name: str) -> DataFrame:
        if name not in self._cached:
            if name not in self.frames:
                raise NotFound(f"table {name} is missing")
            self._cached[name] = self.frames[name].cache() if self.cache else self.frames[name]
        return self._cached[name]

    def reset(self) -> None:
        for df in self._cached.values():
            df.unpersist()
        self._cached, self._names = {}, None

    def row_counts(self) -> dict[str, int]:
        return {t: (self.table(t).count() if t in self.frames else 0) for t in TABLES}

    def names(self) -> list[tuple[str, str, str]]:
        """(id, name, source) of the metrics and ratios that there are, by id."""
        if self._names is None:
            m = self.table("company_financials").select(F.col("business_term_id").alias("id"), F.col("business_term").alias("name"), F.lit("company_financials").alias("source"))
            r = self.table("financial_ratios").select(F.col("ratio_id").alias("id"), F.col("ratio_name").alias("name"), F.lit("financial_ratios").alias("source"))
            got = m.unionByName(r).where(F.col("id").isNotNull() & F.col("name").isNotNull()).groupBy("id", "source").agg(F.min("name").alias("name")).collect()  # one row a metric
            self._names = sorted((x["id"], x["name"], x["source"]) for x in got)
        return self._names

    def resolve(self, text: str, source: str | None = None) -> tuple[str, str, str]:
        """(id, name, source) by id prefix (an id that isn't known keeps its text as name), by exact name, by part of the
        name; figures before ratios, of several the least id."""
        t = text.strip().lower()
        order = [s for s in ("company_financials", "financial_ratios") if source in (None, s)]
        for prefix, s in (("bt-", "company_financials"), ("ratio-", "financial_ratios")):
            if t.startswith(prefix) and s in order:
                return next((n for n in self.names() if n[0].lower() == t and n[2] == s), (t.upper(), text, s))
        for test in (lambda n: n[1].lower() == t, lambda n: t in n[1].lower()):
            for s in order:
                hit = [n for n in self.names() if n[2] == s and test(n)]
                if hit:
                    return hit[0]
        raise NotFound(f"unknown metric {text!r}; there are {', '.join(n[1] for n in self.names() if n[2] in order)}")

    def _growth(self) -> DataFrame:
        g = self.table("period_over_period")
        pick = lambda k: F.max(F.when(F.col("growth_type") == k, F.col("growth_value"))).alias(k)
        return g.groupBy("cik", "business_term_id", "fiscal_year", "fiscal_period").agg(*[pick(k) for k in ("yoy_change", "yoy_pct_change", "cagr_5yr")])

    def _peers(self, source: str) -> DataFrame:
        p = self.table("peer_comparison").where(F.col("metric_source") == source)
        return p.select("cik", F.col("metric_id"), "fiscal_year", "fiscal_period", "sector_rank", "peer_count", "sector_percentile", "sector_median")

    def _margin(self) -> DataFrame:
        return self.table("financial_ratios").where(F.col("ratio_name") == "Net Margin").groupBy("cik", "fiscal_year", "fiscal_period").agg(F.max("ratio_value").alias("net_margin"))

    def _metrics(self, rows: DataFrame) -> DataFrame:
        """Financials with growth, rank, margin, text and flags: three left joins."""
        k = ["cik", "fiscal_year", "fiscal_period"]
        j = rows.join(self._growth(), [*k, "business_term_id"], "left").join(self._peers("company_financials").withColumnRenamed("metric_id", "business_term_id"), [*k, "business_term_id"], "left").join(self._margin(), k, "left")
        return j.withColumns({"formatted": formats.value(F.col("val"), F.col("unit")), "yoy_formatted": formats.yoy(F.col("yoy_pct_change")), "flags": formats.anomaly_texts(F.col("val"), F.col("business_term"), F.col("yoy_pct_change"), F.lit(None).cast("string"), F.col("net_margin"), F.col("sector"))})

    @staticmethod
    def _one(df: DataFrame, order: list, what: str) -> dict:
        got = df.orderBy(*order).limit(1).collect()
        if not got:
            raise NotFound(f"nothing for {what}")
        return got[0].asDict(recursive=True)

    @tool
    def get_company_metric(self, ticker: str, metric: str, fiscal_year: int | None = None, fiscal_period: str = "FY") -> dict:
        """One figure, of a year or the latest, with growth, rank among peers, text and flags."""
        mid, _, _ = self.resolve(metric, "company_financials")
        f = self.table("company_financials").where((F.upper("ticker") == ticker.upper()) & (F.col("business_term_id") == mid) & (F.col("fiscal_period") == fiscal_period))
        f = f if fiscal_year is None else f.where(F.col("fiscal_year") == fiscal_year)
        top = f.orderBy(F.col("fiscal_year").desc(), F.col("filed_date").desc_nulls_last(), "record_id").limit(1)
        return self._one(self._metrics(top), ["cik"], f"{ticker} {metric}")

    @tool
    def get_company_profile(self, ticker: str, fiscal_year: int | None = None) -> dict:
        """All yearly figures and ratios of a company for a year or the latest, its amendments, and all flags once."""
        mine = (F.upper("ticker") == ticker.upper()) & (F.col("fiscal_period") == "FY")
        f = self.table("company_financials").where(mine)
        year = fiscal_year or f.agg(F.max("fiscal_year")).first()[0]
        metrics = [r.asDict(recursive=True) for r in self._metrics(f.where(F.col("fiscal_year") == year)).orderBy("business_term", "record_id").collect()]  # one company and year
        if not metrics:
            raise NotFound(f"nothing for {ticker} {year}")
        peers = self._peers("financial_ratios").withColumnRenamed("metric_id", "ratio_id")
        r = self.table("financial_ratios").where(mine & (F.col("fiscal_year") == year)).join(peers, ["cik", "fiscal_year", "fiscal_period", "ratio_id"], "left")
        r = r.withColumn("flags", formats.anomaly_texts(F.col("ratio_value"), F.lit(None).cast("string"), F.lit(None).cast("double"), F.col("ratio_name"), F.lit(None).cast("double"), F.col("sector")))
        ratios = [x.asDict(recursive=True) for x in r.orderBy("ratio_name", "record_id").collect()]
        am = []
        if "amendment_analysis" in self.frames:
            am = [x.asDict(recursive=True) for x in self.table("amendment_analysis").where((F.col("cik") == metrics[0]["cik"]) & (F.col("fiscal_year") == year)).limit(1).collect()]
        flags = list(dict.fromkeys(x for row in metrics + ratios for x in row["flags"]))
        return {"ticker": ticker.upper(), "fiscal_year": year, "metrics": metrics, "ratios": ratios, "amendments": am[0] if am else None, "flags": flags}

    @tool
    def compare_companies(self, ticker_a: str, ticker_b: str, fiscal_year: int | None = None, metrics: list[str] | None = None) -> dict:
        """Shared yearly metrics of two companies for a year, or the latest that both have."""
        f = self.table("company_financials").where(F.col("fiscal_period") == "FY")
        a, b = (f.where(F.upper("ticker") == t.upper()) for t in (ticker_a, ticker_b))
        if fiscal_year is None:
            fiscal_year = a.select("fiscal_year").intersect(b.select("fiscal_year")).agg(F.max("fiscal_year")).first()[0]
        if fiscal_year is None:
            raise NotFound("no common year")
        if metrics:
            ids = [self.resolve(m, "company_financials")[0] for m in metrics]
            a, b = (x.where(F.col("business_term_id").isin(ids)) for x in (a, b))
        pick = lambda x, s: x.where((F.col("fiscal_year") == fiscal_year) & F.col("val").isNotNull()).groupBy("business_term_id").agg(F.max("business_term").alias(f"name_{s}"), F.max("val").alias(f"val_{s}"), F.max("unit").alias(f"unit_{s}"), F.max("fiscal_year_end").alias(f"fye_{s}"))
        j = pick(a, "a").join(pick(b, "b"), "business_term_id")
        rows = j.select("business_term_id", F.col("name_a").alias("metric"), "val_a", "val_b", (F.col("val_a") - F.col("val_b")).alias("delta"), X.pct_of_abs(F.col("val_a"), F.col("val_b")).alias("delta_pct"), F.when(F.col("val_a") > F.col("val_b"), ticker_a.upper()).when(F.col("val_a") < F.col("val_b"), ticker_b.upper()).otherwise("tie").alias("winner"), formats.value(F.col("val_a"), F.col("unit_a")).alias("formatted_a"), formats.value(F.col("val_b"), F.col("unit_b")).alias("formatted_b"), formats.year_end_distance(F.col("fye_a"), F.col("fye_b")).alias("year_end_days"))
        got = [r.asDict() for r in rows.orderBy("business_term_id").collect()]
        if not got:
            raise NotFound("no shared metric")
        apart = got[0]["year_end_days"]
        return {"fiscal_year": fiscal_year, "comparison": got, "warning": f"fiscal year ends differ by {apart} days" if apart and apart > 30 else None}

    @tool
    def rank_companies(self, metric: str, fiscal_year: int | None = None, sector: str | None = None, top_n: int | None = None, metric_source: str | None = None) -> dict:
        """Companies by a metric or ratio, greatest first."""
        mid, name, source = self.resolve(metric, metric_source)
        key, val = ("business_term_id", "val") if source == "company_financials" else ("ratio_id", "ratio_value")
        f = self.table(source).where((F.col(key) == mid) & (F.col("fiscal_period") == "FY") & F.col(val).isNotNull())
        f = f if sector is None else f.where(F.col("sector") == sector)
        year = fiscal_year or f.agg(F.max("fiscal_year")).first()[0]
        one = f.where(F.col("fiscal_year") == year).groupBy("cik").agg(F.max("ticker").alias("ticker"), F.max(val).alias("value"))
        n = one.count()
        top = one.orderBy(F.col("value").desc(), "ticker", "cik")
        rows = (top.limit(top_n) if top_n else top).collect()  # one row a company
        return {"metric": name, "fiscal_year": year, "companies_included": n, "ranking": [{"rank": i + 1, **r.asDict()} for i, r in enumerate(rows)]}

    @tool
    def get_company_trend(self, ticker: str, metric: str, start_year: int | None = None, end_year: int | None = None) -> dict:
        """Yearly series with growth and a label of the trend."""
        mid, name, _ = self.resolve(metric, "company_financials")
        f = self.table("company_financials").where((F.upper("ticker") == ticker.upper()) & (F.col("business_term_id") == mid) & (F.col("fiscal_period") == "FY") & F.col("fiscal_year").between(start_year or 0, end_year or 9999))
        j = f.groupBy("cik", "business_term_id", "fiscal_year", "fiscal_period").agg(F.max("val").alias("val")).join(self._growth(), ["cik", "business_term_id", "fiscal_year", "fiscal_period"], "left")
        rows = [r.asDict() for r in j.orderBy("fiscal_year").collect()]  # one row a year
        if not rows:
            raise NotFound(f"nothing for {ticker} {metric}")
        pcts = [r["yoy_pct_change"] for r in rows if r["yoy_pct_change"] is not None]
        label = self.spark.range(1).select(X.trend(F.array(*[F.lit(float(p)) for p in pcts]).cast("array<double>"))).first()[0]
        return {"metric": name, "series": [{k: r[k] for k in ("fiscal_year", "val", "yoy_pct_change")} for r in rows], "cagr_5yr": rows[-1]["cagr_5yr"], "trend": label}

    @tool
    def get_sector_summary(self, sector: str, fiscal_year: int | None = None, metric: str | None = None) -> dict:
        """Members of a sector and mean, upper median, leader and laggard of its main figures."""
        f = self.table("company_financials").where((F.col("sector") == sector) & (F.col("fiscal_period") == "FY"))
        year = fiscal_year or f.agg(F.max("fiscal_year")).first()[0]
        if year is None:
            raise NotFound(f"no sector {sector!r}")
        wanted = [self.resolve(m) for m in ([metric] if metric else ["Revenue", "Net Income", "Net Margin"])]
        out = []
        for mid, name, source in wanted:
            key, val = ("business_term_id", "val") if source == "company_financials" else ("ratio_id", "ratio_value")
            g = self.table(source).where((F.col("sector") == sector) & (F.col("fiscal_period") == "FY") & (F.col("fiscal_year") == year) & (F.col(key) == mid) & F.col(val).isNotNull()).groupBy("cik").agg(F.max("ticker").alias("ticker"), F.max(val).alias("v"))
            s = g.agg(F.avg("v").alias("mean"), X.median_upper("v").alias("median"), F.min_by("ticker", F.struct(-F.col("v"), "ticker")).alias("leader"), F.min_by("ticker", F.struct(F.col("v"), F.col("ticker"))).alias("laggard"), F.count("v").alias("n")).first()
            if s["n"]:
                out.append({"metric": name, **s.asDict()})
        members = [r[0] for r in f.where(F.col("fiscal_year") == year).select("ticker").distinct().orderBy("ticker").collect()]
        return {"sector": sector, "fiscal_year": year, "companies": members, "metrics": out}

    @tool
    def get_ratio(self, ticker: str, ratio: str, fiscal_year: int | None = None) -> dict:
        """A ratio with its components, rank among peers and change against the year before."""
        rid, _, _ = self.resolve(ratio, "financial_ratios")
        r = self.table("financial_ratios").where((F.upper("ticker") == ticker.upper()) & (F.col("ratio_id") == rid) & (F.col("fiscal_period") == "FY"))
        before = r.groupBy((F.col("fiscal_year") + 1).alias("fiscal_year")).agg(F.max("ratio_value").alias("prior_value"))
        now = r if fiscal_year is None else r.where(F.col("fiscal_year") == fiscal_year)
        top = now.orderBy(F.col("fiscal_year").desc(), "record_id").limit(1)
        peers = self._peers("financial_ratios").withColumnRenamed("metric_id", "ratio_id")
        j = top.join(before, "fiscal_year", "left").join(peers, ["cik", "fiscal_year", "fiscal_period", "ratio_id"], "left").withColumn("yoy_change", F.col("ratio_value") - F.col("prior_value"))
        return self._one(j, ["cik"], f"{ticker} {ratio}")

    @tool
    def get_amendment_summary(self, ticker: str, fiscal_year: int | None = None) -> dict:
        """Amendment statistics of a company for a year or the latest."""
        ciks = self.table("company_financials").where(F.upper("ticker") == ticker.upper()).select("cik").distinct()
        a = self.table("amendment_analysis").join(ciks, "cik", "left_semi")
        a = a if fiscal_year is None else a.where(F.col("fiscal_year") == fiscal_year)
        return self._one(a, [F.col("fiscal_year").desc()], ticker)

    def registry(self) -> dict:
        """Every tool by name, from one list."""
        return {n: getattr(self, n) for n in dir(type(self)) if getattr(getattr(type(self), n), "is_tool", False)}


def schemas() -> list[dict]:
    """JSON schemas of the tools, from their signatures."""
    import inspect

    kinds = {"str": "string", "int": "integer", "list[str]": "array"}
    out = []
    for n in sorted(dir(Tools)):
        f = getattr(Tools, n)
        if getattr(f, "is_tool", False):
            params = [p for p in inspect.signature(f).parameters.values() if p.name != "self"]
            props = {p.name: {"type": kinds[str(p.annotation).split(" | ")[0]]} for p in params}
            out.append({"name": n, "description": f.__doc__, "input_schema": {"type": "object", "properties": props, "required": [p.name for p in params if p.default is p.empty]}})
    return out
