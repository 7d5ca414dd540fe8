"""From raw facts to the consumable tables: one lazy plan a table, written as versions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.operators import derived, entities, facts
from tallystone.operators.governance import Lineage
from tallystone.operators.rules import Rule, gate, run
from tallystone.sources.store import VersionedTable, promote

KEYS = {
    "base.entity_mappings": ["cik"], "base.entity_resolution_audit": ["audit_id"], "base.concept_mappings": ["concept"], "base.tag_normalization_audit": ["audit_id"], "base.financial_facts": ["fact_id"], "base.fiscal_calendar": ["calendar_id"], "base.amendment_tracking": ["cik", "concept", "unit", "end_date", "original_accession", "amendment_accession"], "base.conformed_facts": ["conformed_id"],
    "consumable.company_financials": ["record_id"], "consumable.financial_ratios": ["record_id"], "consumable.period_over_period": ["record_id"], "consumable.peer_comparison": ["record_id"], "consumable.amendment_analysis": ["record_id"],
}
_PERIOD = ["cik", "fiscal_year", "fiscal_period"]
_FIN, _RAT = "consumable.company_financials", "consumable.financial_ratios"


def _who(fin: DataFrame) -> DataFrame:
    return fin.groupBy("cik").agg(F.max("ticker").alias("ticker"), F.max("canonical_name").alias("canonical_name"), F.max("sector").alias("sector"))


def _ratios(t: dict[str, DataFrame]) -> DataFrame:
    return derived.with_reporting(derived.ratios(t[_FIN]), ["ratio_id", "fiscal_period"]).join(_who(t[_FIN]), "cik", "left")


def _growth(t: dict[str, DataFrame]) -> DataFrame:
    g = derived.growth(t[_FIN]).withColumnRenamed("base_year", "base_fiscal_year")
    return derived.with_reporting(g, ["growth_type", "business_term_id", "fiscal_period"]).withColumn("record_id", X.grain_hash("cik", "business_term_id", "fiscal_year", "fiscal_period", "growth_type"))


def _peers(t: dict[str, DataFrame]) -> DataFrame:
    a = t[_FIN].select(*_PERIOD, "sector", F.col("business_term_id").alias("metric_id"), F.col("val").alias("metric_value"), F.lit("company_financials").alias("metric_source"))
    b = t[_RAT].select(*_PERIOD, "sector", F.col("ratio_id").alias("metric_id"), F.col("ratio_value").alias("metric_value"), F.lit("financial_ratios").alias("metric_source"))
    p = derived.peers(a.unionByName(b), ["sector", "metric_id", "fiscal_year", "fiscal_period", "metric_source"], value="metric_value")
    return p.withColumn("record_id", X.grain_hash("cik", "metric_id", "fiscal_year", "fiscal_period", "metric_source"))


def steps(raw: DataFrame, entity_rows: DataFrame | None, terms: DataFrame, now: str) -> dict[str, Callable[[dict[str, DataFrame]], DataFrame]]:
    """Each table as a function of the tables before it. entity_rows: known entities (ticker, sic_code, fiscal_year_end);
    None takes what the raw rows say."""
    none = F.lit(None).cast("string")

    def entity(_: dict[str, DataFrame]) -> DataFrame:
        if entity_rows is not None:
            return entity_rows
        return entities.resolve(raw).withColumns({"ticker": none, "fiscal_year_end": none, "sic_code": none, "status": F.lit("approved"), "approved_by": F.lit("auto"), "approved_at": F.lit(now).cast("timestamp")})

    def concept(_: dict[str, DataFrame]) -> DataFrame:
        c = entities.normalize(raw).join(terms.select("business_term_id", "business_term"), "business_term_id", "left")
        return c.withColumn("status", F.when(F.col("business_term_id").isNotNull(), "approved").otherwise("unmapped"))

    return {
        "base.entity_mappings": entity,
        "base.entity_resolution_audit": lambda t: entities.audit(t["base.entity_mappings"], "mapping_id", "promoted", "tallystone", now),
        "base.concept_mappings": concept,
        "base.tag_normalization_audit": lambda t: entities.audit(t["base.concept_mappings"], "concept", "promoted", "tallystone", now),
        "base.financial_facts": lambda t: facts.model(raw.drop("load_date"), t["base.entity_mappings"], t["base.concept_mappings"]),
        "base.fiscal_calendar": lambda t: facts.fiscal_calendar(t["base.financial_facts"]),
        "base.amendment_tracking": lambda t: facts.amendments(t["base.financial_facts"]),
        "base.conformed_facts": lambda t: facts.conform(t["base.financial_facts"]),
        _FIN: lambda t: derived.financials(t["base.conformed_facts"], t["base.entity_mappings"]),
        _RAT: _ratios,
        "consumable.period_over_period": _growth,
        "consumable.peer_comparison": _peers,
        "consumable.amendment_analysis": lambda t: derived.amendment_stats(t["base.amendment_tracking"]).join(_who(t[_FIN]), "cik").withColumn("record_id", X.grain_hash("cik", "fiscal_year")),
    }


def _stamped(df: DataFrame, now: str) -> DataFrame:
    """The clock comes in as text, so a build can be repeated."""
    return df if "load_date" in df.columns else df.withColumns({"promoted_at": F.lit(now).cast("timestamp"), "load_date": F.lit(now[:10]).cast("date")})


def frames(raw: DataFrame, entity_rows: DataFrame | None, terms: DataFrame, now: str) -> dict[str, DataFrame]:
    """All derived tables by name, lazy: nothing is written or computed."""
    out: dict[str, DataFrame] = {}
    for name, make in steps(raw, entity_rows, terms, now).items():
        out[name] = _stamped(make(out), now)
    return out


def build(spark: SparkSession, root: str, raw: DataFrame, entity_rows: DataFrame | None, terms: DataFrame, now: str, rules: list[Rule] | None = None) -> dict[str, dict]:
    """Write all tables as new versions, each from the written tables before it, check the P0 rules on what is there where
    rules are given, and record lineage."""
    lineage = Lineage(spark, VersionedTable(spark, root, "governance.lineage_events"))
    done: dict[str, dict] = {}
    written: dict[str, DataFrame] = {}
    order = steps(raw, entity_rows, terms, now)
    for name, make in order.items():

        def check(df: DataFrame, name=name) -> bool:
            df.createOrReplaceTempView(name.replace(".", "_"))
            mine = []
            for r in rules or []:
                used = [x for x in order if f"{x} " in f"{r.sql} "]
                if name in used and all(x == name or x in done for x in used):
                    sql = r.sql
                    for x in used:
                        sql = sql.replace(x, x.replace(".", "_"))
                    mine.append(replace(r, sql=sql))
            return gate(run(spark, mine, priority="P0"), allow_empty=True)

        t = VersionedTable(spark, root, name)
        done[name] = promote(t, _stamped(make(written), now), KEYS[name], "overwrite", lineage, check=check if rules else None)
        written[name] = t.read()
        written[name].createOrReplaceTempView(name.replace(".", "_"))
    lineage.flush()
    return done
