"""Entity resolution, concept classification and the review gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystone.functions import exprs as X
from tallystone.plans import values as V


def resolve(raw: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The most common name of each company (ties: the least), in title case unless known. Confidence 1.0 for known
    companies, else 0.5. The table of distinct names, not the facts, is ranked; ids count up by cik."""
    names = raw.where(F.col("cik").isNotNull()).groupBy("cik", F.col("entity_name").alias("raw_entity_name")).agg(F.count(F.lit(1)).alias("n"))
    modal = names.groupBy("cik").agg(F.min_by("raw_entity_name", F.struct(-F.col("n"), F.col("raw_entity_name"))).alias("raw_entity_name"), F.sum("n").alias("n_facts"))
    k = known.select("cik", F.col("canonical_name").alias("_known")) if known is not None else modal.select("cik", F.lit(None).cast("string").alias("_known")).limit(0)
    out = modal.join(k, "cik", "left")
    w = W.orderBy("cik")  # one row a company
    return out.select(F.format_string("ER-%03d", F.row_number().over(w)).alias("mapping_id"), "cik", "raw_entity_name", F.coalesce("_known", X.title_name(F.col("raw_entity_name"))).alias("canonical_name"), F.when(F.col("_known").isNotNull(), 1.0).otherwise(0.5).alias("confidence"), F.when(F.col("_known").isNotNull(), "known").otherwise("modal_name").alias("resolution_method"), "n_facts")


def concept_stats(raw: DataFrame, taxonomy: str = "us-gaap") -> DataFrame:
    return raw.where(F.col("taxonomy") == taxonomy).groupBy("concept").agg(F.count(F.lit(1)).alias("fact_count"), F.countDistinct("cik").alias("company_count"))


def classify(concept: Column) -> Column:
    """struct(business_term_id, financial_statement, category, tier, confidence, method): exact, then prefix, then pattern,
    then by part of the name."""
    kinds = [("exact", V.EXACT, 1, 1.0, lambda c, p: c == p), ("prefix", V.PREFIXES, 2, 0.7, lambda c, p: c.startswith(p)), ("pattern", V.PATTERNS, 2, 0.6, lambda c, p: c.rlike("^(?:" + p + ")"))]
    options = []
    for method, rules, tier, sure, test in kinds:
        m = X.first_match(concept, rules, test)
        options.append(F.when(m.isNotNull(), F.struct(m["p0"].alias("business_term_id"), m["p1"].alias("financial_statement"), m["p2"].alias("category"), F.lit(tier).alias("tier"), F.lit(sure).alias("confidence"), F.lit(method).alias("method"))))
    h = X.first_match(concept, V.HEURISTICS, lambda c, p: c.contains(p))
    rest = F.struct(F.lit(None).cast("string").alias("business_term_id"), F.coalesce(h["p0"], F.lit("other")).alias("financial_statement"), F.coalesce(h["p1"], F.lit("uncategorized")).alias("category"), F.lit(3).alias("tier"), F.lit(0.0).alias("confidence"), F.lit("heuristic").alias("method"))
    return F.coalesce(*options, rest)


def normalize(raw: DataFrame, taxonomy: str = "us-gaap") -> DataFrame:
    """One row a concept with its classification and counts. Rules run over distinct concepts, not over facts."""
    s = concept_stats(raw, taxonomy)
    return s.withColumn("c", classify(F.col("concept"))).select("concept", "c.*", "fact_count", "company_count")


def coverage(mappings: DataFrame) -> DataFrame:
    """Concepts by tier, share mapped, and share of facts mapped, in percent to one digit (half-even)."""
    mapped = F.col("tier").isin(1, 2)
    return mappings.agg(*[F.coalesce(F.sum(F.when(F.col("tier") == t, 1).otherwise(0)), F.lit(0)).alias(f"tier{t}") for t in (1, 2, 3)], F.bround(F.try_divide(100.0 * F.sum(F.when(mapped, 1).otherwise(0)), F.count(F.lit(1))), 1).alias("concept_pct"), F.bround(F.try_divide(100.0 * F.sum(F.when(mapped, F.col("fact_count")).otherwise(0)), F.sum("fact_count")), 1).alias("fact_pct"))


def gate(proposals: DataFrame, require_human: bool = True, floor: float = 0.8) -> DataFrame:
    """decision: review below the floor, or always where a human is required; else auto."""
    return proposals.withColumn("decision", F.when((F.col("confidence") < floor) | F.lit(require_human), "review").otherwise("auto"))


def decide(proposals: DataFrame, status: str, who: str, ids: list[str] | None = None, reason: str | None = None, ident: str = "mapping_id") -> DataFrame:
    """approved or rejected: only pending rows change, optionally only those of a list of ids."""
    hit = F.col("status") == "pending"
    if ids is not None:
        hit = hit & F.col(ident).isin(ids)
    return proposals.withColumns({"decided_by": F.when(hit, F.lit(who)).otherwise(F.col("decided_by") if "decided_by" in proposals.columns else F.lit(None).cast("string")), "reason": F.when(hit, F.lit(reason)).otherwise(F.col("reason") if "reason" in proposals.columns else F.lit(None).cast("string")), "status": F.when(hit, status).otherwise(F.col("status"))})


def promotable(proposals: DataFrame, stored: DataFrame, key: str = "cik", ready: tuple[str, ...] = ("approved",), stored_status: str | None = "approved") -> DataFrame:
    """Proposals that may be promoted: of a status that is ready, and of a key that isn't stored (with stored_status, if one
    is given). A null key is never stored."""
    known = stored if stored_status is None else stored.where(F.col("status") == stored_status)
    return proposals.where(F.col("status").isin(*ready)).join(known.select(key).distinct(), key, "left_anti")


def audit(rows: DataFrame, key: str, action: str, who: str, when: str) -> DataFrame:
    """One audit row for each row: audit_id (a hash of key, action and time), the key, action, who, when, and the evidence
    as JSON."""
    names = [c for c in ("raw_entity_name", "confidence", "resolution_method", "method", "tier", "fact_count") if c in rows.columns]
    evidence = F.to_json(F.struct(*[F.col(c) for c in names])) if names else F.lit("{}")
    return rows.select(X.grain_hash(F.col(key), F.lit(action), F.lit(when)).alias("audit_id"), key, F.lit(action).alias("action"), F.lit(who).alias("performed_by"), F.lit(when).cast("timestamp").alias("performed_at"), evidence.alias("evidence"), F.lit(when[:10]).cast("date").alias("load_date"))
