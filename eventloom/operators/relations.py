"""Relations between entities: resolving names, orientation, strength, evidence, and a keyed load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import tri_state
from . import upsert


def direction(x: Column) -> Column:
    """directed, or undirected for anything else."""
    return F.when(F.lower(F.trim(F.coalesce(x, F.lit("")))) == "directed", "directed").otherwise("undirected")


def strength(x: Column) -> Column:
    """A number between 0 and 1 with four digits; 0.5 for blanks and what is no number."""
    n = F.trim(F.coalesce(x, F.lit(""))).try_cast("double")
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(n, F.lit(0.5)))), 4)


def resolved(rows: DataFrame, entities: DataFrame, code: str, name: str, out: str) -> DataFrame:
    """``rows`` with a struct ``out`` (id, code, name) of the entity with the code, else of that with the name, else null."""
    by_code = entities.groupBy(F.col("code").alias("_c")).agg(F.min(F.struct("id", "code", "name")).alias("_e1"))
    by_name = entities.groupBy(F.col("name").alias("_n")).agg(F.min(F.struct("id", "code", "name")).alias("_e2"))
    key, text = F.upper(F.trim(F.coalesce(code, F.lit("")))), F.trim(F.coalesce(name, F.lit("")))
    joined = rows.withColumns({"_k": key, "_t": text}).join(by_code, (F.col("_k") == F.col("_c")) & (F.col("_k") != ""), "left").join(by_name, (F.col("_t") == F.col("_n")) & (F.col("_t") != ""), "left")
    return joined.withColumn(out, F.coalesce("_e1", "_e2")).select(*rows.columns, out)


def evidence(source: Column, target: Column, have: list[str]) -> Column:
    """JSON of what speaks for a relation; blanks and flags that say nothing are left out."""
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in have else F.lit(None).cast("string")
    flag = lambda c: tri_state(F.col(c)) if c in have else F.lit(None).cast("boolean")
    return F.to_json(
        F.struct(
            F.coalesce(F.col("evidence_note") if "evidence_note" in have else F.lit(""), F.lit("")).alias("evidence_note"), source["code"].alias("source_ts_code"), target["code"].alias("target_ts_code"), source["name"].alias("source_company_name"), target["name"].alias("target_company_name"),
            F.coalesce(text("data_source"), text("source")).alias("data_source"), *[text(c).alias(c) for c in ("confidence", "effective_date", "expiry_date", "relation_group")], *[flag(c).alias(c) for c in ("same_controller_flag", "same_industry_flag", "same_concept_flag")],
        )
    )


def prepared(seed: DataFrame, entities: DataFrame, order: str) -> DataFrame:
    """(source, target, relation_type, strength, direction, evidence) of a seed; undirected ones have the smaller id first, the last row of a key wins."""
    typed = seed.filter(F.trim(F.coalesce("relation_type", F.lit(""))) != "")
    both = resolved(resolved(typed, entities, "source_ts_code", "source_company_name", "_s"), entities, "target_ts_code", "target_company_name", "_t").filter("_s IS NOT NULL AND _t IS NOT NULL")
    both = both.withColumn("_d", direction(F.col("direction") if "direction" in seed.columns else F.lit("")))
    turned = (F.col("_d") == "undirected") & (F.col("_s.id") > F.col("_t.id"))
    first, second = F.when(turned, F.col("_t")).otherwise(F.col("_s")), F.when(turned, F.col("_s")).otherwise(F.col("_t"))
    both = both.withColumns({"_a": first, "_b": second})
    rows = both.select(F.col("_a.id").alias("source"), F.col("_b.id").alias("target"), F.trim("relation_type").alias("relation_type"), strength(F.col("relation_strength")).alias("strength"), F.col("_d").alias("direction"), evidence(F.col("_a"), F.col("_b"), seed.columns).alias("evidence"), F.col(order).alias("_order"))
    return upsert.last_wins(rows, ["source", "target", "relation_type"], "_order").drop("_order")


def loaded(old: DataFrame, seed: DataFrame, entities: DataFrame, order: str) -> DataFrame:
    """Stored relations after a load: manual ones go, the seed's take their keys."""
    new = prepared(seed, entities, order).withColumn("is_manual", F.lit(True))
    return upsert.upserted(old.filter("NOT is_manual"), new.select(*old.columns), ["source", "target", "relation_type"])
