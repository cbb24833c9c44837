"""The engine's contracts over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import same_id
from tessera.plans.runtime import table

ENTITY_TABLES = ("narrative", "objectives", "soa_vision", "interventions", "advanced_entities")
ENTITY_COLUMNS = (
    "table_name", "entity_no", "study_id", "pos", "id", "sid", "entity_type", "name", "source_agent", "confidence", "source_pages",
    "model", "version", "parent_id", "is_deleted", "created_at", "updated_at",
)


def names(spark, d) -> DataFrame:
    """Distinct non-null names of several tables: (name)."""
    parts = [table(spark, d, t).select(c.alias("name")) for t, c in (("soa_vision", F.col("data.name")), ("interventions", F.col("data.name")), ("objectives", F.col("data.name")), ("enrichment", F.col("entity_name")))]
    return reduce(DataFrame.unionByName, parts).where("name IS NOT NULL").distinct()


def entities(spark, d, tables=ENTITY_TABLES) -> DataFrame:
    """Stored entity rows of the tables with their common columns."""
    parts = []
    for t in tables:
        df = table(spark, d, t)
        name = F.try_variant_get(F.try_parse_json("data"), "$.name", "string") if t == "advanced_entities" else F.col("data.name")
        df = df.withColumns({"table_name": F.lit(t), "sid": same_id("id"), "name": name})
        parts.append(df.select(*ENTITY_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def live(spark, d, tables=ENTITY_TABLES) -> DataFrame:
    """Live entities: the row with the highest version of each key, unless deleted."""
    rows = entities(spark, d, tables)
    rest = [c for c in ENTITY_COLUMNS if c not in ("table_name", "study_id", "sid", "version", "is_deleted")]
    head = F.struct("version", "is_deleted", *rest)
    return (
        rows.groupBy("table_name", "study_id", "sid")
        .agg(F.max(head).alias("h"))
        .where("NOT h.is_deleted")
        .select("table_name", "study_id", "sid", "h.version", "h.is_deleted", *[f"h.{c}" for c in rest])
    )
