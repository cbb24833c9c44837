"""Where entities and cells come from, and how sure they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.mappings import SOURCE_TYPE

#: Weight of a source type in per cent, extra per further agent and its most, in 1/10000.
WEIGHT_PERCENT = {"both": 100, "vision": 85, "text": 80, "derived": 70}
OTHER_WEIGHT_PERCENT = 75
EXTRA_PER_AGENT, MOST_EXTRA = 200, 1000
LOW_CONFIDENCE = 0.5


def source_type(agent: Column | str) -> Column:
    return SOURCE_TYPE.column(agent)


def aggregate_confidence_bp(confidence: Column, kind: Column, agents: Column) -> Column:
    """Confidence weighted by source type and raised for further agents, in 1/10000, within 0 and 10000.

    Whole numbers all the way, so that engines round alike. Null stays null.
    """
    weight = F.lit(OTHER_WEIGHT_PERCENT)
    for k, w in WEIGHT_PERCENT.items():
        weight = F.when(kind == k, w).otherwise(weight)
    base = F.floor(F.floor(confidence * 10000 + 0.5) * weight / 100)
    extra = F.least(F.lit(MOST_EXTRA), EXTRA_PER_AGENT * (agents - 1))
    bounded = F.greatest(F.lit(0), F.least(F.lit(10000), base + F.when(agents > 1, extra).otherwise(0)))
    return F.when(confidence.isNotNull(), bounded).cast("bigint")


def summary(df: DataFrame, by: list[str]) -> DataFrame:
    """Counts and confidence per group: (*by, entities, with_confidence, low, min_bp, max_bp, sum_bp).

    ``df`` has (confidence, source_agent); a null confidence counts as an entity
    only. Partial aggregates before the shuffle, whatever the skew of the groups.
    """
    bp = F.floor(F.col("confidence") * 10000 + 0.5).cast("bigint")
    return df.groupBy(*by).agg(
        F.count("*").alias("entities"), F.count("confidence").alias("with_confidence"),
        F.count_if(F.col("confidence") < LOW_CONFIDENCE).alias("low"), F.min(bp).alias("min_bp"), F.max(bp).alias("max_bp"), F.sum(bp).alias("sum_bp"),
    )


def contributing_agents(own: DataFrame, related: DataFrame) -> DataFrame:
    """Agents of an entity and of what it is related to, sorted: (id, agents). Both sides have (id, agent)."""
    return own.select("id", "agent").unionByName(related.select("id", "agent")).where("agent IS NOT NULL").groupBy("id").agg(F.array_sort(F.collect_set("agent")).alias("agents"))


def tag_sources(df: DataFrame, keys: list[str]) -> DataFrame:
    """One tag per key: its source, or ``both`` when there are several; null sources don't count."""
    least, most = F.min("source"), F.max("source")
    return df.groupBy(*keys).agg(F.when(least == most, least).when(least.isNotNull(), "both").alias("source"))


def source_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by key and source, with totals by key and in all (nulls mark the totals)."""
    return df.rollup(*keys, "source").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def source_counts(df: DataFrame, by: list[str], sources: list[str]) -> DataFrame:
    """One column of counts for each of a fixed list of sources, and one for all others."""
    known = [F.count_if(F.col("source") == s).alias(s) for s in sources]
    return df.groupBy(*by).agg(*known, F.count_if(~F.coalesce(F.col("source").isin(sources), F.lit(False))).alias("other"))


def confidence_bins(df: DataFrame, by: list[str], bins: int = 5) -> DataFrame:
    """Histogram of confidence in equal bins, 1.0 in the last: (*by, bin, n); nulls are left out."""
    b = F.least(F.lit(bins - 1), F.floor(F.col("confidence") * bins)).cast("int")
    return df.where("confidence IS NOT NULL").groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"))


def page_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Entities and confidence per page, an entity once a page: (*keys, page, entities, max_bp, sum_bp)."""
    bp = F.floor(F.col("confidence") * 10000 + 0.5).cast("bigint")
    per = df.select(*keys, "entity_no", bp.alias("bp"), F.explode(F.array_distinct("source_pages")).alias("page")).groupBy(*keys, "page", "entity_no").agg(F.max("bp").alias("bp"))
    return per.groupBy(*keys, "page").agg(F.count("*").alias("entities"), F.max("bp").alias("max_bp"), F.sum("bp").alias("sum_bp"))
