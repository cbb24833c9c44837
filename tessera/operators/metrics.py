"""Counts, shares and scores over result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, scale: int = 100) -> Column:
    """part of whole in per cent times ``scale`` / 100, as a whole number rounded half up; 0 for an empty whole."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0)).otherwise(F.floor((part * scale * 2 + whole) / (whole * 2))).cast("bigint")


def percent_label(test: Column, golden: Column) -> Column:
    """A percentage as text; without a golden count ``N/A`` or ``Extra``."""
    return F.when(golden == 0, F.when(test == 0, "N/A").otherwise("Extra")).otherwise(F.concat(percent(test, golden).cast("string"), F.lit("%")))


def completeness(fields: list[Column], quality: Column) -> Column:
    """Confidence out of the share of fields that are there (0.6) and a quality flag (0.4), in 1/10000."""
    there = reduce(lambda a, b: a + b, [F.when(F.coalesce(f.cast("string"), F.lit("")) != "", 1).otherwise(0) for f in fields])
    return (F.floor(there * 6000 / len(fields)) + F.when(quality, 4000).otherwise(0)).cast("bigint")


def by_each(df: DataFrame, columns: list[str], **measures: Column) -> DataFrame:
    """One grouping per column in a single pass: (dimension, value, measures)."""
    parts = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select("*", F.explode(parts).alias("__x")).groupBy(F.col("__x.dimension").alias("dimension"), F.col("__x.value").alias("value")).agg(*[m.alias(n) for n, m in measures.items()])


def precision_recall(matches: DataFrame, by: list[str]) -> DataFrame:
    """(*by, golden, extracted, matched, precision_bp, recall_bp, f1_bp) from one row per golden and per unmatched extracted entity.

    ``matches`` has (golden_id, extracted_id), null where a side is missing.
    Without golden entities recall is whole, without extracted ones precision
    is zero.
    """
    t = matches.groupBy(*by).agg(
        F.count("golden_id").alias("golden"), F.count("extracted_id").alias("extracted"),
        F.count_if(F.col("golden_id").isNotNull() & F.col("extracted_id").isNotNull()).alias("matched"),
    )
    p = F.when(F.col("extracted") == 0, 0).otherwise(percent(F.col("matched"), F.col("extracted"), 10000))
    r = F.when(F.col("golden") == 0, 10000).otherwise(percent(F.col("matched"), F.col("golden"), 10000))
    f = F.when(F.col("matched") == 0, F.when(F.col("golden") + F.col("extracted") == 0, 0).otherwise(0)).otherwise(percent(2 * F.col("matched"), F.col("golden") + F.col("extracted"), 10000))
    return t.select(*by, "golden", "extracted", "matched", p.cast("bigint").alias("precision_bp"), r.cast("bigint").alias("recall_bp"), f.cast("bigint").alias("f1_bp"))


def overlap_score(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets in 1/10000; two empty ones are alike."""
    x, y = F.array_distinct(F.coalesce(a, F.array().cast("array<string>"))), F.array_distinct(F.coalesce(b, F.array().cast("array<string>")))
    whole = F.size(F.array_union(x, y))
    return F.when(whole == 0, 10000).otherwise(percent(F.size(F.array_intersect(x, y)), whole, 10000)).cast("bigint")


def count_score(expected: Column, actual: Column) -> Column:
    """Closeness of a count to the expected one in 1/10000: 1 - |e - a| / e, at least 0; nothing expected and nothing there is whole."""
    return (
        F.when(expected == 0, F.when(actual == 0, 10000).otherwise(0)).otherwise(F.greatest(F.lit(0), percent(expected - F.abs(expected - actual), expected, 10000)))
    ).cast("bigint")


def last_value_by(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """A gauge: the latest value of each key."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def rank_first(df: DataFrame, per: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group; window group limits cut each map task's output to ``n`` a group."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).where(F.col("__rank") <= n).drop("__rank")
