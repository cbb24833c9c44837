"""Entity storage as tables: filters, relations, versions and expiry.

Every function takes and returns DataFrames; nothing is changed in place. An
entity table has (study_id, sid, entity_type, version, ...), an edge table
(from_id, rel_type, to_id).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.keys import is_blank


def query_entities(df: DataFrame, entity_type: str | None = None, **filters) -> DataFrame:
    """Entities of one type whose columns equal the given values; a null never equals."""
    tests = [F.col("entity_type") == entity_type] if entity_type is not None else []
    tests += [F.col(k) == F.lit(v) for k, v in filters.items()]
    return df.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def optional_filters(df: DataFrame, *tests: Column | None) -> DataFrame:
    """All tests that are given hold; those that are None are left out."""
    return df.where(reduce(lambda a, b: a & b, [t for t in tests if t is not None], F.lit(True)))


def by_types(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Entities of the included types, then without the excluded ones; null types fall with either list."""
    return optional_filters(df, F.col("entity_type").isin(include) if include else None, ~F.col("entity_type").isin(exclude) if exclude else None)


def enrichable(df: DataFrame, types: list[str]) -> DataFrame:
    """Entities of the given types with a name that isn't blank."""
    return df.where(F.col("entity_type").isin(types) & ~is_blank("name"))


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values of each column: (facet, value)."""
    parts = [F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*parts)).alias("x")).select("x.*").where("value IS NOT NULL").distinct()


def edges_of(df: DataFrame, key: Column, field: Column, rel_type: str) -> DataFrame:
    """Edges from each key to each member of an array: (from_id, rel_type, to_id), distinct, non-null."""
    return df.select(key.alias("from_id"), F.lit(rel_type).alias("rel_type"), F.explode(field).alias("to_id")).where("from_id IS NOT NULL AND to_id IS NOT NULL").distinct()


def valid_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct edges whose both ends are in ``nodes`` (id)."""
    ids = nodes.select("id").distinct()
    return (
        edges.distinct()
        .join(ids.withColumnRenamed("id", "from_id"), "from_id", "left_semi")
        .join(ids.withColumnRenamed("id", "to_id"), "to_id", "left_semi")
        .select("from_id", "rel_type", "to_id")
    )


def related(edges: DataFrame, nodes: DataFrame, rel_type: str | None = None) -> DataFrame:
    """One hop along the edges, targets that don't exist dropped: (from_id, rel_type, *nodes)."""
    some = edges if rel_type is None else edges.where(F.col("rel_type") == rel_type)
    return some.join(nodes, some.to_id == nodes.id).drop("to_id")


def delete_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without the given ids and without edges from or to them."""
    ids = gone.select("id").distinct()
    rest = edges.join(ids.withColumnRenamed("id", "from_id"), "from_id", "left_anti").join(ids.withColumnRenamed("id", "to_id"), "to_id", "left_anti")
    return nodes.join(ids, "id", "left_anti"), rest.select("from_id", "rel_type", "to_id")


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Rows after the changes: (*keys, *fields, version).

    A changed field that isn't null replaces the old value, the version grows by
    one, new keys start at version 1. Both sides have at most one row a key.
    """
    new = changes.select(*keys, *[F.col(f).alias(f"new_{f}") for f in fields], F.lit(1).alias("hit"))
    joined = current.select(*keys, *fields, "version").join(new, keys, "full_outer")
    return joined.select(
        *keys,
        *[F.coalesce(F.col(f"new_{f}"), F.col(f)).alias(f) for f in fields],
        (F.coalesce("version", F.lit(0)) + F.coalesce("hit", F.lit(0))).alias("version"),
    )


def insert_new(current: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows with keys not stored yet, the first of each by ``order``; the rest."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    known = current.select(*keys).distinct().withColumn("known", F.lit(True))
    marked = rows.withColumn("rank", first).join(known, keys, "left").withColumn("ok", F.col("known").isNull() & (F.col("rank") == 1))
    return marked.where("ok").drop("rank", "known", "ok"), marked.where("NOT ok").drop("rank", "known", "ok")


def newest(df: DataFrame, keep: int, order: list[Column], per: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, deleted): the first ``keep`` rows by ``order`` in each group, and the rest."""
    rank = F.row_number().over(Window.partitionBy(*(per or [])).orderBy(*order))
    ranked = df.withColumn("rank", rank)
    return ranked.where(F.col("rank") <= keep).drop("rank"), ranked.where(F.col("rank") > keep).drop("rank")


def fresh(df: DataFrame, now: Column, created: Column, ttl_seconds: Column) -> DataFrame:
    """Entries that haven't expired; a null time to live never does."""
    age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(created.cast("timestamp"))
    return df.where(ttl_seconds.isNull() | (age < ttl_seconds))


def cache_key(*parts: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of the parts in order."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 16)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a snapshot to a path of its own and read it back; the table before stays as it was."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
