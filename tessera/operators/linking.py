"""Linking records to one another: tiers of keys, containment, id maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 3


def tiered_match(left: DataFrame, right: DataFrame, on: list[str], tiers: list[tuple[Column, Column]], order: str, target: str) -> DataFrame:
    """Each left row with the target of the first tier that has one: the left columns, match_id and tier (from 1).

    A tier is a pair of key expressions, for the left and for the right side;
    null keys never match. Within a tier the right row with the smallest
    ``order`` counts. Each tier is an equi-join with one row a key, so a left
    row stays one row. ``left`` needs no key of its own.
    """
    out = left
    hits = []
    for i, (lk, rk) in enumerate(tiers):
        side = right.select(*on, rk.alias(f"__k{i}"), target, order).where(F.col(f"__k{i}").isNotNull())
        one = side.groupBy(*on, f"__k{i}").agg(F.min_by(target, order).alias(f"__m{i}"))
        out = out.withColumn(f"__k{i}", lk).join(one, [*on, f"__k{i}"], "left")
        hits.append(f"__m{i}")
    tier = reduce(lambda w, im: w.when(F.col(im[1]).isNotNull(), im[0] + 1), enumerate(hits), F.when(F.lit(False), 0))
    return out.select(*left.columns, F.coalesce(*hits).alias("match_id"), tier.alias("tier"))


def containing(left: DataFrame, right: DataFrame, on: list[str], text: str, key: str) -> DataFrame:
    """Pairs of which the left text contains the right key: (*on, text, key), distinct.

    Keys of at least three characters only. A key's first three characters are
    looked up among all runs of three of the distinct texts, then the whole key
    is tested; no pair is laid out that doesn't share those three.
    """
    texts, keys = left.select(*on, text).distinct(), right.select(*on, key).where(F.length(key) >= GRAM).distinct()
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.substring(F.col(text), i, GRAM)))
    runs = texts.where(F.length(text) >= GRAM).withColumn("__g", F.explode(grams))
    heads = keys.withColumn("__g", F.substring(key, 1, GRAM))
    return runs.join(heads, [*on, "__g"]).where(F.col(text).contains(F.col(key))).select(*on, text, key)


def containing_any(left: DataFrame, right: DataFrame, on: list[str], text: str, key: str) -> DataFrame:
    """Like ``containing`` for keys of any length; an empty key is inside every text.

    Keys below three characters are whole runs themselves, so they meet equal
    runs of that length and need no further test.
    """
    texts = left.select(*on, text).where(F.col(text).isNotNull()).distinct()
    short = right.select(*on, key).where(F.length(key) < GRAM).distinct()
    ones = F.split(F.col(text), "")
    twos = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - 1)), lambda i: F.substring(F.col(text), i, 2))
    runs = texts.withColumn(key, F.explode(F.array_distinct(F.concat(F.array(F.lit("")), ones, twos))))
    return containing(left, right, on, text, key).unionByName(runs.join(short, [*on, key]).select(*on, text, key))


def id_map(ids: DataFrame, column: str, scope: list[str]) -> DataFrame:
    """Each id with a stable 32-digit name made of it: (*scope, column, new_id)."""
    return ids.select(*scope, column).distinct().where(F.col(column).isNotNull()).withColumn("new_id", F.md5(F.concat_ws("/", *scope, column)))


def remap(df: DataFrame, mapping: DataFrame, scope: list[str], columns: list[str]) -> DataFrame:
    """The columns with their ids replaced by ``mapping`` (*scope, id, new_id); unknown ids stay."""
    for c in columns:
        m = mapping.select(*scope, F.col("id").alias(c), F.col("new_id").alias("__new"))
        df = df.join(m, [*scope, c], "left").withColumn(c, F.coalesce("__new", c)).drop("__new")
    return df


def remap_array(df: DataFrame, mapping: DataFrame, scope: list[str], keys: list[str], column: str) -> DataFrame:
    """An array column with its ids replaced, order and nulls kept: (*keys, column). ``keys`` name a row."""
    parts = df.select(*dict.fromkeys([*scope, *keys]), F.posexplode_outer(column).alias("__pos", "id"))
    new = parts.join(mapping.select(*scope, "id", "new_id"), [*scope, "id"], "left")
    items = F.array_sort(F.collect_list(F.when(F.col("__pos").isNotNull(), F.struct("__pos", F.coalesce("new_id", "id").alias("v")))))
    return new.groupBy(*keys).agg(items.alias("__x")).select(*keys, F.transform("__x", lambda x: x["v"]).alias(column))


def nest(children: DataFrame, keys: list[str], order: str, fields: list[str], name: str) -> DataFrame:
    """Child rows as an ordered array of structs per parent."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), *fields)))
    return children.groupBy(*keys).agg(F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name))


def last_wins(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def first_wins(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(value))


def missing_from(rows: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key isn't among the known ones."""
    return rows.join(known.select(*on).distinct(), on, "left_anti")


def small_group(df: DataFrame, per: list[str], below: int) -> DataFrame:
    """Rows of groups with fewer than ``below`` rows."""
    return df.withColumn("__n", F.count("*").over(Window.partitionBy(*per))).where(F.col("__n") < below).drop("__n")
