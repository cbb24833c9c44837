"""Flat child tables out of deeply nested records, by columnar shredding."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import shredding as S
from tessera.operators.live import live_entities

CHILD_SCHEMA = "entity_no bigint, child_kind string, parent_id string, child_pos int, child_id string"


def _text(v) -> str | None:
    """An id as written; an object or list in its place as JSON."""
    if v is None or isinstance(v, str):
        return None if v is None else str(v)
    return {True: "true", False: "false"}.get(v, str(v)) if isinstance(v, bool) else str(v)


def child_rows(records: DataFrame, specs: list[tuple[str, str, bool, bool]]) -> DataFrame:
    """Child rows of JSON records: ``CHILD_SCHEMA``.

    ``records`` has (entity_no, json). Each of ``specs`` is (key, id field,
    repeated, drop rows without id). Every record is shredded to level columns
    within its Arrow batch and the children are rebuilt from them; there is no
    shuffle. Unreadable or null JSON gives no rows; strings that hold JSON are
    opened at any depth; a missing id is the empty string.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for no, text in zip(pdf["entity_no"], pdf["json"]):
                try:
                    record = S.opened_all(S.decode(text))
                except ValueError:
                    continue
                for key, ident, repeated, need in specs:
                    for parent, pos, own in S.children(record, key, ident, repeated):
                        if need and own is None:
                            continue
                        rows.append((no, key, _text(parent), pos, _text(own) or ""))
            yield pd.DataFrame(rows, columns=["entity_no", "child_kind", "parent_id", "child_pos", "child_id"])

    return records.select("entity_no", "json").mapInPandas(run, CHILD_SCHEMA)


def entries(items: Column, value: Callable[[Column], Column]) -> Column:
    """Level column of the leaves under a native array: array<struct<rep, def, value>>.

    One entry per element, and one for an array that is null or empty; the
    repetition level is 0 at the first entry of the record. Definition levels:
    0 no array, 1 an empty one, 2 a null element, 3 an element without a value,
    4 a value.
    """
    entry = lambda rep, level, v: F.struct(F.lit(rep).alias("rep") if isinstance(rep, int) else rep.alias("rep"), level.alias("def"), v.alias("value"))
    each = F.transform(items, lambda x, i: entry((i > 0).cast("int"), F.when(x.isNull(), 2).when(value(x).isNull(), 3).otherwise(4), value(x).cast("string")))
    none = F.array(entry(0, F.when(items.isNull(), 0).otherwise(1), F.lit(None).cast("string")))
    return F.when(F.size(items) > 0, each).otherwise(none)


def level_children(records: DataFrame, kind: str, levels: Column, least: int) -> DataFrame:
    """Child rows of (entity_no, parent_id) out of a level column: ``CHILD_SCHEMA``.

    A child is an entry of definition level ``least`` or more; since there is
    one repeated step, its position is the number of entries before it, the
    first of which has the repetition level 0.
    """
    rows = records.select("entity_no", "parent_id", F.posexplode(levels).alias("pos", "e"))
    return rows.where(F.col("e.def") >= least).select(
        "entity_no", F.lit(kind).alias("child_kind"), "parent_id", F.when(F.col("e.rep") == 0, 0).otherwise(F.col("pos")).alias("child_pos"), F.coalesce("e.value", F.lit("")).alias("child_id")
    )


def objective_children(objectives: DataFrame) -> DataFrame:
    """Levels with a code, and intercurrent events, of live objective records.

    The columns are native structs, so their levels are column expressions and
    nothing leaves the JVM.
    """
    events = entries(F.col("data.intercurrentEvents"), lambda x: x["id"])
    live = live_entities(
        objectives,
        {"entity_no": F.col("entity_no"), "parent_id": F.col("data.id"), "level": F.col("data.level.code"), "events": F.when(F.size("data.intercurrentEvents") > 0, events)},
    )
    level = F.array(F.struct(F.lit(0).alias("rep"), F.when(F.col("level").isNull(), 3).otherwise(4).alias("def"), F.col("level").alias("value")))
    return level_children(live, "level", level, 4).unionByName(level_children(live, "intercurrentEvents", F.col("events"), 3))


def scope_children(advanced: DataFrame) -> DataFrame:
    """Geographic scopes at any depth of live amendments."""
    live = live_entities(advanced, {"entity_no": F.col("entity_no"), "entity_type": F.col("entity_type"), "json": F.col("data")})
    return child_rows(live.where("entity_type = 'study_amendment'"), [("geographicScopes", "id", True, False)])


def level_columns(records: DataFrame) -> DataFrame:
    """The shredded form itself: (entity_no, path, entry, rep_level, def_level, value).

    One row per leaf occurrence in column order; unreadable JSON gives none.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for no, text in zip(pdf["entity_no"], pdf["json"]):
                try:
                    record = S.opened_all(S.decode(text))
                except ValueError:
                    continue
                for path, column in S.shred(record).items():
                    rows += [(no, path, i, r, d, _text(v)) for i, (r, d, v) in enumerate(column)]
            yield pd.DataFrame(rows, columns=["entity_no", "path", "entry", "rep_level", "def_level", "value"])

    return records.select("entity_no", "json").mapInPandas(
        run, "entity_no bigint, path string, entry int, rep_level int, def_level int, value string"
    )
