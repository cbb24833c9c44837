"""Rules over records: a field specification as data, issues as rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import is_blank


@dataclass(frozen=True)
class Field:
    """What a type demands of a field; ``kind`` is text or list."""

    entity_type: str
    name: str
    kind: str = "text"
    required: bool = False
    least: int = 0
    most: int | None = None
    default: str | None = None


def issues(df: DataFrame, keys: list[str], fields: list[Field], columns: dict[str, Column], known_types: list[str]) -> DataFrame:
    """Broken demands: (*keys, entity_type, field, category, severity).

    ``missing`` for a required field that is null, blank or an empty list,
    ``cardinality`` for lists that are too short or long, ``unknown_type`` for
    types without a specification. All rules are one projection over the rows.
    """
    cells = []
    for f in fields:
        c = columns[f.name]
        size = F.coalesce(F.size(c), F.lit(0)) if f.kind == "list" else None
        here = F.col("entity_type") == f.entity_type
        rules = []
        if f.required:
            rules.append(("missing", "ERROR", F.coalesce(size <= 0, F.lit(True)) if f.kind == "list" else is_blank(c)))
        if f.kind == "list" and f.least:
            rules.append(("cardinality", "ERROR", (size < f.least) & (size > 0)))
        if f.kind == "list" and f.most is not None:
            rules.append(("cardinality", "WARNING", size > f.most))
        cells += [F.when(here & test, F.struct(F.lit(f.name).alias("field"), F.lit(cat).alias("category"), F.lit(sev).alias("severity"))) for cat, sev, test in rules]
    unknown = F.when(~F.coalesce(F.col("entity_type").isin(known_types), F.lit(False)), F.struct(F.lit("").alias("field"), F.lit("unknown_type").alias("category"), F.lit("WARNING").alias("severity")))
    return df.select(*keys, "entity_type", F.explode(F.array_compact(F.array(*cells, unknown))).alias("i")).select(*keys, "entity_type", "i.*")


def fill_defaults(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Blank fields of a type get its default; ``filled`` names those that did."""
    out, named = df, []
    for f in fields:
        if f.default is not None:
            need = (F.col("entity_type") == f.entity_type) & is_blank(f.name)
            named.append(F.when(need, F.lit(f.name)))
    out = out.withColumn("filled", F.array_compact(F.array(*named)) if named else F.array().cast("array<string>"))
    for f in fields:
        if f.default is not None:
            out = out.withColumn(f.name, F.when(F.array_contains("filled", f.name) & (F.col("entity_type") == f.entity_type), F.lit(f.default)).otherwise(F.col(f.name)))
    return out


def fix_until_stable(df: DataFrame, fix, count_issues, most: int = 3) -> tuple[DataFrame, int]:
    """Apply ``fix`` until the number of issues stays the same or ``most`` rounds are over: (table, rounds)."""
    from tessera.plans.runtime import materialize

    rounds, before = 0, count_issues(df)
    while rounds < most and before:
        df = materialize(fix(df))
        rounds += 1
        after = count_issues(df)
        if after == before:
            break
        before = after
    return df, rounds


def rule_rows(rules: list[tuple[str, str, DataFrame]], keys: list[str]) -> DataFrame:
    """Rows that break a rule, with the rule's name and severity, in one list."""
    parts = [df.select(F.lit(r).alias("rule"), F.lit(s).alias("severity"), *keys) for r, s, df in rules]
    return reduce(DataFrame.unionByName, parts)
