"""References to records that do not exist, direct and inherited."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import is_blank, same_id
from tessera.operators.live import live_entities
from tessera.plans.runtime import materialize


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``field`` of ``entity_type`` in ``table`` names a ``target_type`` in ``target``."""

    table: str
    entity_type: str
    field: str
    target: str
    target_type: str
    many: bool = False


def reference_rows(tables: dict[str, DataFrame], references: list[Reference]) -> DataFrame:
    """Each distinct non-blank reference of a live record.

    (table_name, study_id, sid, entity_type, entity_no, created_at, field,
    target, target_type, ref_id). Null arrays, null and blank members give no
    row, members that are one id in same-id form give one. One scan a table.
    """
    parts = []
    for name in dict.fromkeys(r.table for r in references):
        own = [r for r in references if r.table == name]
        live = live_entities(
            tables[name],
            {
                "entity_no": F.col("entity_no"),
                "entity_type": F.col("entity_type"),
                "created_at": F.col("created_at"),
                **{f"f{i}": _as_array(F.col(f"data.{r.field}"), r.many) for i, r in enumerate(own)},
            },
        )
        fields = [
            F.when(
                F.col("entity_type") == r.entity_type,
                F.struct(F.lit(r.field).alias("field"), F.lit(r.target).alias("target"), F.lit(r.target_type).alias("target_type"), F.col(f"f{i}").alias("refs")),
            )
            for i, r in enumerate(own)
        ]
        parts.append(
            live.select("study_id", "sid", "entity_type", "entity_no", "created_at", F.explode(F.array_compact(F.array(*fields))).alias("r"))
            .select(
                F.lit(name).alias("table_name"), "study_id", "sid", "entity_type", "entity_no", "created_at",
                "r.field", "r.target", "r.target_type", F.explode("r.refs").alias("ref_id"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _as_array(c: Column, many: bool) -> Column:
    ids = c if many else F.array(c)
    return F.array_distinct(F.transform(F.filter(ids, lambda x: ~is_blank(x)), same_id))


def target_states(tables: dict[str, DataFrame], references: list[Reference]) -> DataFrame:
    """State of every record that may be referred to: (target, target_type, study_id, ref_id, gone, since)."""
    parts = []
    for name in dict.fromkeys(r.target for r in references):
        types = sorted({r.target_type for r in references if r.target == name})
        parts.append(
            tables[name]
            .where(F.col("entity_type").isin(types))
            .groupBy(F.lit(name).alias("target"), F.col("entity_type").alias("target_type"), "study_id", same_id("id").alias("ref_id"))
            .agg(
                F.max(F.struct("version", F.coalesce("is_deleted", F.lit(False)).alias("d")))["d"].alias("gone"),
                F.min("created_at").alias("since"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


NODE = ["table_name", "study_id", "entity_type", "sid"]
TARGET = ["target", "target_type", "study_id", "ref_id"]


def _levels_below(references: list[Reference]) -> bool:
    """Whether a record that refers to others may itself be referred to."""
    return bool({(r.table, r.entity_type) for r in references} & {(r.target, r.target_type) for r in references})


def find_orphans(tables: dict[str, DataFrame], references: list[Reference]) -> DataFrame:
    """Orphan references, direct and inherited, as the fixpoint of one cascade.

    The columns of :func:`reference_rows`, ``kind`` and ``round``. Round 0 are
    the direct ones. ``missing``: no row of that type and id in the study; else
    ``deleted``: its highest version is deleted; else ``late``: its earliest
    ``created_at`` is after that of the referring live row (never so where one
    of the two is null). Round n are the ``inherited`` ones: references, not
    orphans themselves, to a record that became an orphan in round n - 1, that
    is a record with an orphan reference of that round and none of an earlier
    one. Semi-joins run down the references until a round adds no record;
    cycles end because a record is reached once only. Where the references
    have no further level, which their types tell, round 0 is all there is.

    The states of the targets are one row each, so a target that a third of
    all references name is at most a skewed stream side, which adaptive
    execution splits. Each round is written to the scratch folder.
    """
    kind = (
        F.when(F.col("gone").isNull(), "missing")
        .when(F.col("gone"), "deleted")
        .when(F.col("since") > F.col("created_at"), "late")
    )
    refs = reference_rows(tables, references).join(target_states(tables, references), TARGET, "left")
    refs = refs.withColumn("kind", kind).drop("gone", "since")
    start = F.when(F.col("kind").isNotNull(), 0).alias("round")
    if not _levels_below(references):
        return refs.where("kind IS NOT NULL").select("*", start)
    refs = materialize(refs)
    reached = cascade(refs).select(
        F.col("table_name").alias("target"), F.col("entity_type").alias("target_type"), "study_id", F.col("sid").alias("ref_id"), (F.col("round") + 1).alias("round")
    )
    inherited = refs.where("kind IS NULL").join(reached, TARGET).withColumn("kind", F.lit("inherited"))
    direct = refs.where("kind IS NOT NULL").withColumn("round", F.lit(0))
    return direct.unionByName(inherited)


def cascade(refs: DataFrame) -> DataFrame:
    """Records orphaned directly or through a record they refer to: (table_name, study_id, entity_type, sid, round).

    ``refs`` has the columns of :func:`reference_rows` and ``kind``, null where
    the reference itself is sound. Round 0 are records with an orphan reference
    of their own, round n those that refer to a record of round n - 1 and to
    none before. What is known is written as one table every few rounds, so a
    long chain doesn't make long plans.
    """
    frontier = known = materialize(refs.where("kind IS NOT NULL").select(*NODE).distinct().withColumn("round", F.lit(0)))
    edges, n = refs.where("kind IS NULL").select(*NODE, "target", "target_type", "ref_id"), 0
    while not frontier.isEmpty():
        n += 1
        hit = frontier.select(F.col("table_name").alias("target"), F.col("entity_type").alias("target_type"), "study_id", F.col("sid").alias("ref_id"))
        found = edges.join(hit, TARGET, "left_semi").select(*NODE).distinct()
        frontier = materialize(found.join(known, NODE, "left_anti").withColumn("round", F.lit(n)), clean=False)
        known = known.unionByName(frontier)
        known = known if n % 8 else materialize(known, clean=False)
    return known


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans of :func:`find_orphans` by table, month of ``created_at``, field and kind: (table_name, month, field, kind, n).

    A null ``created_at`` is the null month.
    """
    month = F.date_format("created_at", "yyyy-MM").alias("month")
    return orphans.groupBy("table_name", month, "field", "kind").agg(F.count("*").alias("n"))
