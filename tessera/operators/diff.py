"""Differences between two copies of a dataset.

Both sides are unpivoted to key-field-value rows with a sign, +1 for the left
side and -1 for the right; cells that are in both cancel, and what is left over
names the keys and fields that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import digest, plain_space, same_id

#: Name of the cell that stands for the row itself.
PRESENCE = ""


def diff_copies(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, Column],
    fields: dict[str, Column],
    version: Column | None = None,
    deleted: Column | None = None,
    missing_right: str = "missing_in_right",
    missing_left: str = "missing_in_left",
) -> DataFrame:
    """Rows held by one side only and fields that differ: (*keys, diff).

    ``diff`` is ``missing_right`` or ``missing_left`` for a key on one side
    only, else the name of a field whose values differ. Of several rows with
    one key the highest ``version`` counts, and a deleted one counts as absent;
    without ``version`` repeated equal rows count once. Null keys are keys like
    any other, null versions are below all others, an empty side gives one
    missing row for each key of the other.

    Cells travel as 128-bit digests of the values, so long texts never enter
    the shuffle. There is one shuffle, on the key and combined before it; the
    groupings after it all keep the key, so none of them moves rows again.
    """

    # inner names, so that keys may be called anything
    names = [f"__key{i}" for i in range(len(keys))]

    def side(df: DataFrame, sign: int) -> DataFrame:
        cells = [part.alias(f"{n}_{i}") for n, c in fields.items() for i, part in enumerate(digest(c))]
        state = F.struct(
            (version if version is not None else F.lit(0)).alias("v"),
            (F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)).alias("d"),
            *cells,
        )
        return df.select(*[c.alias(n) for n, c in zip(names, keys.values())], F.lit(sign).alias("sign"), state.alias("state"))

    both = side(left, 1).unionByName(side(right, -1))
    current = both.groupBy(*names).agg(
        F.max(F.when(F.col("sign") == 1, F.col("state"))).alias("l"),
        F.max(F.when(F.col("sign") == -1, F.col("state"))).alias("r"),
    )

    def cells_of(s: str, sign: int) -> Column:
        cell = lambda name, hi, lo: F.struct(
            F.lit(name).alias("field"), hi.alias("hi"), lo.alias("lo"), F.lit(sign).alias("sign")
        )
        rows = [cell(PRESENCE, F.lit(0).cast("long"), F.lit(0).cast("long"))]
        rows += [cell(n, F.col(f"{s}.{n}_0"), F.col(f"{s}.{n}_1")) for n in fields]
        there = F.col(s).isNotNull() & ~F.col(f"{s}.d")
        return F.when(there, F.array(*rows)).otherwise(F.array().cast("array<struct<field:string,hi:bigint,lo:bigint,sign:int>>"))

    unpivoted = current.select(*names, F.explode(F.concat(cells_of("l", 1), cells_of("r", -1))).alias("c")).select(*names, "c.*")
    left_over = unpivoted.groupBy(*names, "field", "hi", "lo").agg(F.sum("sign").alias("sign")).where("sign <> 0")
    per_key = left_over.groupBy(*names).agg(
        F.max(F.when(F.col("field") == PRESENCE, F.col("sign"))).alias("alone"),
        F.array_sort(F.collect_set(F.when(F.col("field") != PRESENCE, F.col("field")))).alias("changed"),
    )
    diffs = (
        F.when(F.col("alone") > 0, F.array(F.lit(missing_right)))
        .when(F.col("alone") < 0, F.array(F.lit(missing_left)))
        .otherwise(F.col("changed"))
    )
    return per_key.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], F.explode(diffs).alias("diff"))


def diff_entities(left: DataFrame, right: DataFrame, fields: list[str], left_name: str, right_name: str) -> DataFrame:
    """:func:`diff_copies` over live entities, fields inside ``data``: (study_id, id, diff).

    Values are equal after runs of white space become one blank and outer
    blanks go; null equals empty.
    """
    return diff_copies(
        left,
        right,
        keys={"study_id": F.col("study_id"), "id": same_id("id")},
        fields={f: plain_space(f"data.{f}") for f in fields},
        version=F.col("version"),
        deleted=F.col("is_deleted"),
        missing_right=f"missing_in_{right_name}",
        missing_left=f"missing_in_{left_name}",
    )


def diff_summary(diffs: DataFrame) -> DataFrame:
    """Differences counted by kind and study: (study_id, diff, n)."""
    return diffs.groupBy("study_id", "diff").agg(F.count("*").alias("n"))
