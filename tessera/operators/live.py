"""Current state of versioned entity rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import same_id


def live_entities(
    df: DataFrame,
    payload: dict[str, Column],
    study: str = "study_id",
    ident: str = "id",
    version: str = "version",
    deleted: str = "is_deleted",
) -> DataFrame:
    """One row per live entity: (study_id, sid, *payload).

    Of the rows with one study and id (in same-id form) the highest version
    counts; if it is deleted the entity is absent. Rows repeat and arrive in any
    order. A null version is below all others, a null ``is_deleted`` is false,
    null keys form a key of their own. Ties of version fall to the row that
    sorts last by (is_deleted, payload), so the result doesn't depend on order.

    One shuffle on the key, combined on the map side first: a key that holds
    any share of the rows reaches the shuffle as one row per map task.
    """
    head = F.struct(
        F.col(version).alias("__version"),
        F.coalesce(F.col(deleted), F.lit(False)).alias("__deleted"),
        *[c.alias(n) for n, c in payload.items()],
    )
    return (
        df.select(F.col(study).alias("study_id"), same_id(ident).alias("sid"), head.alias("h"))
        .groupBy("study_id", "sid")
        .agg(F.max("h").alias("h"))
        .where(~F.col("h.__deleted"))
        .select("study_id", "sid", *[F.col(f"h.{n}").alias(n) for n in payload])
    )
