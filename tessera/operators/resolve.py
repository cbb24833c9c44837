"""Entity resolution by key, priority and order.

Contributions are rows (key, source, priority, pos, fields); ``pos`` is the
order of arrival, and every choice ends with it, so that no result depends on
the order in which rows reach a task. All merges are single aggregations with
partial results before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rank of the sources of entities and cells; others rank last.
SOURCE_PRIORITY = {"execution_agent": 5, "procedures_agent": 4, "soa_vision_agent": 3, "soa_text_agent": 2}
OTHER_PRIORITY = 1
TICKS = ["X", "x", "✓", "✔", "√", "Y", "y", "Yes", "yes"]
EMPTY_CELLS = ["", "-", "—", "N", "n", "No", "no"]
BOOST_BP, PENALTY_BP = 1000, 1500



def _strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def source_priority(source: Column | str) -> Column:
    c = F.col(source) if isinstance(source, str) else source
    out = F.lit(OTHER_PRIORITY)
    for name, rank in SOURCE_PRIORITY.items():
        out = F.when(c == name, rank).otherwise(out)
    return out


def filled(c: Column) -> Column:
    """The value, null where it is blank text."""
    return F.when(F.coalesce(_strip(c.cast("string")), F.lit("")) != "", c)


def contributions(sources: list[tuple[str, int, DataFrame]]) -> DataFrame:
    """Rows of several sources with their name and priority, missing columns null."""
    parts = [df.withColumns({"source": F.lit(s), "priority": F.lit(p)}) for s, p, df in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_by_priority(df: DataFrame, keys: list[str], best: list[str] = (), pairs: dict[str, list[str]] | None = None, **more: Column) -> DataFrame:
    """One row per key with, for each field, the first filled value by priority, then arrival.

    ``pairs`` are groups of fields that only come together, from the first row
    whose first field is filled. ``more`` are further aggregates.
    """
    order = F.struct(F.col("priority"), -F.col("pos"))
    out = [F.max_by(F.col(f), F.when(filled(F.col(f)).isNotNull(), order)).alias(f) for f in best]
    for name, fields in (pairs or {}).items():
        out.append(F.max_by(F.struct(*fields), F.when(F.col(fields[0]).isNotNull(), order)).alias(name))
    return df.groupBy(*keys).agg(*out, *[c.alias(n) for n, c in more.items()])


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def numbered_names(df: DataFrame, keys: list[str], name: str, order: list, suffix: Callable[[Column], Column] | None = None) -> DataFrame:
    """Repeated names get a number, `` (n)``, from the second on, or what ``suffix`` makes of it."""
    n = F.row_number().over(Window.partitionBy(*keys, name).orderBy(*order))
    tail = suffix(n) if suffix else F.concat(F.lit(" ("), n.cast("string"), F.lit(")"))
    return df.withColumn(name, F.when(n > 1, F.concat(F.col(name), tail)).otherwise(F.col(name)))


def names_with_context(df: DataFrame, keys: list[str], name: str, context: list[str]) -> DataFrame:
    """Names that occur more than once get the first filled context in brackets."""
    n = F.count("*").over(Window.partitionBy(*keys, name))
    ctx = F.coalesce(*[filled(F.col(c)) for c in context])
    return df.withColumn(name, F.when((n > 1) & ctx.isNotNull(), F.concat(F.col(name), F.lit(" ("), ctx, F.lit(")"))).otherwise(F.col(name)))


def values_agree(a: Column, b: Column) -> Column:
    """Two cell values are the same: ticks, empty marks, equal numbers, or text but for case."""
    x, y = _strip(F.coalesce(a, F.lit(""))), _strip(F.coalesce(b, F.lit("")))
    return (
        (x.isin(TICKS) & y.isin(TICKS)) | (x.isin(EMPTY_CELLS) & y.isin(EMPTY_CELLS))
        | F.coalesce(x.try_cast("double") == y.try_cast("double"), F.lit(False)) | (F.lower(x) == F.lower(y))
    )


def reconcile_cells(cells: DataFrame) -> DataFrame:
    """Cells of two readers resolved: the input and (resolved, confidence_bp, strategy).

    ``cells`` has (vision_value, text_value, vision_bp, text_bp), confidence in
    1/10000 and null as 5000. One side only is taken as it is; agreement raises
    the higher confidence, a conflict lowers it. In a conflict a tick beats an
    empty cell, of two numbers the surer one counts, else the vision side.
    """
    v, t = F.col("vision_value"), F.col("text_value")
    # staged, so that each test is computed once and the generated code stays small
    staged = cells.withColumns({"__x": _strip(v), "__y": _strip(t), "__vb": F.coalesce("vision_bp", F.lit(5000)), "__tb": F.coalesce("text_bp", F.lit(5000))})
    flags = {"__both": v.isNotNull() & t.isNotNull(), "__same": F.lower("__x") == F.lower("__y")}
    for side in "xy":
        c = F.col(f"__{side}")
        flags |= {f"__{side}t": c.isin(TICKS), f"__{side}e": c.isin(EMPTY_CELLS), f"__{side}n": c.try_cast("double")}
    staged = staged.withColumns(flags)
    both, numbers = F.col("__both"), F.col("__xn").isNotNull() & F.col("__yn").isNotNull()
    agree = both & ((F.col("__xt") & F.col("__yt")) | (F.col("__xe") & F.col("__ye")) | F.coalesce(F.col("__xn") == F.col("__yn"), F.lit(False)) | F.col("__same"))
    strategy = (
        F.when(~both, "single").when(agree, "agree").when((F.col("__xt") & F.col("__ye")) | (F.col("__yt") & F.col("__xe")), "tick_present_over_absent")
        .when(numbers, "numeric_higher_confidence").otherwise("source_priority")
    )
    staged = staged.withColumn("strategy", strategy)
    s, most = F.col("strategy"), F.greatest("__vb", "__tb")
    text_wins = ((s == "tick_present_over_absent") & F.col("__yt") & F.col("__xe")) | ((s == "numeric_higher_confidence") & (F.col("__vb") < F.col("__tb")))
    resolved = F.when(s == "single", F.coalesce(v, t)).when(text_wins, t).otherwise(v)
    bp = F.when(s == "agree", F.least(F.lit(10000), most + BOOST_BP)).when(s != "single", F.greatest(F.lit(0), most - PENALTY_BP))
    out = staged.withColumns({"resolved": resolved, "confidence_bp": bp.cast("bigint")})
    return out.select(*cells.columns, "resolved", "confidence_bp", "strategy")


def field_conflicts(values: DataFrame, keys: list[str]) -> DataFrame:
    """Fields with values of two or more sources: (*keys, field, sources, agrees, resolved, winner).

    ``values`` has (*keys, field, source, value); null is the empty text. The
    value of the source with the highest priority counts, ties by its name.
    """
    rank = F.struct(source_priority("source"), F.col("source"))
    text = F.coalesce("value", F.lit(""))
    return (
        values.groupBy(*keys, "field")
        .agg(
            F.count_distinct("source").alias("sources"), (F.min(text) == F.max(text)).alias("agrees"),
            F.max_by("value", rank).alias("resolved"), F.max_by("source", rank).alias("winner"),
        )
        .where("sources > 1")
    )


def one_decode(codes: DataFrame, keys: list[str], order: list, seed: DataFrame | None = None) -> DataFrame:
    """Each code with the decode that was seen first for it; a seed entry comes before all."""
    first = F.first_value("decode").over(Window.partitionBy(*keys).orderBy(*order))
    out = codes.withColumn("decode", first)
    if seed is None:
        return out
    seeded = seed.select(*keys, F.col("decode").alias("__seed"))
    return out.join(F.broadcast(seeded), keys, "left").withColumn("decode", F.coalesce("__seed", "decode")).drop("__seed")


def screen_ticks(ticks: DataFrame, issues: DataFrame, keys: list[str], threshold: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(confirmed, doubtful) ticks: doubtful are those with an issue of at least the threshold."""
    hard = issues.where(F.col("confidence") >= threshold).select(*keys).distinct()
    return ticks.join(hard, keys, "left_anti"), ticks.join(hard, keys, "left_semi")


def overlay(first: DataFrame, second: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Rows of either side; a field of ``second`` replaces that of ``first`` where it isn't null, empty or zero."""
    new = second.select(*keys, *[F.col(f).alias(f"__{f}") for f in fields])
    value = lambda f: F.coalesce(F.when(~F.col(f"__{f}").cast("string").isin("", "0", "0.0"), F.col(f"__{f}")), F.col(f)).alias(f)
    return first.select(*keys, *fields).join(new, keys, "full_outer").select(*keys, *map(value, fields))
