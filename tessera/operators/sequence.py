"""Order, neighbours, runs and levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.runtime import materialize


def neighbours(df: DataFrame, per: list[str], order: list, ident: str = "id") -> DataFrame:
    """Each row with the ids before and after it in its group: previous_id, next_id."""
    w = Window.partitionBy(*per).orderBy(*order)
    return df.withColumns({"previous_id": F.lag(ident).over(w), "next_id": F.lead(ident).over(w)})


def offsets(df: DataFrame, per: list[str], order: list, width: Column) -> DataFrame:
    """Each row with the sum of the widths before it in its group: offset."""
    w = Window.partitionBy(*per).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(width).over(w), F.lit(0)))


def islands(df: DataFrame, per: list[str], at: str, gap: int = 1) -> DataFrame:
    """Runs of numbers with steps of at most ``gap``: (*per, start, end, n), numbers distinct."""
    w = Window.partitionBy(*per).orderBy(at)
    fresh = F.when(F.col(at) - F.lag(at).over(w) <= gap, 0).otherwise(1)
    marked = df.select(*per, at).distinct().withColumn("__new", fresh).withColumn("__run", F.sum("__new").over(w))
    return marked.groupBy(*per, "__run").agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count("*").alias("n")).drop("__run")


def expanded_pages(df: DataFrame, per: list[str], at: str, last: Column, gap: int = 2, margin: int = 1) -> DataFrame:
    """Page numbers with gaps of at most ``gap`` missing pages filled and every run widened by ``margin``, within 0 and ``last`` - 1: (*per, page)."""
    runs = islands(df, per, at, gap + 1)
    pages = F.sequence(F.greatest(F.lit(0), F.col("start") - margin), F.least(last - 1, F.col("end") + margin))
    return runs.where(F.greatest(F.lit(0), F.col("start") - margin) <= F.least(last - 1, F.col("end") + margin)).select(*per, F.explode(pages).alias("page")).distinct()


def lines_of(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per line of a text: (*keys, line_no, line)."""
    return df.where(F.col(text).isNotNull()).select(*keys, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def line_regions(lines: DataFrame, keys: list[str], is_member: Column, least: int = 3) -> DataFrame:
    """Runs of at least ``least`` lines that belong together: (*keys, start, end, n, confidence_bp)."""
    runs = islands(lines.where(is_member), keys, "line_no").where(F.col("n") >= least)
    return runs.withColumn("confidence_bp", F.least(F.lit(9000), 5000 + 1000 * F.col("n")).cast("bigint"))


def line_context(lines: DataFrame, keys: list[str], after: int = 2) -> DataFrame:
    """Each line with the next ones joined to it: context."""
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(0, after)
    return lines.withColumn("context", F.array_join(F.collect_list("line").over(w), "\n"))


def match_context(c: Column | str, pattern: str, chars: int = 100) -> Column:
    """The first match with up to ``chars`` characters before and after; null without a match."""
    text = F.col(c) if isinstance(c, str) else c
    at, found = F.regexp_instr(text, F.lit(pattern)), F.regexp_extract(text, pattern, 0)
    start = F.greatest(F.lit(1), at - chars)
    return F.when(at > 0, F.substring(text, start, at - start + F.length(found) + chars))


def waves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Levels of a dependency graph: (node, wave).

    ``edges`` has (node, depends_on); a node comes one wave after the last of
    what it depends on, unknown dependencies don't count. What is left in
    cycles, or depends on them, makes one more wave. Each wave is an anti-join
    over what is left and is written before the next, so plans don't grow; it
    settles one node at least, so the rounds end by themselves.
    """
    left = materialize(nodes.select("node").distinct())
    open_edges = materialize(edges.select("node", "depends_on").distinct().join(left.withColumnRenamed("node", "depends_on"), "depends_on", "left_semi").join(left, "node", "left_semi"))
    done, n = left.where("false").withColumn("wave", F.lit(0)), 0
    while not left.isEmpty():
        ready = materialize(left.join(open_edges.select("node"), "node", "left_anti"), clean=False)
        if ready.isEmpty():
            ready = left
        done = done.unionByName(ready.withColumn("wave", F.lit(n)))
        left = materialize(left.join(ready, "node", "left_anti"), clean=False)
        # what a settled node depends on is settled as well
        open_edges = materialize(open_edges.join(ready.withColumnRenamed("node", "depends_on"), "depends_on", "left_anti"), clean=False)
        n += 1
        done = done if n % 16 else materialize(done, clean=False)
    return done
