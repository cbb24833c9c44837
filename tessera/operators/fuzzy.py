"""Similar names and greedy choices among them, without gathering groups.

Greedy clustering and greedy one-to-one matching are sequential by definition,
but their outcome follows from the similar pairs alone. Where pairs are wanted
they come from an equi-join on shared runs of characters or from blocks of a
group, and leaders and matchings are settled in one pass over a group's sorted
pairs. Names and texts are clustered and matched in one pass without pairs.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.functions import likeness as L
from tessera.functions import names as N
from tessera.operators import linking as K
from tessera.plans.runtime import materialize


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts, the first one leading; 0 where one is null or empty."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)], dtype="float64")


def name_score(a: Column, b: Column) -> Column:
    """Ratio of two names without footnote marks and case; equal ones are 1."""
    x, y = F.lower(N.clean_name(a)), F.lower(N.clean_name(b))
    blank = (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")
    return F.when(blank, 0.0).when(x == y, 1.0).otherwise(sequence_ratio(x, y))


def names_match(a: Column, b: Column, threshold: float = 0.85) -> Column:
    """Names that are alike; different numbers at their ends never match."""
    x, y = N.matching_form(a), N.matching_form(b)
    p = r"(\d+)\s*$"
    m, n = F.regexp_extract(x, p, 1), F.regexp_extract(y, p, 1)
    return (x == y) | (~((m != "") & (n != "") & (m != n)) & (sequence_ratio(x, y) >= threshold))


def text_similarity(a: Column, b: Column) -> Column:
    """Ratio of two texts, at least 0.85 where one contains the other (five characters or more), at least 0.6 + 0.3 s where they share s >= half of the words of the shorter."""
    x, y = N.plain_text(a), N.plain_text(b)
    inside = (F.length(x) >= 5) & (F.length(y) >= 5) & (x.contains(y) | y.contains(x))
    wx, wy = F.array_distinct(F.split(x, " ")), F.array_distinct(F.split(y, " "))
    share = F.size(F.array_intersect(wx, wy)) / F.least(F.size(wx), F.size(wy))
    base = F.greatest(sequence_ratio(x, y), F.when(inside, 0.85).otherwise(0.0), F.when(share >= 0.5, 0.6 + share * 0.3).otherwise(0.0))
    return F.when((x == "") & (y == ""), 1.0).when((x == "") | (y == ""), 0.0).when(x == y, 1.0).otherwise(base)


def similar_pairs(df: DataFrame, by: list[str], order: str, name: str, threshold: float = 0.85) -> DataFrame:
    """Pairs of rows with similar names: (*by, a, b, score), a before b by the unique ``order``.

    A ratio of 0.85 or more leaves at most 15 % of the characters unmatched, so
    two such names share a run of three characters, or they start with the same
    character and are shorter than nine each. That holds from 0.85 on only; for
    less there is ``alike_across``. Equal names count as 1 and meet through
    their common distinct name.
    """
    if threshold < 0.85:
        raise ValueError("runs of three characters lose pairs below 0.85")
    given, by = by, [f"__by_{i}" for i in range(len(by))]
    text = F.lower(N.clean_name(name))
    rows = df.select(*[F.col(c).alias(x) for c, x in zip(given, by)], F.col(order).alias("o"), text.alias("t")).where("t <> ''")
    distinct = materialize(rows.select(*by, "t").distinct())
    runs = F.when(F.length("t") >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("t") - 2), lambda i: F.substring(F.col("t"), i, 3)))).otherwise(F.array(F.substring("t", 1, 1)))
    short = F.array(F.substring("t", 1, 1))
    grams = distinct.select(*by, "t", F.explode(F.array_distinct(F.concat(runs, F.when(F.length("t") < 9, short).otherwise(F.array().cast("array<string>"))))).alias("g"))
    l, r = grams.alias("l"), grams.alias("r")
    la, lb = F.length("l.t"), F.length("r.t")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by] + [F.col("l.g") == F.col("r.g"), F.col("l.t") != F.col("r.t"), 2 * F.least(la, lb) >= threshold * (la + lb)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    met = l.join(r, cond).select(*[F.col(f"l.{c}").alias(c) for c in by], F.col("l.t").alias("x"), F.col("r.t").alias("y")).distinct()

    def score(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            pdf["score"] = [SequenceMatcher(None, x, y).ratio() for x, y in zip(pdf["x"], pdf["y"])]
            yield pdf[pdf["score"] >= threshold]

    schema = T.StructType([*[distinct.schema[c] for c in by], T.StructField("x", T.StringType()), T.StructField("y", T.StringType()), T.StructField("score", T.DoubleType())])
    alike = met.mapInPandas(score, schema)
    same = distinct.select(*by, F.col("t").alias("x"), F.col("t").alias("y"), F.lit(1.0).alias("score"))
    links = alike.unionByName(same)
    first = rows.select(*by, F.col("o").alias("a"), F.col("t").alias("x"))
    second = rows.select(*by, F.col("o").alias("b"), F.col("t").alias("y"))
    return first.join(links, [*by, "x"]).join(second, [*by, "y"]).where("a < b").select(*[F.col(x).alias(c) for c, x in zip(given, by)], "a", "b", "score")


#: Distinct texts of a side that meet those of the other in one task.
BLOCK = 1000


def alike_across(left: DataFrame, right: DataFrame, by: list[str], threshold: float, words: bool = False) -> DataFrame:
    """Pairs of a left and a right text that may be alike: (*by, x, y), distinct. Both sides have (*by, text).

    Every pair of a group is looked at, in blocks of bounded size, so a large
    group is many tasks. A pair is left out only if the characters that both
    texts have, in whatever order, are too few for a ratio of ``threshold``.
    With ``words`` the pairs stay, too, that ``text_similarity`` rates by
    containment or by half of the shorter one's words.
    """
    ls = left.select(*by, F.col("text").alias("x")).where("x <> ''").distinct()
    rs = right.select(*by, F.col("text").alias("y")).where("y <> ''").distinct()
    ls, rs = materialize(ls), materialize(rs)
    blocks = lambda df, n: df.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(n))
    count = materialize(blocks(ls, "nx").join(blocks(rs, "ny"), by))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = ls.join(count, by).withColumn("bx", F.pmod(F.xxhash64("x"), "nx").cast("int")).withColumn("by", each("ny")).select(*by, "bx", "by", "x")
    b = rs.join(count, by).withColumn("by", F.pmod(F.xxhash64("y"), "ny").cast("int")).withColumn("bx", each("nx")).select(*by, "bx", "by", "y")
    schema = T.StructType([*[ls.schema[c] for c in by], T.StructField("x", T.StringType()), T.StructField("y", T.StringType())])

    def meet(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        xs, ys = list(l["x"]), list(r["y"])
        kept = [(i, j) for i, j in zip(*possible(xs, ys, threshold, words))] if xs and ys else []
        out = pd.DataFrame({"x": [xs[i] for i, _ in kept], "y": [ys[j] for _, j in kept]}, dtype="object")
        for k, c in enumerate(by):
            out.insert(k, c, l[c].iloc[0] if len(l) else None)
        return out

    return a.groupBy(*by, "bx", "by").cogroup(b.groupBy(*by, "bx", "by")).applyInPandas(meet, schema)


def possible(xs: list[str], ys: list[str], threshold: float, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs whose common characters, or words, allow a match."""

    def common(a: list, b: list) -> np.ndarray:
        """Elements that each two have in common, repeats counted."""
        counts = [[Counter(x) for x in side] for side in (a, b)]
        out = np.zeros((len(a), len(b)), "int32")
        where: list[dict] = [defaultdict(list), defaultdict(list)]
        for k in (0, 1):
            for i, c in enumerate(counts[k]):
                for v, n in c.items():
                    where[k][v].append((i, n))
        for v in where[0].keys() & where[1].keys():
            (i, m), (j, n) = zip(*where[0][v]), zip(*where[1][v])
            out[np.ix_(i, j)] += np.minimum.outer(np.array(m, "int32"), np.array(n, "int32"))
        return out

    lx, ly = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    both, total, least = common(xs, ys), np.add.outer(lx, ly), np.minimum.outer(lx, ly)
    ok = 2 * both >= threshold * total - 1e-9
    if words:
        wx, wy = [set(x.split(" ")) for x in xs], [set(y.split(" ")) for y in ys]
        shorter = np.minimum.outer(np.array([len(w) for w in wx]), np.array([len(w) for w in wy]))
        ok |= (both == least) & (least >= 5)
        ok |= 2 * common(wx, wy) >= shorter
    return np.nonzero(ok)


def greedy_leaders(nodes: DataFrame, pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Leader clustering in order: (node, leader).

    ``nodes`` has (*by, node), ``pairs`` (*by, a, b) with a before b. In
    ascending order each node that no earlier leader has taken becomes a leader
    and takes every later node it is paired with; one that several could take
    goes to the first of them. One pass over the sorted pairs, one task a
    group: what it keeps are the group's leaders, not its pairs.
    """
    keys = [f"__by_{i}" for i in range(len(by or []))]
    group = [F.col(c).alias(k) for c, k in zip(by or [], keys)]
    kind = nodes.schema["node"].dataType
    rows = nodes.select(*group, "node", F.lit(None).cast(kind).alias("a")).unionByName(pairs.select(*group, F.col("b").alias("node"), "a"))
    # the row of the node itself, without an a, comes before those of its pairs
    ordered = (rows.repartition(*keys) if keys else rows.coalesce(1)).sortWithinPartitions(*keys, "node", F.col("a").asc_nulls_first())

    def settle(batches: Iterator[pa.RecordBatch]):
        group, node, leaders = None, None, set()
        for batch in batches:
            done: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            for *k, n, a in zip(*columns):
                if a is not None:
                    if n == node and a in leaders and k == group:
                        done.append((n, a))
                        node = None
                    continue
                if node is not None:  # nobody has taken the one before
                    leaders.add(node)
                    done.append((node, node))
                if k != group:
                    group, leaders = k, set()
                node = n
            yield pa.RecordBatch.from_pydict({"node": [n for n, _ in done], "leader": [x for _, x in done]}, schema=out)
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "leader": [node]}, schema=out)

    schema = T.StructType([T.StructField("node", kind), T.StructField("leader", kind)])
    out = to_arrow_schema(schema)
    return ordered.mapInArrow(settle, schema)


def similar_leaders(df: DataFrame, by: list[str], order: str, name: str, threshold: float = 0.85) -> DataFrame:
    """Leader clustering of similar names within ``by``, in the unique ``order``: (node, leader).

    Equal names have the same leader, since whatever takes the first of them
    takes the others, or else the first does. Blank names and rows without a
    group have no partner. One shuffle and one pass: a task compares each new
    name with the leaders of its group and makes no pairs. It holds the group's
    distinct names.
    """
    keys = [f"__by_{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(order).alias("node"), F.lower(N.clean_name(name)).alias("t"))
    alone = reduce(lambda x, k: x | F.col(k).isNull(), keys, F.coalesce("t", F.lit("")) == "")
    group = [*keys, "__alone"]  # those alone are spread over all tasks
    ordered = rows.withColumn("__alone", F.when(alone, F.xxhash64("node"))).repartition(*group).sortWithinPartitions(*group, "node")
    kind = df.schema[order].dataType

    def settle(batches: Iterator[pa.RecordBatch]):
        last, leaders = None, None
        for batch in batches:
            took = []
            nodes, texts = batch.column("node").to_pylist(), batch.column("t").to_pylist()
            for n, t, *k in zip(nodes, texts, *(batch.column(c).to_pylist() for c in group)):
                if k[-1] is not None:
                    took.append(n)
                    continue
                if k != last:
                    last, leaders = k, L.Leaders(threshold)
                took.append(leaders.leader(t, n))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, out.types[0]), pa.array(took, out.types[1])], schema=out)

    schema = T.StructType([T.StructField("node", kind), T.StructField("leader", kind)])
    out = to_arrow_schema(schema)
    return ordered.mapInArrow(settle, schema)


def greedy_matching(scores: DataFrame, threshold: float = 0.0) -> DataFrame:
    """One-to-one matching in order of the left side: (g, e, score).

    ``scores`` has (g, e, score). In ascending order of ``g`` each takes its
    best free partner with a score above 0 and of at least ``threshold``, ties
    to the smaller ``e``.
    """
    return _settled(scores.where((F.col("score") > 0) & (F.col("score") >= threshold)).select("g", "e", "score"), [])


def _settled(options: DataFrame, by: list[str]) -> DataFrame:
    """The matching: (*by, g, e, score). One pass over the sorted options, one task a group: it keeps which ``e`` are taken."""
    ordered = (options.repartition(*by) if by else options.coalesce(1)).sortWithinPartitions(*by, "g", F.col("score").desc(), "e")
    kept = T.StructType([options.schema[c] for c in (*by, "g", "e", "score")])

    def settle(batches: Iterator[pa.RecordBatch]):
        group, last, taken = None, None, set()
        for batch in batches:
            done = []
            for no, (*k, g, e) in enumerate(zip(*(batch.column(c).to_pylist() for c in (*by, "g", "e")))):
                if k != group:
                    group, last, taken = k, None, set()
                e = tuple(e.values()) if isinstance(e, dict) else e
                if g != last and e not in taken:
                    last = g
                    taken.add(e)
                    done.append(no)
            yield batch.take(pa.array(done, "int64"))

    return ordered.select(*by, "g", "e", "score").mapInArrow(settle, kept)


def greedy_text_matching(left: DataFrame, right: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """``greedy_matching`` by ``text_similarity`` within ``by``: (g, e, score). Sides have (*by, g, text) and (*by, e, text).

    One shuffle and one pass, one task a group. A task holds the right side of
    its group, the ``e`` in Arrow and the distinct texts with the counts of
    their characters; the left side streams by. No pairs are made: a text that
    has no equal partner is compared with those free ones whose characters and
    words allow a score above the best so far.
    """
    keys = [f"__by_{i}" for i in range(len(by))]
    group = [F.col(c).alias(k) for c, k in zip(by, keys)]
    text = N.plain_text(N.plain_text("text")).alias("text")  # tabs and line ends around a text are blanks after the first time, gone after the second
    rows = left.select(*group, "g", F.lit(None).cast(right.schema["e"].dataType).alias("e"), text, F.lit(True).alias("asks"))
    rows = rows.unionByName(right.select(*group, F.lit(None).cast(left.schema["g"].dataType).alias("g"), "e", text, F.lit(False).alias("asks")))
    ordered = rows.dropna(subset=keys).repartition(*keys).sortWithinPartitions(*keys, "asks", "g", "e")

    def settle(batches: Iterator[pa.RecordBatch]):
        last, options, held, texts = None, None, [], []
        for batch in batches:
            e = batch.column("e")
            asked, took, score = [], [e.slice(0, 0)], []
            rows = zip(*(batch.column(c).to_pylist() for c in (*keys, "asks")), strict=True)
            text = batch.column("text").to_pylist()
            for k, run in groupby(enumerate(rows), key=lambda x: x[1]):
                run = [no for no, _ in run]
                if k[:-1] != last:
                    last, options, held, texts = k[:-1], None, [], []
                if not k[-1]:
                    held.append(e.take(pa.array(run)))
                    texts += [text[no] for no in run]
                    continue
                if options is None:
                    options, held, texts = L.Options(texts, threshold), [pa.concat_arrays(held or [e.slice(0, 0)])], []
                hits = [(no, *hit) for no in run if (hit := options.take(text[no]))]
                asked += [no for no, _, _ in hits]
                took.append(held[0].take(pa.array([place for _, place, _ in hits], "int64")))
                score += [s for _, _, s in hits]
            yield pa.RecordBatch.from_arrays([batch.column("g").take(pa.array(asked, "int64")), pa.concat_arrays(took), pa.array(score, "float64")], names=["g", "e", "score"])

    kept = T.StructType([left.schema["g"], right.schema["e"], T.StructField("score", T.DoubleType())])
    return ordered.mapInArrow(settle, kept)


def first_similar(left: DataFrame, right: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """Each visit with the first epoch, in order of ``o``, whose name matches by ``names_match``: (visit, epoch).

    ``left`` has (*by, visit, name), ``right`` (*by, epoch, o, name).
    """
    a = materialize(left.select(*by, "visit", N.matching_form("name").alias("text")))
    b = materialize(right.select(*by, "epoch", "o", N.matching_form("name").alias("text")))
    met = alike_across(a, b, by, threshold).where(names_match(F.col("x"), F.col("y"), threshold))
    same = a.join(b.select(*by, "text"), [*by, "text"], "left_semi").select(*by, F.col("text").alias("x"), F.col("text").alias("y"))
    hit = met.unionByName(same).distinct().join(b.withColumnRenamed("text", "y"), [*by, "y"]).groupBy(*by, "x").agg(F.min_by("epoch", "o").alias("epoch"))
    return a.withColumnRenamed("text", "x").join(hit, [*by, "x"]).select("visit", "epoch")


def set_match_share(expected: DataFrame, actual: DataFrame, by: list[str], threshold: float = 0.8) -> DataFrame:
    """Share of expected texts with a similar actual one: (*by, expected, matched). Both have (*by, text).

    Texts are counted as they are written and compared in their plain form;
    a blank one or a placeholder is like another such one only, a null one
    counts as expected and is like none.
    """
    plain = lambda df: df.select(*by, "text", F.when(F.col("text").isNotNull(), N.plain_text("text")).alias("p"))
    e = materialize(plain(expected.select(*by, "text").distinct()))
    a = plain(actual.where("text IS NOT NULL")).select(*by, "p").distinct()
    met = alike_across(e.select(*by, F.col("p").alias("text")), a.select(*by, F.col("p").alias("text")), by, threshold, True)
    alike = met.where(text_similarity(F.col("x"), F.col("y")) >= threshold).select(*by, F.col("x").alias("p"))
    hit = alike.unionByName(a).distinct().withColumn("__hit", F.lit(1))
    return e.join(hit, [*by, "p"], "left").groupBy(*by).agg(F.count("*").alias("expected"), F.count("__hit").alias("matched"))


def jaccard_pairs(df: DataFrame, by: list[str], node: str, tokens: str, threshold: float) -> DataFrame:
    """Pairs of rows whose token sets have more than ``threshold`` in common: (*by, a, b), a < b.

    Prefix filter: tokens are ordered by how rare they are within ``by``; two
    sets that similar share one of their first n - ceil(threshold n) + 1 tokens,
    so only those are joined. Rows without tokens meet none.
    """
    rows = materialize(df.select(*by, F.col(node).alias("node"), F.array_distinct(tokens).alias("w")).where(F.size("w") > 0))
    single = rows.select(*by, "node", F.explode("w").alias("k"))
    rare = single.groupBy(*by, "k").agg(F.count("*").alias("f"))
    ordered = single.join(rare, [*by, "k"]).groupBy(*by, "node").agg(F.array_sort(F.collect_list(F.struct("f", "k"))).alias("o"))
    prefix = ordered.select(*by, "node", F.explode(F.slice("o", 1, (F.size("o") - F.ceil(F.size("o") * threshold) + 1).cast("int"))).alias("p")).select(*by, "node", "p.k")
    met = prefix.select(*by, F.col("node").alias("a"), "k").join(prefix.select(*by, F.col("node").alias("b"), "k"), [*by, "k"]).where("a < b").select(*by, "a", "b").distinct()
    side = lambda s: rows.select(*by, F.col("node").alias(s), F.col("w").alias(f"w_{s}"))
    full = met.join(side("a"), [*by, "a"]).join(side("b"), [*by, "b"])
    same = F.size(F.array_intersect("w_a", "w_b"))
    return full.where(same > threshold * (F.size("w_a") + F.size("w_b") - same)).select(*by, "a", "b")


def distinct_notes(df: DataFrame, by: list[str], node: str, text: str) -> DataFrame:
    """Each text with the earliest kept one it repeats: (node, leader), in order of the unique ``node``.

    A text repeats a kept one of its group if either contains the other or more
    than 0.8 of their words are shared. Equal texts repeat the same one, so only
    the first of them is compared. A text without letters and digits is empty
    and inside every other one.
    """
    rows = materialize(df.where(F.col(text).isNotNull()).select(*by, F.col(node).alias("node"), N.note_form(text).alias("t")))
    first = materialize(rows.groupBy(*by, "t").agg(F.min("node").alias("node")))
    words = first.withColumn("w", F.filter(F.split("t", " "), lambda x: x != ""))
    a = first.select(*by, F.col("t").alias("text"), F.col("node").alias("m"))
    b = first.select(*by, F.col("t").alias("key"), F.col("node").alias("n"))
    inside = K.containing_any(a, b, by, "text", "key").where("text <> key").join(a, [*by, "text"]).join(b, [*by, "key"])
    pairs = inside.select(*by, F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b")).unionByName(jaccard_pairs(words, by, "node", "w", 0.8).select(*by, "a", "b"))
    leaders = greedy_leaders(first.select(*by, "node"), pairs, by)
    same = rows.join(first.withColumnRenamed("node", "first"), [*by, "t"]).select("node", "first")
    return same.join(leaders.withColumnRenamed("node", "first"), "first").select("node", "leader")
