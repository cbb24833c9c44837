"""Rows out of text: patterns as data, all of them applied in one projection.

The matches of every pattern become arrays, joined and exploded once; texts
are read once whatever the number of patterns, and no pattern table is joined.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import patterns as P
from tessera.functions import timing as T


def _ci(pattern: str) -> str:
    return "(?i)" + pattern


def matches(df: DataFrame, keys: list[str], patterns: list[tuple[str, str]], groups: int = 0, text: str = "text", context: int | None = None) -> DataFrame:
    """One row per match: (*keys, kind, pattern_no, match_no, found, g1, g2[, start, context]).

    ``patterns`` are (pattern, kind); case doesn't count. ``groups`` groups of
    each are taken, as far as it has them. With ``context`` come the place of
    the match, from 0, and the text from so many characters before it to so
    many after it. Null texts give no rows. Texts without any match are
    dropped by one test before the matches are laid out.
    """
    none = F.lit(None).cast("string")
    names = ("found", "g1", "g2")

    def cell(no: int, kind: str, have: int):
        def one(x, i):
            out = [
                F.lit(kind).alias("kind"), F.lit(no).alias("pattern_no"), i.alias("match_no"), x["found"].alias("found"),
                (x["g1"] if have >= 1 else none).alias("g1"), (x["g2"] if have >= 2 else none).alias("g2"),
            ]
            if context is not None:
                at = x["start"]
                first = F.greatest(F.lit(0), at - context)
                out += [at.alias("start"), F.col(text).substr(first + 1, at + F.length(x["found"]) + context - first).alias("context")]
            return F.struct(*out)

        return one

    parts = []
    for no, (p, kind) in enumerate(patterns):
        have = min(groups, re.compile(p).groups)
        arrays = [F.regexp_extract_all(text, F.lit(_ci(p)), F.lit(g)).alias(n) for g, n in list(enumerate(names))[: have + 1]]
        # whatever is worked out per text is an argument of the transform, not part of its lambda
        structs = _zip(arrays) if context is None else _with(_zip(arrays), starts(F.col(text), p, arrays[0]), "start")
        parts.append(F.transform(structs, cell(no, kind, have)))
    some = df.where(F.col(text).rlike("(?i)" + "|".join(f"(?:{p})" for p, _ in patterns)))
    return some.select(*keys, F.explode(F.concat(*parts)).alias("m")).select(*keys, "m.*")


def starts(text: Column, pattern: str, found: Column) -> Column:
    """Where each match begins, from 0: what stands between the matches adds up to their places."""
    between = F.split(text, _ci(pattern), -1)
    steps = F.filter(F.zip_with(between, found, lambda b, f: F.struct(F.length(b).alias("b"), F.length(f).alias("f"))), lambda s: s["f"].isNotNull())
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, s: F.struct((acc["at"] + s["b"] + s["f"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + s["b"])).alias("out"))
    return F.aggregate(steps, none, step, lambda acc: acc["out"])


def interval_unit(pattern: str) -> str:
    """H for patterns that speak of hours, else M."""
    return "H" if "hour" in pattern or "hr" in pattern or pattern.endswith("h") else "M"


def interval(g1: Column, unit: Column) -> tuple[Column, Column]:
    """(interval as ISO text, number of observations) of what a pattern took.

    One amount is the interval. A list of times is so many observations, as
    many minutes apart as its first two; a list with anything but whole numbers
    says nothing.
    """
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    parts = F.transform(F.split(g1, ","), lambda x: trim(x))
    whole = F.forall(parts, lambda x: x.rlike(r"^\d+$"))
    times = F.transform(parts, lambda x: x.try_cast("bigint"))
    listed = g1.contains(",")
    step = F.concat(F.lit("PT"), (F.get(times, F.lit(1)) - F.get(times, F.lit(0))).cast("string"), F.lit("M"))
    single = F.when(trim(g1).rlike(r"^\d+$"), F.concat(F.lit("PT"), trim(g1).try_cast("bigint").cast("string"), unit))
    return F.when(listed, F.when(whole, step)).otherwise(single), F.when(listed & whole, F.size(times))


def daily_bindings(df: DataFrame, keys: list[str]) -> DataFrame:
    """Daily collections with each range of days near them: (*keys, activity, pattern_no, match_no, activity_name, range_no, expected, start_iso, end_iso)."""
    near = F.lit(_ci(P.NEARBY_RANGE))
    found = matches(df, keys, P.DAILY_COLLECTIONS, context=200)
    days = _zip([F.regexp_extract_all("context", near, F.lit(g)) for g in (0, 1, 2)])
    rows = found.select(*keys, "kind", "pattern_no", "match_no", "found", F.posexplode(days).alias("range_no", "r"))
    a, b = (T.signed_day(F.col(f"r.{g}")).cast("bigint") for g in ("g1", "g2"))
    iso = lambda x: F.concat(F.when(x < 0, "-P").otherwise("P"), F.abs(x).cast("string"), F.lit("D"))
    return rows.select(
        *keys, F.col("kind").alias("activity"), "pattern_no", "match_no", F.col("found").alias("activity_name"), "range_no", (F.abs(b - a) + 1).alias("expected"), iso(a).alias("start_iso"), iso(b).alias("end_iso")
    )


def samplings(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sampling schedules and densities: (*keys, kind, pattern_no, match_no, found, samples, unit).

    ``pk`` and ``glucose`` schedules have three times or more, a ``minimum`` is
    from 2 to 50 samples; ``dense`` and ``sparse`` are marks without a number.
    """
    m, kind, low = matches(df, keys, P.SAMPLINGS, 1), F.col("kind"), F.lower("found")
    listed = kind.isin("pk", "glucose")
    samples = F.when(listed, F.size(F.split("g1", ",")).cast("bigint")).when(kind == "minimum", F.col("g1").try_cast("bigint"))
    hours = low.contains("hour") | low.contains(" h")
    unit = F.when(kind == "glucose", "minutes").when(kind == "pk", F.when(hours, "hours").otherwise("minutes"))
    out = m.select(*keys, "kind", "pattern_no", "match_no", "found", samples.alias("samples"), unit.alias("unit"))
    return out.where(kind.isin("dense", "sparse") | (listed & (F.col("samples") >= 3)) | ((kind == "minimum") & F.col("samples").between(2, 50)))


def _then(note, layout: str, tidy):
    return lambda label, body: note(layout, label, tidy(body))


def _fits_but(fits, heading: str):
    return lambda x: fits(x["footnote"]) & ~x["footnote"].rlike(heading)


def footnote_layouts(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Footnotes of every layout in the order of the layouts: (*keys, pos, layout, label, footnote).

    Lettered, bracketed, superscript and numbered notes, then the parts of
    sections that are headed as notes or begin with a letter. White space is
    one blank; texts of up to 15 or of 800 characters and more are none. A part
    without a label is called by its place in the list.
    """
    c = F.col(text)
    tidy = lambda x: F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), r"\s+", " ")
    note = lambda layout, label, body: F.struct(F.lit(layout).alias("layout"), label.alias("label"), body.alias("footnote"))
    fits = lambda x: (F.length(x) > 15) & (F.length(x) < 800)
    lists = []
    for layout, p, mark in P.FOOTNOTE_LAYOUTS:
        label = F.regexp_extract_all(c, F.lit(p), F.lit(1))
        shown = {"[": lambda x: F.concat(F.lit("["), x, F.lit("]")), "^": lambda x: F.concat(F.lit("^"), x), "": lambda x: x}[mark]
        found = F.zip_with(F.transform(label, shown), F.regexp_extract_all(c, F.lit(p), F.lit(2)), _then(note, layout, tidy))
        heading = "^(?:Table|Figure|Section)" if layout == "numbers" else "^$"
        lists.append(F.filter(found, _fits_but(fits, heading)))
    for p in P.FOOTNOTE_SECTIONS:
        parts = F.transform(F.split(F.regexp_extract(c, p, 1), r"\n(?=[a-z][.)])"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
        kept = F.filter(parts, fits)
        label = lambda x: T.group(x, r"^([a-z])[.)]", 1)
        found = F.transform(kept, lambda x: note("section", label(x), tidy(F.when(label(x).isNull(), x).otherwise(F.regexp_replace(x, r"^[a-z][.)]\s*", "")))))
        lists.append(F.filter(found, lambda x: x["footnote"] != ""))
    out = df.where(c.isNotNull()).select(*keys, F.posexplode(F.concat(*lists)).alias("pos", "n"))
    return out.select(*keys, "pos", "n.layout", F.coalesce("n.label", F.concat(F.lit("fn_"), (F.col("pos") + 1).cast("string"))).alias("label"), "n.footnote")


def _zip(arrays: list[Column]) -> Column:
    """Arrays of one length as an array of structs with the fields found, g1, g2."""
    out = F.transform(arrays[0], lambda x: F.struct(x.alias("found")))
    for name, a in zip(("g1", "g2"), arrays[1:]):
        out = _with(out, a, name)
    return out


def _with(structs: Column, values: Column, name: str) -> Column:
    return F.zip_with(structs, values, lambda s, v: s.withField(name, v))


def first_match(c: Column, pattern: str) -> Column:
    # one pass; a pattern never matches nothing, so an empty result is no match
    return F.nullif(F.regexp_extract(c, _ci(pattern), 0), F.lit(""))


def anchors(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The first hit of each anchor type, patterns in their order: (*keys, anchor_type, found, rank)."""
    cells = []
    for rank, kind in enumerate(P.ANCHOR_ORDER, 1):
        hits = [first_match(F.col(text), p) for p, k in P.ANCHORS if k == kind]
        cells.append(F.struct(F.lit(kind).alias("anchor_type"), F.coalesce(*hits).alias("found"), F.lit(rank).alias("rank")))
    return df.select(*keys, F.explode(F.array(*cells)).alias("a")).select(*keys, "a.*").where("found IS NOT NULL")


def classify(c: Column | str, rules: list[tuple[str, str]], default: str) -> Column:
    """The class of the first pattern that is found in the lower-cased text."""
    low = F.lower(F.col(c) if isinstance(c, str) else c)
    return reduce(lambda w, pk: w.when(low.rlike(pk[0]), pk[1]), rules, F.when(F.lit(False), "")).otherwise(default)


def structured_condition(text: Column | str, kind: Column) -> Column:
    """A condition as an expression; null where its class has none. Hours stay hours."""
    low = F.lower(F.col(text) if isinstance(text, str) else text)
    amount = r"(\d+)\s*(min(?:ute)?s?|hours?)\s+(?:{})\s+(.+)"
    unit = lambda p: F.when(F.regexp_extract(low, p, 2).startswith("h"), "H").otherwise("M")
    timing = lambda word, p: F.when(low.rlike(p), F.concat(F.lit(f"timing.{word}("), F.trim(F.regexp_extract(low, p, 3)), F.lit(", PT"), F.regexp_extract(low, p, 1), unit(p), F.lit(")")))
    before, after = amount.format(r"before|prior\s+to"), amount.format("after|following")
    age = r"(?:age[d]?\s+)?(\d+)\s*(?:years?|and\s+older)"
    fast = r"(\d+)[\-\s]?hour\s*fast"
    return (
        F.when(kind.startswith("timing"), F.coalesce(timing("before", before), timing("after", after)))
        .when(
            kind.startswith("eligibility"),
            F.when(low.contains("childbearing") | low.contains("reproductive"), "subject.sex == 'Female' AND subject.isOfChildbearingPotential == true")
            .when(low.rlike(age), F.concat(F.lit("subject.age >= "), F.regexp_extract(low, age, 1))),
        )
        .when(kind == "procedure_replicate", F.when(low.contains("triplicate"), "procedure.replicates = 3").when(low.contains("duplicate"), "procedure.replicates = 2"))
        .when(kind == "procedure_fasting", F.when(low.rlike(fast), F.concat(F.lit("subject.fastingHours >= "), F.regexp_extract(low, fast, 1))).otherwise("subject.isFasting == true"))
    )


def is_footnote(c: Column | str) -> Column:
    """A text that may be a footnote: long enough, no header or table cell, with a telling word or long."""
    x = F.col(c) if isinstance(c, str) else c
    low = F.trim(F.lower(x))
    starts = reduce(lambda a, b: a | b, [low.startswith(s) for s in P.NOISE_STARTS])
    telling = reduce(lambda a, b: a | b, [low.contains(w) for w in P.FOOTNOTE_WORDS])
    shouting = (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) > 20)
    digits = F.length(x) - F.length(F.regexp_replace(x, "[0-9]", ""))
    return (F.length(low) >= 15) & ~shouting & ~starts & ~(digits * 2 > F.length(x)) & ~low.rlike(r"^[\[\(]?\d+[\]\)]?\.?\s*$") & (telling | (F.length(x) > 50))


def is_prose_fragment(c: Column | str) -> Column:
    """A piece of a sentence rather than a name; null and blank are."""
    x = F.lower(F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))))
    starts = reduce(lambda a, b: a | b, [x.startswith(s) for s in P.PROSE_STARTS])
    words = reduce(lambda a, b: a | b, [x.contains(w) for w in P.PROSE_WORDS])
    return (F.length(x) < 3) | starts | x.isin(P.STOP_ONLY) | x.rlike(r"^\d+\s*(mg|ml|mcg|g|kg|iu)?\s*(and|or)?$") | x.rlike(r"^(day|week|month)\s*(and|or|$)") | words


def pattern_score(c: Column | str, patterns: list[str]) -> Column:
    """How many of the patterns are found in the lower-cased text."""
    low = F.lower(F.col(c) if isinstance(c, str) else c)
    return reduce(lambda a, b: a + b, [low.rlike(p).cast("int") for p in patterns])


def footnote_blocks(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Footnotes out of text lines: (*keys, label, footnote).

    A line with a label (``a.``, ``a)``, ``1.``) starts one, the lines after it
    belong to it up to a blank line, a new label or a heading; of one label the
    last one counts.
    """
    from pyspark.sql import Window

    label = T.group(F.col("line"), r"^\s*([a-z]|\d{1,2})[.)]\s+\S", 1)
    stop = (F.trim("line") == "") | F.col("line").rlike(r"^(?:Page \d+|Abbreviations:)")
    w = Window.partitionBy(*keys).orderBy("line_no")
    marked = lines.withColumn("label", label).withColumn("block", F.sum(F.when(F.col("label").isNotNull() | stop, 1).otherwise(0)).over(w))
    body = F.trim(F.regexp_replace("line", r"^\s*(?:[a-z]|\d{1,2})[.)]\s+", ""))
    parts = marked.where(~stop).groupBy(*keys, "block").agg(F.max("label").alias("label"), F.array_sort(F.collect_list(F.struct("line_no", F.when(F.col("label").isNotNull(), body).otherwise(F.trim("line")).alias("t")))).alias("x"))
    notes = parts.where("label IS NOT NULL").select(*keys, "label", "block", F.array_join(F.transform("x", lambda x: x["t"]), " ").alias("footnote"))
    return notes.groupBy(*keys, "label").agg(F.max_by("footnote", "block").alias("footnote"))
