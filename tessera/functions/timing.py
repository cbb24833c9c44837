"""Days, weeks, durations and windows out of names and texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.keys import col

#: Patterns of time points in the order they are tried; a template with groups.
TIMEPOINTS = [
    (r"(?i)Day\s+([_-]?\d+)\s+through\s+([_-]?\d+)", "day_range_{}_to_{}"),
    (r"(?i)Day\s+([_-]?\d+)\s+to\s+([_-]?\d+)", "day_range_{}_to_{}"),
    (r"\(([_-]?\d+)\s+to\s+([_-]?\d+)\)", "day_range_{}_to_{}"),
    (r"(?i)\(Day\s+([_-]?\d+)\)", "day_{}"),
    (r"(?i)Day\s+([_-]?\d+)", "day_{}"),
    (r"(?i)Week\s+(\d+)", "week_{}"),
    (r"\(([_-]?\d+)\)", "day_{}"),
]
DEFAULT_WINDOWS = {
    "screening": (7, 0), "baseline": (1, 1), "day 1": (0, 0), "randomization": (0, 0), "follow-up": (7, 7), "end of study": (3, 7),
    "end of treatment": (3, 3), "early termination": (0, 0),
}
OTHER_WINDOW = (3, 3)
VISIT_SYNONYMS = {
    "end of treatment": ["eot", "end of treatment", "end-of-treatment", "treatment end"],
    "end of study": ["eos", "end of study", "end-of-study", "study end", "study completion"],
    "early termination": ["et", "early termination", "early withdrawal", "discontinuation"],
}
OPTIONAL_WORDS = ["optional", "if applicable", "as needed", "prn", "unscheduled"]
EVENT_VISITS = ["early termination", "et visit", "withdrawal", "end of treatment", "eot", "end-of-treatment", "end of study", "eos", "end-of-study", "unscheduled"]
FIXED_DAYS = {"screening": -14, "baseline": 0, "randomization": 1, "follow": 365}
ALLOWANCES = [
    (r"(?i)±\s*(\d+)\s*days?", 1),
    (r"(?i)\+[\s/]*-\s*(\d+)\s*days?", 1),
    (r"(?i)within\s*(\d+)\s*days?", 1),
    (r"(?i)[\-−]\s*(\d+)\s*(?:days?)?\s*(?:to|through|and)\s*\+?\s*(\d+)\s*days?", 2),
    (r"(?i)window\s*(?:of|:)?\s*(\d+)\s*days?", 1),
    (r"(?i)(\d+)[\-\s]?day\s+window", 1),
    (r"(?i)(?:allowable|allowed)\s+(?:deviation|variance)[:\s]+(\d+)\s*days?", 1),
]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def group(c: Column, pattern: str, n: int = 1) -> Column:
    """A group of the first match; null where there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, n))


def first_int(c: Column, pattern: str, n: int = 1) -> Column:
    return group(c, pattern, n).try_cast("int")


def timepoint(c: Column | str) -> Column:
    """The time point a visit name speaks of, in one form; underscores are minus signs. Null if there is none."""
    x = col(c)
    out = []
    for pattern, template in TIMEPOINTS:
        parts = template.split("{}")
        values = [F.replace(F.regexp_extract(x, pattern, i + 1), F.lit("_"), F.lit("-")) for i in range(len(parts) - 1)]
        pieces = [F.lit(parts[0])]
        for v, p in zip(values, parts[1:]):
            pieces += [v, F.lit(p)]
        out.append(F.when(x.rlike(pattern), F.concat(*pieces)))
    inner = F.trim(F.replace(F.regexp_extract(x, r"\(([^)]{2,})\)", 1), F.lit("_"), F.lit("-")))
    relative = F.when(x.rlike(r"\([^)]{2,}\)"), F.concat(F.lit("rel_"), F.regexp_replace(inner, r"\s+", "_")))
    return F.coalesce(*out, relative)


def name_timing(c: Column | str) -> Column:
    """struct(day, week, month) that a name states."""
    x = F.lower(col(c))
    return F.struct(
        F.coalesce(first_int(x, r"day\s*(-?\d+)"), first_int(x, r"\bd(-?\d+)")).alias("day"),
        F.coalesce(first_int(x, r"week\s*(\d+)"), first_int(x, r"wk\s*(\d+)")).alias("week"),
        first_int(x, r"month\s*(\d+)").alias("month"),
    )


def signed_day(c: Column | str) -> Column:
    """A day with any kind of dash as its sign; 0 where there are no digits."""
    x = F.translate(F.coalesce(col(c), F.lit("")), "–−—", "---")
    digits = F.regexp_extract(x, r"(\d+)", 1)
    sign = F.when(x.rlike(r"-\s*\d"), -1).otherwise(1)
    return F.coalesce(sign * digits.try_cast("int"), F.lit(0))


def iso_duration(value: Column, unit: Column | str = "days") -> Column:
    """ISO 8601 text of a signed amount; null is no time at all, unknown units are days."""
    u = F.lower(F.lit(unit) if isinstance(unit, str) else unit)
    amount = F.abs(value).cast("bigint").cast("string")
    body = (
        F.when(u.isin("weeks", "week", "w"), F.concat(F.lit("P"), amount, F.lit("W")))
        .when(u.isin("hours", "hour", "h"), F.concat(F.lit("PT"), amount, F.lit("H")))
        .when(u.isin("minutes", "minute", "min", "m"), F.concat(F.lit("PT"), amount, F.lit("M")))
        .otherwise(F.concat(F.lit("P"), amount, F.lit("D")))
    )
    return F.when(value.isNull(), "P0D").otherwise(F.concat(F.when(value < 0, "-").otherwise(""), body))


def default_window(c: Column | str) -> Column:
    """struct(before, after) that is usual for a kind of visit."""
    x = F.lower(col(c))
    pick = lambda i: reduce(lambda w, kv: w.when(x.contains(kv[0]), kv[1][i]), DEFAULT_WINDOWS.items(), F.when(F.lit(False), 0)).otherwise(OTHER_WINDOW[i])
    return F.struct(pick(0).alias("before"), pick(1).alias("after"))


def window_allowance(c: Column | str) -> Column:
    """struct(before, after) that a text states, the first of the patterns that fits; 0 where none does."""
    x = col(c)
    side = lambda i: F.coalesce(*[first_int(x, p, min(i, n)) for p, n in ALLOWANCES], F.lit(0))
    return F.struct(side(1).alias("before"), side(2).alias("after"))


def visit_timing(name: Column | str, context: Column | str) -> Column:
    """struct(day, week) of a visit: from its name, by its kind, else from the text around it. Event visits have none."""
    n, low = col(name), F.lower(col(name))
    day, week = r"(?i)Day\s*(\d+)", r"(?i)Week\s*(\d+)"
    own_day, own_week = first_int(n, day), first_int(n, week)
    there_day, there_week = first_int(col(context), day), first_int(col(context), week)
    event = reduce(lambda a, b: a | b, [low.contains(w) for w in EVENT_VISITS])
    none = F.lit(None).cast("int")
    d = F.when(own_day.isNotNull(), own_day).when(own_week.isNotNull(), (own_week - 1) * 7 + 1).when(event, none)
    w = F.when(own_day.isNotNull(), none).when(own_week.isNotNull(), own_week).when(event, none)
    for k, v in FIXED_DAYS.items():
        d, w = d.when(low.contains(k), v), w.when(low.contains(k), none)
    return F.struct(d.otherwise(F.coalesce(there_day, (there_week - 1) * 7 + 1)).alias("day"), w.otherwise(there_week).alias("week"))


def visit_form(c: Column | str) -> Column:
    """A visit name without a bracketed or described end, synonyms as one."""
    x = F.regexp_replace(F.trim(F.lower(col(c))), r"\s*\([^)]+\)\s*$", "")
    x = F.trim(F.regexp_replace(x, r"\s*[-/]\s*(discharge|start|return|end|visit).*$", ""))
    return reduce(lambda w, kv: w.when(x.isin(kv[1]), kv[0]), VISIT_SYNONYMS.items(), F.when(F.lit(False), "")).otherwise(x)


def is_required_visit(context: Column | str) -> Column:
    """False where the text around a visit calls it optional."""
    x = F.lower(col(context))
    return ~reduce(lambda a, b: a | b, [x.contains(w) for w in OPTIONAL_WORDS])


def iso_date(c: Column | str) -> Column:
    """A date as YYYY-MM-DD, day before month where that is open; a text that is no date stays as it is."""
    x = F.trim(col(c))
    month = lambda name: F.lpad(reduce(lambda w, im: w.when(F.lower(F.substring(name, 1, 3)) == im[1], str(im[0])), enumerate(MONTHS, 1), F.when(F.lit(False), "")), 2, "0")
    join = lambda y, m, d: F.concat_ws("-", y, m, F.lpad(d, 2, "0"))
    forms = [
        (r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$", lambda g: (g(3), month(g(2)), g(1))),
        (r"^([A-Za-z]+)\s+(\d{1,2}),?\s+(\d{4})$", lambda g: (g(3), month(g(1)), g(2))),
        (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", lambda g: (g(3), F.lpad(g(2), 2, "0"), g(1))),
        (r"^(\d{4})/(\d{2})/(\d{2})$", lambda g: (g(1), g(2), g(3))),
    ]
    out = F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), x)
    for pattern, parts in forms:
        y, m, d = parts(lambda i, p=pattern: F.regexp_extract(x, p, i))
        out = out.when(x.rlike(pattern) & m.isNotNull(), join(y, m, d))
    return out.otherwise(F.nullif(x, F.lit("")))


def dose_range(c: Column | str) -> Column:
    """struct(low, high): a dose or the two ends of a range; the first number of other text, 0 where there is none."""
    x = F.trim(col(c))
    pattern = r"^(\d+(?:\.\d+)?)\s*[-–]\s*(\d+(?:\.\d+)?)"
    ranged = x.rlike(pattern)
    number = F.regexp_extract(x, r"(\d+(?:\.\d+)?)", 1)
    low = F.when(ranged, F.regexp_extract(x, pattern, 1).try_cast("double")).otherwise(F.coalesce(x.try_cast("double"), number.try_cast("double"), F.lit(0.0)))
    return F.struct(low.alias("low"), F.when(ranged, F.regexp_extract(x, pattern, 2).try_cast("double")).alias("high"))
