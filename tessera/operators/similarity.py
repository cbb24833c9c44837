"""How alike two records of one type are, by the rules of the type.

Each rule looks at what tells records of the type apart (numbers of days,
doses, identifiers, telling words); where none applies the texts are compared.
All but that last step are column expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.operators.fuzzy import text_similarity

#: Words that two records of a type have in common, tried in this order.
VISIT_WORDS = ["screening", "baseline", "treatment", "follow", "end", "visit"]
EPOCH_WORDS = ["screening", "treatment", "follow", "baseline", "washout", "titration", "inpatient", "outpatient"]
TIMING_WORDS = ["screening", "baseline", "treatment", "follow", "end", "visit", "day"]
DISEASE_WORDS = ["wilson", "diabetes", "cancer", "disease", "syndrome", "disorder"]
#: What an epoch's name may be called in the other record.
EPOCH_SHORT = {
    "check in": ["c-i", "checkin", "check-in"],
    "follow-up": ["follow up", "followup", "eos", "end of study"],
    "treatment": ["inpatient", "op", "outpatient"],
}

Text = Callable[[Column, Column], Column]


def _get(record: dict[str, Column], *fields: str) -> Column:
    """The fields, one after the other, as one plain text."""
    return N.plain_text(F.concat_ws(" ", *[F.coalesce(record.get(f, F.lit("")), F.lit("")) for f in fields]))


def _numbers(text: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def _common_word(a: Column, b: Column, words: list[str]) -> Column:
    return reduce(lambda x, y: x | y, [a.contains(w) & b.contains(w) for w in words])


def _there(a: Column, b: Column) -> Column:
    return (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")


def _criterion(g: dict, e: dict, text: Text) -> Column:
    same = _there(g["identifier"], e["identifier"]) & (g["identifier"] == e["identifier"])
    return F.when(same & (_get(g, "category") == _get(e, "category")), 1.0).when(same, 0.9).otherwise(0.0)


def _encounter(g: dict, e: dict, text: Text) -> Column:
    a, b = _get(g, "name", "label"), _get(e, "name")
    days = F.arrays_overlap(_numbers(a, r"day\s*(-?\d+)"), _numbers(b, r"(-?\d+)"))
    return F.when(days, 0.9).when(_common_word(a, b, VISIT_WORDS), 0.8).otherwise(text(a, b))


def _epoch(g: dict, e: dict, text: Text) -> Column:
    a, b = (F.trim(F.regexp_replace(x, r"\s+[a-z]$", "")) for x in (_get(g, "name", "label"), _get(e, "name")))
    short = reduce(lambda x, y: x | y, [a.contains(k) & b.contains(s) for k, v in EPOCH_SHORT.items() for s in v])
    return F.when(_common_word(a, b, EPOCH_WORDS), 0.85).when(a.startswith(b) | b.startswith(a) | short, 0.8).otherwise(text(a, b))


def _arm(g: dict, e: dict, text: Text) -> Column:
    a, b = _get(g, "description", "name", "label"), _get(e, "description", "name")
    doses = F.size(F.array_intersect(_numbers(a, r"(\d+)\s*mg"), _numbers(b, r"(\d+)\s*mg")))
    kinds = _get(g, "type").contains("arm") & _get(e, "type").contains("arm")
    return F.when(doses >= 2, 0.95).when(doses == 1, 0.85).when(_common_word(a, b, ["treatment"]), 0.8).when(kinds, 0.75).otherwise(text(a, b))


def _indication(g: dict, e: dict, text: Text) -> Column:
    a, b = _get(g, "name", "description"), _get(e, "name", "description")
    return F.when(_common_word(a, b, DISEASE_WORDS), 0.85).otherwise(text(a, b))


def _timing(g: dict, e: dict, text: Text) -> Column:
    a, b = _get(g, "valueLabel", "label"), _get(e, "valueLabel", "label")
    days = F.arrays_overlap(_numbers(a, r"(\d+)"), _numbers(b, r"(\d+)"))
    same = _there(g["value"], e["value"]) & (g["value"] == e["value"])
    return F.when(same, 0.9).when(days, 0.8).when(_common_word(a, b, TIMING_WORDS), 0.75).otherwise(text(a, b))


def _abbreviation(g: dict, e: dict, text: Text) -> Column:
    a, b, x, y = _get(g, "abbreviatedText"), _get(e, "abbreviatedText"), _get(g, "expandedText"), _get(e, "expandedText")
    return F.when(_there(a, b) & (a == b), 1.0).when(_there(x, y), text(x, y)).otherwise(text(a, b))


RULES = {
    "eligibility_criterion": _criterion, "encounter": _encounter, "epoch": _epoch, "study_arm": _arm, "indication": _indication, "timing": _timing, "abbreviation": _abbreviation,
}


def typed_similarity(kind: str, golden: dict[str, Column], found: dict[str, Column], text: Text = text_similarity) -> Column:
    """Similarity of two records of a type, from 0 to 1, the golden one leading.

    Records are columns by field; a missing or null field is an empty text.
    ``text`` compares two texts where no rule of the type applies, and for the
    types that have none: there the first of text, name and description counts.
    """
    rule = RULES.get(kind)
    if rule:
        blank = F.lit(None).cast("string")
        filled = [{f: r.get(f, blank) for f in ("identifier", "value")} | r for r in (golden, found)]
        return rule(*filled, text)
    first = lambda r: N.plain_text(F.coalesce(*[F.when(r[f] != "", r[f]) for f in ("text", "name", "description") if f in r], F.lit("")))
    return text(first(golden), first(found))
