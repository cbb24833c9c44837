"""Ordered keyword rules as one expression.

A ladder is a list of rules tried in order; the first that holds gives the
result. It is data, so that it plans to a single CASE inside generated code.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One step: text contains one of ``any``, all of ``every``, none of ``but``, is one of ``equal``, or matches ``like``."""

    result: object
    any: tuple[str, ...] = ()
    every: tuple[str, ...] = ()
    but: tuple[str, ...] = ()
    equal: tuple[str, ...] = ()
    like: str = ""

    def column(self, text: Column) -> Column:
        tests = []
        if self.any:
            tests.append(reduce(lambda a, b: a | b, [text.contains(x) for x in self.any]))
        tests += [text.contains(x) for x in self.every]
        tests += [~text.contains(x) for x in self.but]
        if self.equal:
            tests.append(text.isin(list(self.equal)))
        if self.like:
            tests.append(text.rlike(self.like))
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class Ladder:
    """Rules over the lower-cased text; ``blank`` is the result for null and empty, ``default`` where no rule holds."""

    rules: tuple[Rule, ...]
    default: object = None
    blank: object = None

    def column(self, c: Column | str) -> Column:
        raw = F.col(c) if isinstance(c, str) else c
        text = F.lower(raw)
        out = F.when(F.coalesce(raw, F.lit("")) == "", F.lit(self.blank))
        for r in self.rules:
            out = out.when(r.column(text), F.lit(r.result))
        return out.otherwise(F.lit(self.default)).cast("string")


def keywords(table: dict[str, object], default: object = None, blank: object = None) -> Ladder:
    """A ladder of 'contains this keyword' rules in the order of the table."""
    return Ladder(tuple(Rule(v, any=(k,)) for k, v in table.items()), default, blank)


def exact(table: dict[str, object], default: object = None, blank: object = None) -> Ladder:
    """A ladder of 'is this word' rules."""
    return Ladder(tuple(Rule(v, equal=(k,)) for k, v in table.items()), default, blank)
