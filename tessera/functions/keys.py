"""Key and text forms shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def same_id(c: Column | str) -> Column:
    """Ids are one and the same when equal in this form; null stays null."""
    return F.translate(F.lower(F.trim(col(c))), "-", "_")


def is_blank(c: Column | str) -> Column:
    """True for null, empty or blanks only."""
    return F.coalesce(F.trim(col(c)) == "", F.lit(True))


def plain_space(c: Column | str) -> Column:
    """Runs of blank, tab, CR, LF and no-break space become one blank; trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), "[ \\t\\r\\n\\u00A0]+", " "))


def digest(c: Column | str) -> list[Column]:
    """128 bits of a value as two longs, from two seeds; nulls have their own digest."""
    null = col(c).isNull()
    return [F.xxhash64(null, col(c)), F.xxhash64(F.lit("second"), null, col(c))]


def words(c: Column | str) -> Column:
    """The maximal runs of a-z0-9 in the lower-cased text, as an array; null gives an empty one."""
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
