"""Names and texts brought into comparable forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.keys import col

#: Superscript characters and what they stand for, in one order.
SUPERSCRIPTS = "⁰¹²³⁴⁵⁶⁷⁸⁹ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻ"
PLAIN = "0123456789abcdefghijklmnoprstuvwxyz"
SYMBOL_WORDS = {"†": "dagger", "‡": "double_dagger", "§": "section", "*": "asterisk", "※": "reference"}
MARKS = "*†‡§¶#"
TRAILING_MARKS = [r"\s*[*†‡§¶#]+\s*$", r"\s*\[\d+\]\s*$", r"\s*\(\d+\)\s*$", r"\s*[a-z]\)\s*$", r"[*†‡§¶#]+"]
LETTER_SUFFIXES = [r"(?i)\s+[a-z]$", r"(?i)\s+[a-z]\.$", r"(?i)\s*\([a-z]\)$", r"(?i)\s*\[[a-z]\]$"]
TIMING_SUFFIXES = [r"(?i)\s*\((?:Day|Week|Month|Visit|Hour|Year)\s*[-\d]+.*?\)\s*$", r"(?i)\s*[-–]\s*(?:Day|Week|Month|Visit)\s*[-\d]+.*$"]
PLACEHOLDERS = ["tbd", "-", "n/a", "none", "unknown", ""]
STOP_WORDS = ["and", "or", "the", "a", "an", "of", "for", "in", "to", "with", "at", "by", "on"]


def drop_each(c: Column, patterns: list[str]) -> Column:
    """The patterns removed one after the other."""
    return reduce(lambda x, p: F.regexp_replace(x, p, ""), patterns, c)


def one_space(c: Column) -> Column:
    """White space runs as one blank, outer ones gone."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_name(c: Column | str) -> Column:
    """A name without footnote marks: trailing symbols, [n], (n), x) and symbols inside."""
    return one_space(drop_each(one_space(col(c)), TRAILING_MARKS))


def clean_name_letters(c: Column | str) -> Column:
    """A name without a footnote letter at its end, plain, dotted or bracketed."""
    return one_space(drop_each(F.trim(col(c)), LETTER_SUFFIXES))


def footnote_letters(c: Column | str) -> Column:
    """Footnote letters at the end of a name, the bare one before the bracketed one."""
    bare = F.nullif(F.regexp_extract(col(c), r"\s+([a-z])\.?$", 1), F.lit(""))
    bracketed = F.nullif(F.regexp_extract(col(c), r"\(([a-z])\)$", 1), F.lit(""))
    return F.array_compact(F.array(bare, bracketed))


def matching_form(c: Column | str) -> Column:
    """Lower case, letters, digits, blanks and hyphens only."""
    return one_space(F.regexp_replace(F.lower(col(c)), r"[^a-z0-9\s\-]", ""))


def split_superscripts(c: Column | str) -> Column:
    """struct(clean, refs): the name without superscripts and symbols, and what they stand for, in order."""
    chars = F.filter(F.split(col(c), ""), lambda x: F.lit(SUPERSCRIPTS + "".join(SYMBOL_WORDS)).contains(x) & (x != ""))
    as_word = lambda x: reduce(lambda w, kv: w.when(x == kv[0], kv[1]), SYMBOL_WORDS.items(), F.when(F.lit(False), "")).otherwise(F.translate(x, SUPERSCRIPTS, PLAIN))
    return F.struct(
        F.trim(F.translate(col(c), SUPERSCRIPTS + "".join(SYMBOL_WORDS), "")).alias("clean"), F.transform(chars, as_word).alias("refs")
    )


def strip_superscripts(c: Column | str) -> Column:
    return F.trim(F.translate(col(c), SUPERSCRIPTS, ""))


def drop_timing(c: Column | str) -> Column:
    """A name without a timing that got mixed into its end."""
    return F.trim(drop_each(F.trim(col(c)), TIMING_SUFFIXES))


def standard_id(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("-"), F.lit("_"))


def epoch_form(c: Column | str) -> Column:
    """An epoch name for comparison: no super- or subscripts and marks, hyphens as blanks, lower case."""
    bare = F.regexp_replace(col(c), r"[¹²³⁰-⁹₀-₉*†‡§¶ᵃ-ᵛ]", "")
    return F.lower(one_space(F.regexp_replace(bare, "[-_]", " ")))


def token_set(c: Column | str) -> Column:
    """Distinct lower-case tokens without stop words, sorted."""
    tokens = F.filter(F.split(F.lower(col(c)), r"[\s/\-(),]+"), lambda x: x != "")
    return F.array_sort(F.array_distinct(F.array_except(tokens, F.array(*[F.lit(w) for w in STOP_WORDS]))))


def note_form(c: Column | str) -> Column:
    """Lower case, single blanks, then nothing but letters, digits, underscores and blanks; blanks left by a removed mark stay."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(col(c)), r"(?U)[\s\x1c-\x1f]+", " ")), r"[^\p{L}\p{N}_ ]", "")


def escape_ampersands(c: Column | str) -> Column:
    """Bare ampersands as entities, existing entities kept."""
    return F.regexp_replace(col(c), r"&(?!(?:[a-zA-Z]+|#\d+|#x[0-9a-fA-F]+);)", "&amp;")


def plain_text(c: Column | str) -> Column:
    """Text for comparison: trimmed, lower case, single blanks; placeholders and null are empty."""
    text = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    return F.when(text.isin(PLACEHOLDERS), "").otherwise(F.regexp_replace(text, r"\s+", " "))


def activity_name(c: Column | str) -> Column:
    """The name inside the printed form of an activity object; any other text as it is."""
    inner = F.regexp_extract(col(c), r"Activity\(.*?name='([^']*)'", 1)
    return F.when(col(c).startswith("Activity(") & (inner != ""), inner).otherwise(col(c))


def state_key(c: Column | str) -> Column:
    return F.translate(col(c), " -", "__")


def is_simple_id(c: Column | str) -> Column:
    """An id that is no UUID, has a separator and fewer than 50 characters."""
    uuid = F.regexp_replace(F.lower(col(c)), "[{}-]|^urn:uuid:", "").rlike("^[0-9a-f]{32}$")
    return ~uuid & col(c).rlike("[_-]") & (F.length(col(c)) < 50)


def json_part(c: Column | str) -> Column:
    """The JSON inside fenced or noisy text: the first fenced block that opens one, else from the first bracket to its last partner."""
    text = F.trim(col(c))
    blocks = F.regexp_extract_all(text, F.lit(r"(?is)```(?:json)?\s*\n?(.*?)\n?```"), F.lit(1))
    opening = F.filter(F.transform(blocks, lambda b: F.regexp_replace(b, r"^\s+|\s+$", "")), lambda b: b.rlike(r"^[{\[]"))
    fenced = F.try_element_at(opening, F.lit(1))
    brace, bracket = F.instr(text, "{"), F.instr(text, "[")
    last = lambda ch: F.when(text.contains(ch), F.length(text) - F.instr(F.reverse(text), ch) + 1).otherwise(0)
    is_object = (brace > 0) & ((bracket == 0) | (brace < bracket))
    start = F.when(is_object, brace).otherwise(bracket)
    end = F.when(is_object, last("}")).otherwise(last("]"))
    return F.coalesce(fenced, F.when((start > 0) & (end > start), F.substring(text, start, end - start + 1)))


def repaired_json(c: Column | str) -> Column:
    """JSON text read as it is, else with trailing commas dropped, else with single quotes as double ones; null if none reads."""
    part = json_part(c)
    commas = F.regexp_replace(part, r",\s*([}\]])", "$1")
    quotes = F.translate(commas, "'", '"')
    reads = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(reads(part), reads(commas), reads(quotes))


def is_truncated_json(c: Column | str) -> Column:
    """More opening than closing braces or brackets."""
    n = lambda ch: F.length(col(c)) - F.length(F.replace(col(c), F.lit(ch), F.lit("")))
    return (n("{") > n("}")) | (n("[") > n("]"))
