"""Mapping free-entered values to a canonical list.

Each distinct token of the values is joined to the vocabulary of the list by
edit distance; a value's repaired tokens are then weighed against the tokens of
whole entries with soft TF-IDF, and the best entry that the value covers names
the concept.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import is_blank
from tessera.plans.runtime import SMALL_ROWS, bounded_rows, materialize

UNMATCHED = "unmatched"
#: Positions from here on belong to the reading without camel case.
OTHER_READING = 1 << 24
#: Shortest token that may stand for a longer one of which it is the beginning.
PREFIX = 3
#: Characters that may be glued to the end of a word.
GLUED = 3
#: Least similarity of a token to the one it is repaired to.
TOKEN_SIMILARITY = 0.7
#: Least soft TF-IDF similarity of a value to the entry it is mapped to.
ENTRY_SIMILARITY = 0.8

_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z][a-z])|(?<=[a-z]{3})(?=[A-Z]{2})")
_TOKEN = re.compile(r"[a-z0-9]+\.?")


def tokenize(value: str, camel: bool = True) -> list[str]:
    """Lower-case tokens of a value; a token cut short keeps its full stop.

    Marks above the line and other letters outside a-z go; camel case parts,
    unless ``camel`` is off.
    """
    plain = "".join(
        c if ord(c) < 128 else " " if unicodedata.category(c)[0] == "Z" else "" for c in unicodedata.normalize("NFD", value)
    )
    if not camel:
        return _TOKEN.findall(plain.lower())
    first = plain.lstrip(" _-/&,")
    if first[:1].islower() and first[1:2].isupper():
        plain = plain.swapcase()
    return _TOKEN.findall(_CAMEL.sub(" ", plain).lower())


def distance(a: str, b: str, limit: int) -> int:
    """Edit distance with swaps of neighbours (each pair once); limit + 1 if above ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row_new = row, [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row_new[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row_new.append(cost)
        if min(row_new) > limit:
            return limit + 1
        before, row = last, row_new
    return row[-1]


def variants(token: str, edits: int) -> set[str]:
    """The token with up to ``edits`` characters left out."""
    out, front = {token}, {token}
    for _ in range(edits):
        front = {t[:i] + t[i + 1 :] for t in front for i in range(len(t))}
        out |= front
    return out


#: Characters that are read for one another in codes.
_CONFUSED = str.maketrans("ol", "01")


def code_form(value: str) -> str | None:
    """A value as a code: no prefix before a colon, no fraction of zero, no separators, look-alikes as one; None if it can't be one."""
    s = value.strip().lower().rpartition(":")[2]
    s = re.sub(r"[^a-z0-9]", "", re.sub(r"\.0+$", "", s)).translate(_CONFUSED)
    return s if any(c.isdigit() for c in s) else None


class Reference:
    """Entries of the canonical list as tokens, with weights; small by its nature.

    Entries are the names and synonyms of concepts. The vocabulary holds their
    tokens and the joined forms of tokens that follow each other. Codes, and
    synonyms with a digit, are matched as codes: as a whole, without edits,
    since a code one digit off is another code.
    """

    def __init__(self, rows: list[tuple[str, str | None, list[str] | None]]):
        entries: list[tuple[str, tuple[str, ...]]] = []
        self.codes: dict[str, str] = {}
        for code, name, synonyms in sorted(rows, key=lambda r: str(r[0])):
            for text in [code, name, *(synonyms or [])]:
                if not text or not text.strip():
                    continue
                short = code_form(text) if len(text.split()) == 1 else None
                if short:
                    self.codes.setdefault(short, code)
                else:
                    t = tuple(x.rstrip(".") for x in tokenize(text))
                    if t:
                        entries.append((code, t))
        self.entries = list(dict.fromkeys(entries))
        seen: dict[str, int] = defaultdict(int)
        for _, t in self.entries:
            for x in set(t):
                seen[x] += 1
        n = len(self.entries)
        self.weight = {x: math.log(1 + n / c) for x, c in seen.items()}
        self.norm = [math.sqrt(sum(self.weight[x] ** 2 for x in set(t))) for _, t in self.entries]
        self.by_token: dict[str, list[int]] = defaultdict(list)
        for i, (_, t) in enumerate(self.entries):
            for x in set(t):
                self.by_token[x].append(i)
        self.parts: dict[str, tuple[str, ...]] = {x: (x,) for x in seen}
        for _, t in self.entries:
            for size in range(2, len(t) + 1):
                for i in range(len(t) - size + 1):
                    self.parts.setdefault("".join(t[i : i + size]), t[i : i + size])
        # what is glued to a word, or edited into it, makes it longer by so much at most
        self.longest = max((len(w) + max(self.edits(w), GLUED) for w in self.parts), default=0)

    def edits(self, word: str) -> int:
        """Edits a word of the vocabulary may be away; joined forms one."""
        return allowed(len(word)) if len(self.parts[word]) == 1 else 1

    def variants(self) -> list[tuple[str, str]]:
        """(variant, word): with characters left out, and, after a dot, beginnings of single words."""
        out = {(v, w) for w in self.parts for v in variants(w, self.edits(w))}
        short = {("." + v, w) for w, p in self.parts.items() if len(p) == 1 for i in range(PREFIX, len(w)) for v in variants(w[:i], 1)}
        return sorted(out | short)

    def best(self, tokens: dict[int, list[tuple[str, float]]]) -> tuple[str, float]:
        """(code, score) for a value's tokens, each with the words it may stand for.

        An entry qualifies when every one of its tokens is covered; of those
        that qualify the highest soft TF-IDF similarity counts, ties fall to
        the smaller code.
        """
        words: dict[str, float] = {}
        length = 0.0
        for options in tokens.values():
            top = max((s for _, s in options), default=0)
            heaviest = 0.0
            for word, s in options:
                for x in self.parts[word]:
                    words[x] = max(words.get(x, 0.0), s)
                if s == top:
                    heaviest = max(heaviest, sum(self.weight[x] ** 2 for x in self.parts[word]))
            length += heaviest
        # the entries of the value's rarest word that can be covered, not those of every word
        found: tuple[float, str] | None = None
        done = set()
        for x in words:
            for i in self.by_token[x]:
                if i in done:
                    continue
                done.add(i)
                code, t = self.entries[i]
                if any(y not in words for y in t):
                    continue
                dot = sum(words[y] * self.weight[y] ** 2 for y in set(t))
                score = dot / (self.norm[i] * max(math.sqrt(length), self.norm[i] * 0.5))
                if found is None or (-score, code) < (-found[0], found[1]):
                    found = (score, code)
        return (found[1], found[0]) if found and found[0] >= ENTRY_SIMILARITY else (UNMATCHED, found[0] if found else 0.0)


def allowed(length: int) -> int:
    """Edits that a token of this length may have."""
    return 0 if length < 3 else 1 if length < 7 else 2


def similarity(token: str, word: str, edits: int) -> float:
    """Similarity of a token to a word, 0 if it can't stand for it."""
    bare = token.rstrip(".")
    if bare == word:
        return 1.0
    if token.endswith(".") and len(bare) >= PREFIX and word.startswith(bare):
        return 0.9
    if token.endswith(".") and PREFIX < len(bare) < len(word) and min(distance(bare, word[:i], 1) for i in range(len(bare) - 1, len(bare) + 2)) <= 1:
        return TOKEN_SIMILARITY
    if bare.startswith(word) and len(bare) - len(word) <= (GLUED if len(word) >= 6 else 2 if len(word) >= 4 else 0):
        return 1 - (len(bare) - len(word)) / (2 * len(bare))
    d = distance(bare, word, edits)
    s = 1 - d / max(len(bare), len(word))
    return s if d <= edits and s >= TOKEN_SIMILARITY else 0.0


def repair_candidates(tokens: DataFrame, index: Reference) -> DataFrame:
    """Pairs that may be a token and the word it stands for: (token, word), distinct.

    An equi-join on variants with characters left out; no token within the
    allowed edits of a word is missed, others are for the caller to drop.
    """
    longest = index.longest

    def spread(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            out = []
            for token in pdf["token"]:
                bare = token.rstrip(".")
                # a token longer than any word with all that may be added to it repairs to nothing
                if len(bare) > longest:
                    continue
                keys = variants(bare, allowed(len(bare))) | {bare[:-2], bare[:-3]}
                if token.endswith("."):
                    keys |= {"." + v for v in variants(bare, 1)}
                out += [(token, k) for k in keys if k]
            yield pd.DataFrame(out, columns=["token", "variant"])

    vocabulary = tokens.sparkSession.createDataFrame(pd.DataFrame(index.variants() or [("", "")], columns=["variant", "word"]))
    return tokens.mapInPandas(spread, "token string, variant string").join(vocabulary, "variant").select("token", "word").distinct()


def repaired_tokens(tokens: DataFrame, reference: DataFrame) -> DataFrame:
    """Each distinct token of (token) with every word of the list within its allowed edits: (token, word, edits).

    Words of fewer than three characters allow none, of fewer than seven one, others two; a swap of neighbours is one edit.
    """
    index = _index(reference, SMALL_ROWS)[0]
    single = {w: index.edits(w) for w, p in index.parts.items() if len(p) == 1}
    sent = tokens.sparkSession.sparkContext.broadcast(single)

    def verify(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            out = []
            for token, word in zip(pdf["token"], pdf["word"]):
                most = sent.value.get(word, -1)
                edits = distance(token, word, most) if most >= 0 else 0
                if edits <= most:
                    out.append((token, word, edits))
            yield pd.DataFrame(out, columns=["token", "word", "edits"])

    return repair_candidates(tokens.select("token").where("token <> ''").distinct(), index).mapInPandas(verify, "token string, word string, edits int")


def _index(reference: DataFrame, limit: int) -> tuple[Reference, list]:
    rows = [(r["code"], r["name"], r["synonyms"]) for r in bounded_rows(reference.where("code IS NOT NULL").select("code", "name", "synonyms"), limit)]
    return Reference(rows), rows


def map_values(values: DataFrame, reference: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """The concept of each distinct value: (value, code, score).

    ``values`` has (value), ``reference`` (code, name, synonyms). Values that
    are, letter for letter, a name, synonym or code give no row; nor do null
    and blank ones. All others give one: ``code`` is the concept, or
    ``unmatched``; ``score`` the soft TF-IDF similarity, 1 for a code.

    Values are reduced to distinct ones and their tokens to distinct tokens
    before anything is compared. The token repair is an equi-join on variants
    with characters left out, so no token meets the whole vocabulary. The
    reference list doesn't grow with the values and goes to every worker; one
    with more than ``limit`` concepts is an error.
    """
    spark = values.sparkSession
    index, rows = _index(reference, limit)
    known = spark.createDataFrame([(x,) for x in sorted({x for c, n, s in rows for x in [c, n, *(s or [])] if x is not None})] or [("",)], "value string")
    sent = spark.sparkContext.broadcast(index)
    distinct = values.select("value").where(~is_blank("value")).distinct().join(known, "value", "left_anti")

    def split(batches: Iterator[pd.DataFrame]):
        ref = sent.value
        for pdf in batches:
            out = []
            for value in pdf["value"]:
                code = ref.codes.get(code_form(value) or "")
                if code:
                    out.append((value, -1, code))
                    continue
                tokens, whole = tokenize(value), tokenize(value, camel=False)
                out += [(value, i, t) for i, t in enumerate(tokens)] or [(value, -2, "")]
                if whole != tokens:
                    out += [(value, OTHER_READING + i, t) for i, t in enumerate(whole)]
            yield pd.DataFrame(out, columns=["value", "pos", "token"])

    parts = materialize(distinct.mapInPandas(split, "value string, pos int, token string"))
    tokens = parts.where("pos >= 0").select("token").distinct()

    met = repair_candidates(tokens, index)

    def verify(batches: Iterator[pd.DataFrame]):
        ref = sent.value
        for pdf in batches:
            out = []
            for token, word in zip(pdf["token"], pdf["word"]):
                s = similarity(token, word, ref.edits(word)) if word in ref.parts else 0.0
                if s:
                    out.append((token, word, s))
            yield pd.DataFrame(out, columns=["token", "word", "s"])

    repairs = met.mapInPandas(verify, "token string, word string, s double")
    gathered = (
        parts.join(repairs.groupBy("token").agg(F.collect_list(F.struct("word", "s")).alias("options")), "token", "left")
        .groupBy("value")
        .agg(F.collect_list(F.struct("pos", "token", "options")).alias("tokens"))
    )

    def rank(batches: Iterator[pd.DataFrame]):
        ref = sent.value
        for pdf in batches:
            out = []
            for value, tokens in zip(pdf["value"], pdf["tokens"]):
                if len(tokens) == 1 and tokens[0]["pos"] == -1:
                    out.append((value, tokens[0]["token"], 1.0))
                    continue
                readings: tuple[dict, dict] = ({}, {})
                for t in tokens:
                    if t["options"] is not None and len(t["options"]):
                        readings[t["pos"] >= OTHER_READING][t["pos"]] = [(o["word"], o["s"]) for o in t["options"]]
                out.append((value, *max(map(ref.best, readings), key=lambda x: (x[0] != UNMATCHED, x[1]))))
            yield pd.DataFrame(out, columns=["value", "code", "score"])

    return gathered.mapInPandas(rank, "value string, code string, score double")


def map_results(results: DataFrame, reference: DataFrame) -> DataFrame:
    """Enrichment results with the concept of their term: (result_no, term, code, score).

    The term is ``entity_name``, if blank ``display_name``, if blank ``code``.
    Results with a blank term, and terms that need no mapping, give no row;
    repeated results give one. A term that a third of all results share is
    mapped once, and its result rows meet one mapping row.
    """
    term = F.coalesce(*[F.when(~is_blank(c), F.col(c)) for c in ("entity_name", "display_name", "code")])
    rows = results.select("result_no", term.alias("value")).where("value IS NOT NULL").distinct()
    mapped = materialize(map_values(rows, reference))
    return rows.join(mapped, "value").select("result_no", F.col("value").alias("term"), "code", "score")
