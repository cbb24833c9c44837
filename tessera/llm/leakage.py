"""Evaluation texts that leak into a corpus.

A document holds an item when some run of ``window`` consecutive words of the
item, or the whole of a shorter item, stands in the document word for word.
That is a set containment of 1 over item-sized windows, and a prefix-filtered
join finds it: the shingles of each window are ordered by their frequency in
the corpus, of which a containment of 1 needs only the first, the rarest; a
shingle met at word p of a document and at offset o of a window fixes the
window's place, p - o, which must lie inside the document (positional and
length bounds); there the words themselves are compared.

The corpus is read twice whatever the number of items: once to count the
shingles that items have, once to give out the surroundings of the chosen
ones. Which shingles those are the readers know from a bit set of bounded size
that may say yes too often, never no; the joins settle it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.wording import WORD, Hashes, mix, rolling
from tessera.plans.runtime import materialize, spread

#: Soft hyphens, zero-width spaces and hyphens before a line break vanish, with the break.
_GONE = re.compile("[\u00ad\u200b]|-(?:\r\n|\n)")


def clean_words(text: str | None) -> list[str]:
    """Words after the removal of invisible marks and of hyphenation at line ends."""
    if not isinstance(text, str):
        return []
    if "-" in text or "\u00ad" in text or "\u200b" in text:
        text = _GONE.sub("", text)
    return WORD.findall(text.lower())


WINDOW_SCHEMA = "item_id bigint, words string, size int, length int"
#: Largest bit set sent to the readers, in bits; beyond it they pass more on to the join.
MOST_BITS = 1 << 27
#: Bits of the set that each member sets.
PROBES = 4


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """Windows of each item: ``WINDOW_SCHEMA``, distinct within an item.

    ``size`` is the number of words of its shingles, which is smaller than
    ``shingle`` for windows that are shorter. Items without words have none.
    """

    def run(batches: Iterator[pd.DataFrame]):
        names = [c.split()[0] for c in WINDOW_SCHEMA.split(", ")]
        for pdf in batches:
            rows: list[tuple] = []
            for item, text in zip(pdf["item_id"].tolist(), pdf["text"]):
                w = clean_words(text)
                for i in range(max(1, len(w) - window + 1) if w else 0):
                    part = w[i : i + window]
                    rows.append((item, " ".join(part), min(shingle, len(part)), len(part)))
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            yield pd.DataFrame(rows, columns=names)

    return items.select("item_id", "text").mapInPandas(run, WINDOW_SCHEMA).distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """The shingles of each distinct window: (words, size, length, offset, shingle)."""

    def run(batches: Iterator[pd.DataFrame]):
        hashes = Hashes()
        for pdf in batches:
            rows = []
            for words, size, length in zip(pdf["words"], pdf["size"].tolist(), pdf["length"].tolist()):
                flat = np.fromiter((hashes[x] for x in words.split(" ")), dtype=np.uint64, count=length)
                rows += [(words, size, length, o, x) for o, x in enumerate(rolling(flat, size).view(np.int64).tolist())]
            yield pd.DataFrame(rows, columns=["words", "size", "length", "offset", "shingle"])

    distinct = windows.select("words", "size", "length").distinct()
    return distinct.mapInPandas(run, "words string, size int, length int, offset int, shingle bigint")


class Members:
    """A set of (size, shingle) as bits: none is missed, a few others pass."""

    def __init__(self, rows: DataFrame):
        """``rows`` has (size, shingle). Its bits are put together by the cluster; the driver gets at most MOST_BITS / 64 longs."""
        n = rows.count()
        self.bits = 1 << min(MOST_BITS.bit_length() - 1, max(10, (16 * n).bit_length()))
        self.sizes = sorted(r["size"] for r in rows.select("size").distinct().collect())
        bits = self.bits

        def run(batches: Iterator[pd.DataFrame]):
            for pdf in batches:
                if len(pdf):
                    at = np.concatenate(list(_places(pdf["shingle"].to_numpy().view(np.uint64), pdf["size"].to_numpy().astype(np.uint64), bits)))
                    yield pd.DataFrame({"at": np.unique(at)})

        places = rows.select("size", "shingle").mapInPandas(run, "at bigint")
        words = places.groupBy(F.shiftright("at", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("b")).toPandas()
        self.words = np.zeros(bits // 64, dtype=np.uint64)
        self.words[words["w"].to_numpy()] = words["b"].to_numpy().astype(np.int64).view(np.uint64)

    def hits(self, flat: np.ndarray):
        """(size, positions, shingles) of the words at which a shingle of the set may start."""
        for size in self.sizes:
            runs = rolling(flat, size)
            pos = np.arange(len(runs))
            for at in _places(runs, np.uint64(size), self.bits, lambda: pos):
                pos = pos[(self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
            if len(pos):
                yield size, pos, runs[pos]


def _places(shingles: np.ndarray, size, bits: int, left=None):
    """The bits of shingles, probe by probe; ``left`` tells which of them are still of interest."""
    with np.errstate(over="ignore"):
        mixed = shingles ^ (size * np.uint64(0x9E3779B97F4A7C15))
    for probe in range(PROBES):
        some = mixed if left is None else mixed[left()]
        yield (mix(some, 11 + probe) & np.uint64(bits - 1)).astype(np.int64)


def _flat(lists: list[list[str]], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a batch one after the other, and where each text starts."""
    starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lists), "int64", len(lists)))))
    return np.fromiter((hashes[x] for w in lists for x in w), dtype=np.uint64, count=int(starts[-1])), starts


def shingle_counts(documents: DataFrame, members: Members) -> DataFrame:
    """How often each shingle of the set stands in the corpus: (size, shingle, n), with a few others."""
    sent = documents.sparkSession.sparkContext.broadcast(members)

    def run(batches: Iterator[pd.DataFrame]):
        hashes, known = Hashes(), sent.value
        for pdf in batches:
            flat, starts = _flat([clean_words(t) for t in pdf["text"]], hashes)
            for size, pos, runs in known.hits(flat):
                inside = np.searchsorted(starts, pos, side="right") == np.searchsorted(starts, pos + size - 1, side="right")
                value, n = np.unique(runs[inside], return_counts=True)
                yield pd.DataFrame({"size": np.full(len(value), size, "int32"), "shingle": value.view(np.int64), "n": n})

    return documents.select("text").mapInPandas(run, "size int, shingle bigint, n bigint").groupBy("size", "shingle").agg(F.sum("n").alias("n"))


def surroundings(documents: DataFrame, members: Members, window: int) -> DataFrame:
    """The words around each shingle of the set: (doc_id, size, shingle, lead, around).

    ``around`` has all words that a window over the shingle can have, ``lead``
    of them before the shingle.
    """
    sent = documents.sparkSession.sparkContext.broadcast(members)

    def run(batches: Iterator[pd.DataFrame]):
        hashes, known = Hashes(), sent.value
        names = ["doc_id", "size", "shingle", "lead", "around"]
        for pdf in batches:
            lists = [clean_words(t) for t in pdf["text"]]
            flat, starts = _flat(lists, hashes)
            ids, rows = pdf["doc_id"].tolist(), []
            for size, pos, runs in known.hits(flat):
                doc = np.searchsorted(starts, pos, side="right") - 1
                for p, h, i in zip((pos - starts[doc]).tolist(), runs.view(np.int64).tolist(), doc.tolist()):
                    w = lists[i]
                    if p + size <= len(w):
                        first = max(0, p - window + size)
                        rows.append((ids[i], size, h, p - first, " ".join(w[first : p + window])))
            yield pd.DataFrame(rows, columns=names).astype({"size": "int32", "lead": "int32", "shingle": "int64"})

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id bigint, size int, shingle bigint, lead int, around string")


def leaked(documents: DataFrame, items: DataFrame, window: int = 12, shingle: int = 5) -> DataFrame:
    """Documents that hold an item fully or partly: (doc_id, item_id), distinct.

    Texts are never shuffled, only the surroundings of shingles that are the
    rarest of some window; nothing of the items is held by the driver or sent
    to the readers but a bit set of at most MOST_BITS. Null and blank texts and
    items without words give no rows; equal items are all reported; a null
    ``doc_id`` stays null, an item without id takes no part.
    """
    documents = spread(documents.select("doc_id", "text"))
    windows = materialize(item_windows(items.where("item_id IS NOT NULL"), window, shingle))
    parts = materialize(window_shingles(windows))
    counts = shingle_counts(documents, Members(parts.select("size", "shingle").distinct()))
    # a window of which a shingle is missing in the corpus stands nowhere
    rarest = F.min(F.struct("n", "offset", "shingle")).alias("r")
    chosen = parts.join(counts, ["size", "shingle"]).groupBy("words", "size", "length").agg(rarest, F.count("*").alias("there"))
    chosen = materialize(chosen.where("there = length - size + 1").select("words", "size", "length", "r.offset", "r.shingle"))
    around = surroundings(documents, Members(chosen.select("size", "shingle").distinct()), window)
    begin = F.col("lead") - F.col("offset")
    placed = around.join(chosen, ["size", "shingle"]).where((begin >= 0) & (F.slice(F.split("around", " "), begin + 1, F.col("length")) == F.split("words", " ")))
    return placed.select("doc_id", "words").distinct().join(windows.select("item_id", "words"), "words").select("doc_id", "item_id").distinct()


def leaked_items(found: DataFrame, items: DataFrame) -> DataFrame:
    """Each item with the number of documents that hold it: (item_id, topic, documents)."""
    n = found.groupBy("item_id").agg(F.count("*").alias("documents"))
    return items.select("item_id", "topic").distinct().join(n, "item_id", "left").select("item_id", "topic", F.coalesce("documents", F.lit(0)).alias("documents"))
