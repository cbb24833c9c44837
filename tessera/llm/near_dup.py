"""Near-duplicate records by bottom-k sketches.

A record's bag of words is compared with all others at a multiset Jaccard
similarity of at least ``threshold``. The steps:

1. Words that hold at least ``common_share`` of all words are counted as common
   ones; there can't be more than 1/common_share of them, so the list is small
   by construction and goes to every worker.
2. Each text becomes a bottom-k sketch: the ``k`` smallest values of one hash
   function over the triples of its bag's rare elements, in whatever places of
   the text they are. It is one function for all texts, so the k smallest
   values of a union are those of its sketches. Two texts seldom have three
   rare words in common by chance, so the lists stay short over a vocabulary of
   fixed size. A text with fewer than LEAST_RARE rare elements has few triples;
   it is listed by the ``k`` smallest values of its word shingles as well, of
   which those with two rare words come first, then those with one, then the
   rest.
3. Texts with equal bags form a class; one representative goes on, so copies
   never meet each other in a list.
4. Inverted lists of the retained values give the pairs of classes and their
   overlaps. A shingle with a rare word is in at most
   common_share x (mean words) of all lists. One without rare words has no
   such bound; its list is split by the elements of the bags' prefixes (rarest
   first, n - ceil(threshold n) + 1 of them), of which similar bags always
   share one, so the split loses nothing. A posting carries the rank of its
   value, so a value met through several parts of its list counts once.
5. One triple in common is enough to go on. Of pairs without one the
   union-sketch estimate is made: the overlap's share in the min(k, size)
   smallest shingle values of the union. Pairs below :func:`least_share` go.
6. A parity sketch of 256 bits of each bag bounds how much two bags differ at
   least; pairs that differ too much for the threshold go, none wrongly.
7. The exact similarity of the two bags decides.

Steps 2, 4 and 5 can lose a pair whose edits replace nearly every rare word,
or break nearly every shingle of texts with few of those. With
``exact`` they are replaced by a join that can't: the k smallest values are
those of the bag's own elements, rarest first, with k = n - ceil(threshold n)
+ 2, so similar bags share at least two of them, and lists are kept for pairs
of retained elements. It costs more lists a text and is meant for collections
where every last pair matters more than time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.wording import WORD, Hashes, mix, rolling, words
from tessera.plans.runtime import discard, materialize

BAG_SCHEMA = "id bigint, hi bigint, lo bigint, n int, size int, odd array<bigint>"
SKETCH_SCHEMA = "id bigint, n int, keys array<bigint>, ranks array<tinyint>"
#: Largest k: ranks of retained values are bits of one long; the number itself marks values whose lists aren't split.
MOST_RANKS = 63
#: Words from which a text is listed by single elements in exact mode, since its pairs of elements would be too many.
LONG_BAG = 400
#: Rare elements from which triples of them are enough to find a text by. Rare elements that are combined at most, those with the smallest hashes.
LEAST_RARE, MOST_RARE = 8, 32
#: Values of triples are the last by their two highest bits; those of shingles have 0, 1 or 2 there.
OF_TRIPLE = 3


def sent_if_few(ids: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """A list of ids, hinted to be sent to every worker if it is counted to have at most ``limit`` rows."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, combined in each batch before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            counts: Counter = Counter()
            for text in pdf["text"]:
                counts.update(words(text))
            yield pd.DataFrame({"word": list(counts.keys()), "n": np.fromiter(counts.values(), "int64", len(counts))})

    return texts.select("text").mapInPandas(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def common_words(texts: DataFrame, share: float) -> dict[str, int]:
    """Words with at least ``share`` of all words, with their counts: at most 1/share entries."""
    counts = materialize(word_counts(texts))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r["word"]: r["n"] for r in counts.where(F.col("n") >= F.lit(share * total)).collect()}


def _bags(pdf: pd.DataFrame, hashes: Hashes, min_words: int) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, words, sizes, starts, word hashes one text after the other) of the texts of a batch that have enough words."""
    ids, lists = [], []
    for no, text in zip(pdf["id"].tolist(), pdf["text"]):
        w = WORD.findall(text.lower()) if isinstance(text, str) else []
        if len(w) >= min_words:
            ids.append(no)
            lists.append(w)
    sizes = np.fromiter(map(len, lists), "int64", len(lists))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    return ids, lists, sizes, starts, np.fromiter((hashes[x] for w in lists for x in w), dtype=np.uint64, count=int(starts[-1]))


def bags(texts: DataFrame, shingle: int, k: int, min_words: int, sized: bool) -> DataFrame:
    """Digest and parity sketch of the bag of each text with at least ``min_words`` words: ``BAG_SCHEMA``.

    ``hi``, ``lo`` and ``n`` identify the bag whatever the order of its words;
    ``odd`` is its parity sketch (bit b: an odd number of elements fall on b).
    ``size`` is that of its bottom-k sketch, if it is asked for by ``sized``.
    """

    def run(batches: Iterator[pd.DataFrame]):
        hashes = Hashes()
        for pdf in batches:
            ids, _, sizes, starts, flat = _bags(pdf, hashes, min_words)
            if not ids:
                continue
            with np.errstate(over="ignore"):
                hi = np.add.reduceat(mix(flat, 1), starts[:-1])
                lo = np.add.reduceat(mix(flat, 2), starts[:-1])
            size = np.full(len(ids), k, dtype="int32")
            if sized:
                runs = rolling(flat, shingle)
                size = np.array([min(k, len(np.unique(runs[a : b - shingle + 1]))) for a, b in zip(starts[:-1], starts[1:])], dtype="int32")
            yield pd.DataFrame({"id": ids, "hi": hi.view(np.int64), "lo": lo.view(np.int64), "n": sizes.astype("int32"), "size": size, "odd": _parities(flat, sizes)})

    return texts.select("id", "text").mapInPandas(run, BAG_SCHEMA)


def sketches(texts: DataFrame, common: dict[str, int], shingle: int, k: int, threshold: float, min_words: int, exact: bool = False) -> DataFrame:
    """Sketch of each text with at least ``min_words`` words: ``SKETCH_SCHEMA``.

    ``keys`` are the lists a text is in: its retained triples; in a text with
    few rare elements also its retained shingles with rare words, then those
    without, each joined with every element of the bag's prefix.
    ``ranks`` tells the rank of such a value, MOST_RANKS for the others. With
    ``exact`` the lists are those of :func:`_element_pairs`.
    """
    keep = Fraction(str(threshold))

    def run(batches: Iterator[pd.DataFrame]):
        hashes = Hashes()
        rank = {xxh: c for xxh, c in ((hashes[w], c) for w, c in common.items())}
        frequent = np.array(sorted(rank), dtype=np.uint64)
        for pdf in batches:
            ids, lists, sizes, starts, flat = _bags(pdf, hashes, min_words)
            if not ids:
                continue
            bag = lambda i: flat[starts[i] : starts[i + 1]]  # noqa: B023, E731
            keys, ranks = [], []
            if exact:
                keys = [_element_pairs(bag(i), rank, keep) for i in range(len(ids))]
                ranks = [np.full(len(x), MOST_RANKS, np.int8) for x in keys]
            else:
                elements, rare = _rare_elements(flat, sizes, frequent)
                threes = _triples(elements, rare, k)
                values = _values(flat, frequent, shingle) if (rare < LEAST_RARE).any() else None
                for i in range(len(ids)):
                    if rare[i] >= LEAST_RARE:
                        keys.append(threes[i])
                        ranks.append(np.full(len(threes[i]), MOST_RANKS, np.int8))
                        continue
                    kept = np.unique(values[starts[i] : max(starts[i], starts[i + 1] - shingle + 1)])[:k]
                    cut = int(np.searchsorted(kept, np.uint64(2 << 62)))
                    parts = _split(kept[cut:], bag(i), rank, keep) if cut < len(kept) else np.empty(0, np.int64)
                    keys.append(np.concatenate([threes[i], kept[:cut].view(np.int64), parts]))
                    plain = np.repeat(np.arange(cut, len(kept), dtype=np.int8), len(parts) // max(1, len(kept) - cut))
                    ranks.append(np.concatenate([np.full(len(threes[i]) + cut, MOST_RANKS, np.int8), plain]))
            yield pd.DataFrame({"id": ids, "n": sizes.astype("int32"), "keys": keys, "ranks": ranks})

    return texts.select("id", "text").mapInPandas(run, SKETCH_SCHEMA)


def _values(flat: np.ndarray, frequent: np.ndarray, shingle: int) -> np.ndarray:
    """The hash function's value of each shingle: those with two rare words first, then those with one, then the rest."""
    rare = _rare(flat, frequent).astype(np.int8)
    runs = rolling(flat, shingle)
    amount = np.zeros(len(runs), dtype=np.int8)
    for j in range(shingle):
        amount += rare[j : j + len(runs)]
    kind = 2 - np.minimum(amount, 2)
    return (runs >> np.uint64(2)) | (kind.astype(np.uint64) << np.uint64(62))


def _rare(flat: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which words aren't among the sorted ``frequent`` ones."""
    if not len(frequent):
        return np.ones(len(flat), dtype=bool)
    return frequent[np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)] != flat


def _occurrences(flat: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, text, number of the occurrence within the text), sorted by text and word."""
    order = np.lexsort((flat, doc))
    w, o = flat[order], doc[order]
    fresh = np.ones(len(w), dtype=bool)
    fresh[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    at = np.arange(len(w))
    return w, o, at - np.maximum.accumulate(np.where(fresh, at, 0))


def _rare_elements(flat: np.ndarray, sizes: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rare elements of each text, ascending, one text after the other; their number a text."""
    rare = _rare(flat, frequent)
    w, o, occurrence = _occurrences(flat[rare], np.repeat(np.arange(len(sizes)), sizes)[rare])
    e = mix(w ^ mix(occurrence.astype(np.uint64), 3), 4)
    return e[np.lexsort((e, o))], np.bincount(o, minlength=len(sizes))


@cache
def _places(n: int) -> np.ndarray:
    """The triples of n places: three rows."""
    return np.array(list(combinations(range(n), 3)), dtype=np.int64).reshape(-1, 3).T


def _triples(elements: np.ndarray, counts: np.ndarray, most: int) -> list[np.ndarray]:
    """The ``most`` smallest values of the triples of each text's elements, for all texts with equally many at once."""
    starts = np.concatenate(([0], np.cumsum(counts)))
    out = [np.empty(0, np.int64)] * len(counts)
    used = np.minimum(counts, MOST_RARE)
    for n in np.unique(used[used >= 3]).tolist():
        i, j, k = _places(n)
        docs = np.flatnonzero(used == n)
        for part in np.array_split(docs, 1 + len(docs) * len(i) // 1_000_000):
            e = elements[starts[part][:, None] + np.arange(n)]
            v = mix(e[:, i] + e[:, j] + e[:, k], 9)
            if len(i) > most:
                v = np.partition(v, most - 1, axis=1)[:, :most]
            for doc, row in zip(part.tolist(), ((v >> np.uint64(2)) | np.uint64(OF_TRIPLE << 62)).view(np.int64)):
                out[doc] = row
    return out


def _parities(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Parity sketches of the bags that lie in ``flat`` one after the other, each as four longs.

    The elements of a bag are its words with the number of their occurrence.
    """
    w, o, occurrence = _occurrences(flat, np.repeat(np.arange(len(sizes)), sizes))
    bit = (mix(w ^ mix(occurrence.astype(np.uint64), 3), 6) & np.uint64(255)).astype(np.int64)
    parity = (np.bincount(o * 256 + bit, minlength=len(sizes) * 256) & 1).astype(np.uint8).reshape(len(sizes), 256)
    return list(np.packbits(parity, axis=1).view(np.int64))


def _prefix(bag: np.ndarray, rank: dict[int, int], keep: Fraction, shared: int) -> np.ndarray:
    """Hashes of the bag's rarest elements, so many that similar bags have ``shared`` of them in common at least."""
    seen: Counter = Counter()
    elements = []
    for h in bag.tolist():
        elements.append((rank.get(h, 0), h, seen[h]))
        seen[h] += 1
    elements.sort()
    prefix = elements[: len(elements) - math.ceil(keep * len(elements)) + shared]
    return mix(np.array([h for _, h, _ in prefix], dtype=np.uint64) ^ mix(np.array([o for _, _, o in prefix], dtype=np.uint64), 3), 4)


def _split(values: np.ndarray, bag: np.ndarray, rank: dict[int, int], keep: Fraction) -> np.ndarray:
    """Each value with each element of the bag's prefix, value by value."""
    both = mix(values[:, None] ^ _prefix(bag, rank, keep, 1)[None, :], 5).ravel()
    return ((both >> np.uint64(2)) | np.uint64(2 << 62)).view(np.int64)


def _element_pairs(bag: np.ndarray, rank: dict[int, int], keep: Fraction) -> np.ndarray:
    """List keys of a bag, of which similar bags always have one in common.

    Pairs of prefix elements for all but long bags; single elements for those
    and for bags that may be similar to a long one.
    """
    keys = []
    if len(bag) <= LONG_BAG and math.ceil(keep * len(bag)) >= 2:
        e = np.sort(_prefix(bag, rank, keep, 2))
        i, j = np.triu_indices(len(e), 1)
        keys.append(mix(e[i] ^ mix(e[j], 7), 8))
    if len(bag) >= keep * LONG_BAG or math.ceil(keep * len(bag)) < 2 / keep:
        keys.append(_prefix(bag, rank, keep, 1))
    return np.unique(np.concatenate(keys)).view(np.int64)


def least_share(threshold: float, shingle: int, k: int, sigmas: float = 3.0) -> float:
    """Least share of a union sketch that similar bags have in common, but for its sampling error.

    At a similarity of t the longer part of two bags differs in x = (1 - t) /
    (1 + t) of its words; where these are replaced one by one each breaks
    ``shingle`` runs at most, which leaves a resemblance of (1 - s x) / (1 + s
    x). The share in k sampled values is ``sigmas`` standard deviations below
    that with a chance of about 1 in 700. Moves and scattered insertions may
    break more runs than replacements do; two shared values are asked for in
    any case, and ``exact`` is the way for those that have none.
    """
    broken = shingle * (1 - threshold) / (1 + threshold)
    share = max(0.0, (1 - broken) / (1 + broken))
    return max(0.0, share - sigmas * math.sqrt(share * (1 - share) / k))


def candidate_pairs(classes: DataFrame, threshold: float, min_overlap: int) -> DataFrame:
    """Pairs of class representatives that share a triple or ``min_overlap`` retained values: (a, b, overlap, triple).

    ``classes`` has (id, n, keys, ranks). Bags whose sizes alone
    forbid the threshold don't meet: the logarithm of the size rides with each
    posting, and with those of split lists the rank of the value.
    """
    step = 0.05
    bin_of = F.least(F.lit(250), F.floor(F.log(F.col("n").cast("double")) / step)).cast("long")
    width = math.ceil(-math.log(threshold) / step) + 1
    # one long for (id, rank, size bin): the posting stays at two longs in the shuffle
    listed = classes.select((F.shiftleft("id", 14) + bin_of).alias("h"), F.inline(F.arrays_zip("keys", "ranks")))
    post = listed.select(F.col("keys").alias("v"), (F.col("h") + F.shiftleft(F.col("ranks").cast("long"), 8)).alias("p"))
    a, b = post.alias("a"), post.alias("b")
    met = a.join(b, (F.col("a.v") == F.col("b.v")) & (F.col("a.p") < F.col("b.p"))).where(
        F.abs(F.pmod(F.col("a.p"), F.lit(256)) - F.pmod(F.col("b.p"), F.lit(256))) <= width
    )
    rank = F.expr(f"cast(shiftright(a.p, 8) & {MOST_RANKS} AS int)")
    return (
        met.groupBy(F.shiftright("a.p", 14).alias("a"), F.shiftright("b.p", 14).alias("b"))
        .agg(F.count_if(rank == MOST_RANKS).alias("n"), F.bit_or(F.when(rank < MOST_RANKS, F.expr(f"shiftleft(1L, cast(shiftright(a.p, 8) & {MOST_RANKS} AS int))")).otherwise(0)).alias("m"), F.bool_or(F.shiftrightunsigned("a.v", 62) == OF_TRIPLE).alias("triple"))
        .select("a", "b", (F.col("n") + F.bit_count("m")).alias("overlap"), "triple")
        .where((F.col("overlap") >= min_overlap) | F.col("triple"))
        .where("a <> b")
    )


def close_enough(pairs: DataFrame, signed: DataFrame, threshold: float, k: int, share: float) -> DataFrame:
    """Pairs whose union sketches and parity sketches allow the threshold: (a, b).

    The union sketch of two texts has min(k, size of the union) values, of
    which ``overlap`` are shared at most; pairs with less than ``share`` of it
    and no common triple go. Bags of n and m elements with a similarity of t or more differ in at
    most (1 - t) / (1 + t) x (n + m) elements, and two parity sketches never
    differ in more bits than the bags in elements.
    """
    t = Fraction(str(threshold))
    side = lambda s: signed.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("size").alias(f"size_{s}"), F.col("odd").alias(f"odd_{s}"))
    bits = [F.bit_count(F.col("odd_a")[i].bitwiseXOR(F.col("odd_b")[i])) for i in range(4)]
    differ = bits[0] + bits[1] + bits[2] + bits[3]
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    if share > 0:
        met = met.where(F.col("triple") | (F.col("overlap") >= share * F.least(F.lit(k), F.col("size_a") + F.col("size_b") - F.col("overlap"))))
    p, q = t.numerator, t.denominator
    return met.where(differ * (q + p) <= (F.col("n_a") + F.col("n_b")) * (q - p)).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose bags are similar enough, exactly: (a, b, shared, total)."""
    limit = Fraction(str(threshold))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = texts.join(sent_if_few(ids), "id", "left_semi")

    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            rows = []
            for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"]):
                left, right = words(x), words(y)
                shared = sum((Counter(left) & Counter(right)).values())
                total = len(left) + len(right) - shared
                if shared * limit.denominator >= limit.numerator * total:
                    rows.append((a, b, shared, total))
            yield pd.DataFrame(rows, columns=["a", "b", "shared", "total"])

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInPandas(run, "a bigint, b bigint, shared int, total int")


class NearDuplicates:
    """The steps over one collection of (id, text), each table written once.

    ``links`` are the similar pairs between class representatives (a < b),
    ``members`` tells the class of each id that has equal bags beside it.
    Null, blank and short texts (below ``min_words``) take no part; several
    rows of one id are to be resolved before; ids lie between -2^43 and 2^43.
    ``exact`` finds every similar pair for certain.
    """

    def __init__(
        self,
        texts: DataFrame,
        threshold: float = 0.8,
        min_words: int = 5,
        shingle: int = 5,
        k: int = 40,
        min_overlap: int = 2,
        common_share: float = 1 / 8000,
        exact: bool = False,
    ):
        if min_words < shingle:
            raise ValueError("texts must have as many words as a shingle at least")
        if not 0 < k <= MOST_RANKS:
            raise ValueError(f"k must be from 1 to {MOST_RANKS}")
        self.texts = texts
        common = common_words(texts, common_share)
        share = 0.0 if exact else least_share(threshold, shingle, k)
        signed = self.signed = materialize(bags(texts, shingle, k, min_words, share > 0))
        bag = ["hi", "lo", "n"]
        reps = signed.groupBy(*bag).agg(F.min("id").alias("rep"), F.count("*").alias("c")).where("c > 1")
        self.members = materialize(signed.select("id", *bag).join(reps, bag).select("id", "rep", "c"))
        # texts are sketched on their way to the lists: kept as a table the sketches would take as much room as the lists
        whole = sketches(self._representatives(), common, shingle, k, threshold, min_words, exact)
        met = materialize(candidate_pairs(whole, threshold, 1 if exact else min_overlap))
        pairs = materialize(close_enough(met, signed, threshold, k, share))
        discard(met)
        self.links = materialize(verified(pairs, texts, threshold))

    def _representatives(self) -> DataFrame:
        """The texts without those of further copies."""
        return self.texts.join(sent_if_few(self.members.where("id <> rep").select("id")), "id", "left_anti")

    def pairs(self) -> DataFrame:
        """Every similar pair of ids: (a, b), a < b; copies are laid out."""
        m = self.members
        side = lambda s: m.select(F.col("rep").alias(s), F.col("id").alias(f"{s}_id"))
        across = (
            self.links.select("a", "b")
            .join(side("a"), "a", "left")
            .join(side("b"), "b", "left")
            .select(F.coalesce("a_id", "a").alias("x"), F.coalesce("b_id", "b").alias("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        l, r = m.alias("l"), m.alias("r")
        within = l.join(r, (F.col("l.rep") == F.col("r.rep")) & (F.col("l.id") < F.col("r.id"))).select(
            F.col("l.id").alias("a"), F.col("r.id").alias("b")
        )
        return across.unionByName(within)

    def classes(self) -> DataFrame:
        """One row per id: (id, class_id, copies, links).

        ``class_id`` is the smallest id with the same bag, ``copies`` the size
        of that class and ``links`` the number of similar ids outside it.
        """
        sizes = self.members.select("rep", "c").distinct()
        both = self.links.select("a", "b").unionByName(self.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        count = (
            both.join(sizes.select(F.col("rep").alias("b"), "c"), "b", "left")
            .groupBy(F.col("a").alias("class_id"))
            .agg(F.sum(F.coalesce("c", F.lit(1))).alias("links"))
        )
        return (
            self.signed.select("id")
            .join(self.members, "id", "left")
            .select("id", F.coalesce("rep", "id").alias("class_id"), F.coalesce("c", F.lit(1)).alias("copies"))
            .join(count, "class_id", "left")
            .select("id", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
        )
