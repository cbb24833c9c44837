"""Splitting oversized texts at natural boundaries.

A text is cut where a dynamic program over its boundary positions finds the
least sum of cut penalties and size imbalance, subject to the token limit and
to an exact overlap of neighbours. The positions are all ends of sentences,
lines and paragraphs, and finer ones (clauses, words, marks, any token) only
in stretches that would else be longer than a third of what a piece advances:
a cut inside a sentence is never considered where sentences are short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tessera.llm import tokens
from tessera.plans.runtime import bounded_rows, spread

#: Penalty of a cut by kind of boundary; the lower the more natural.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, MARK, INSIDE = 0.0, 0.5, 1.0, 4.0, 8.0, 12.0, 30.0
KINDS = {PARAGRAPH: "paragraph", LINE: "line", SENTENCE: "sentence", CLAUSE: "clause", WORD: "word", MARK: "mark", INSIDE: "inside"}
#: A piece that starts inside a word costs this much; imbalance of a piece counts as weight x (relative deviation squared).
START_INSIDE, IMBALANCE = 3.0, 8.0

PIECE_SCHEMA = (
    "doc_id bigint, limit_no int, piece_no int, pieces int, char_start bigint, char_end bigint, "
    "n_tokens int, shared_tokens int, cut string, piece string, exception string"
)


def _among(codes: np.ndarray, marks: str) -> np.ndarray:
    found = codes == ord(marks[0])
    for m in marks[1:]:
        found |= codes == ord(m)
    return found


def boundaries(text: str, offset: np.ndarray) -> np.ndarray:
    """Penalty of a cut before each token; infinite where a token starts inside a character.

    Looks only at the characters around token starts, all of them at once.
    """
    penalty = np.full(len(offset), INSIDE)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    blank = (codes <= 32) | (codes == 0xA0) | (codes == 0x3000) | ((codes >= 0x2000) & (codes <= 0x200A))
    solid = np.maximum.accumulate(np.where(blank, 0, np.arange(1, len(codes) + 1)))
    breaks = np.concatenate(([0], np.cumsum(codes == 10)))
    inner = np.flatnonzero((offset > 0) & (offset < len(codes)))
    at = offset[inner]
    here, before = codes[at], codes[at - 1]
    starts_blank, after_blank = blank[at], blank[at - 1]
    # closing quotes and brackets belong to the sentence before them
    behind = np.where(_among(before, "\"')]") & (at > 1), codes[np.maximum(at - 2, 0)], before)
    kind = np.full(len(inner), INSIDE)
    kind[~starts_blank & _among(before, ",;|")] = MARK
    ends = starts_blank & ~after_blank
    kind[ends] = WORD
    kind[ends & _among(before, ",;:")] = CLAUSE
    kind[ends & _among(behind, ".!?")] = SENTENCE
    lines = breaks[at] - breaks[solid[at - 1]]
    fresh = after_blank & ~_among(here, "\n\r")
    kind[fresh & (lines == 1)] = LINE
    kind[fresh & (lines > 1)] = PARAGRAPH
    penalty[inner] = kind
    penalty[offset < 0] = math.inf
    return penalty


def _nodes(penalty: np.ndarray, stride: int) -> np.ndarray:
    """Token positions to cut at: sentence ends and better; finer ones only in stretches without them."""
    nodes = np.flatnonzero(penalty <= SENTENCE)
    for kind, gap in ((CLAUSE, stride // 3), (WORD, stride // 3), (MARK, stride // 3), (INSIDE, stride // 2)):
        bounds = np.concatenate(([0], nodes, [len(penalty) - 1]))
        wide = np.flatnonzero(np.diff(bounds) > max(gap, 1))
        if not len(wide):
            continue
        finer = np.flatnonzero(penalty <= kind)
        extra = [finer[np.searchsorted(finer, bounds[w], "right") : np.searchsorted(finer, bounds[w + 1], "left")] for w in wide]
        nodes = np.unique(np.concatenate([nodes, *extra]))
    return nodes[(nodes > 0) & (nodes < len(penalty) - 1)]


def cuts(penalty: np.ndarray, limit: int, overlap: int) -> list[int] | None:
    """Token positions at which to cut a text of len(penalty) - 1 tokens; [] if it fits, None if there is no way.

    Of all cut sequences over the nodes with pieces of at most ``limit`` tokens,
    each next piece starting ``overlap`` tokens before the cut, one of least cost.
    """
    total = len(penalty) - 1
    if total <= limit:
        return []
    stride = limit - overlap
    inner = _nodes(penalty, stride)
    if overlap:
        inner = inner[(inner <= overlap) | np.isfinite(penalty[np.maximum(inner - overlap, 0)])]
        inner = inner[inner > overlap]
    at = np.concatenate(([0], inner, [total]))
    own = np.concatenate(([0.0], penalty[inner], [0.0]))
    if overlap:
        start = penalty[inner - overlap]
        own[1:-1] += np.where(start >= INSIDE, START_INSIDE, 0.0)
    pieces = 1 + math.ceil((total - limit) / stride)
    ideal = (total + (pieces - 1) * overlap) / pieces
    nodes, extra = at.tolist(), own.tolist()
    best, back, low = [0.0] + [math.inf] * (len(nodes) - 1), [0] * len(nodes), 0
    scale = IMBALANCE / ideal**2
    # long stretches are weighed as arrays, short ones aren't worth the calls
    costs = np.full(len(nodes), math.inf) if len(nodes) > 40 else None
    if costs is not None:
        costs[0] = 0.0
    for j in range(1, len(nodes)):
        end = nodes[j]
        while end - nodes[low] > (limit if low == 0 else stride):
            low += 1
        if j - low <= 40:
            least, where = math.inf, low
            for k in range(low, j):
                off = end - nodes[k] + (overlap if k else 0) - ideal
                cost = best[k] + scale * off * off
                if cost < least:
                    least, where = cost, k
        else:
            off = end - at[low:j] + overlap - ideal
            if low == 0:
                off[0] -= overlap
            cost = costs[low:j] + scale * off * off
            where = low + int(cost.argmin())
            least = float(cost[where - low])
        best[j], back[j] = least + extra[j], where
        if costs is not None:
            costs[j] = best[j]
    if not math.isfinite(best[-1]):
        return None
    out, j = [], back[-1]
    while j:
        out.append(nodes[j])
        j = back[j]
    return out[::-1]


def split_text(text: str, offset: np.ndarray, penalty: np.ndarray, limit: int, overlap: int, vocabulary: str) -> list[tuple]:
    """(char_start, char_end, n_tokens, shared_tokens, kind of the cut after it, exception) of each piece.

    Pieces are runs of the text's own tokens. One that begins or ends inside a
    word is tokenized by itself too; if that gives more than ``limit`` the text
    is cut again with a smaller one. Where tokens are parts of characters there
    may be no cuts with the overlap, or none within the limit: then the overlap
    is halved until there are some, and a character of more tokens than the
    limit is a piece of its own. Such pieces say so: ``exception`` is
    ``overlap`` where the shared tokens aren't as many as asked for, ``limit``
    where the piece by itself has more tokens than allowed, else null.
    """
    room, asked = limit, overlap
    while True:
        at = cuts(penalty, room, overlap)
        while at is None and overlap:
            overlap //= 2
            at = cuts(penalty, room, overlap)
        if at is None:
            at = (np.flatnonzero(np.isfinite(penalty[1:-1])) + 1).tolist()
        if not at:
            return []
        starts = [0] + [c - overlap for c in at]
        ends = at + [len(offset) - 1]
        over = set()
        for i, (s, e) in enumerate(zip(starts, ends)):
            inside = (s and penalty[s] >= INSIDE) or (e < len(offset) - 1 and penalty[e] >= INSIDE)
            if e - s > limit or (inside and tokens.count(text[offset[s] : offset[e]], vocabulary) > limit):
                over.add(i)
        if not over or room <= overlap + 1:
            break
        room -= max(1, (room - overlap) // 16)
    kinds = [KINDS[float(penalty[c])] for c in at] + ["end"]
    return [
        (int(offset[s]), int(offset[e]), e - s, overlap if i else 0, k, "limit" if i in over else "overlap" if i and overlap != asked else None)
        for i, (s, e, k) in enumerate(zip(starts, ends, kinds))
    ]


def split_documents(documents: DataFrame, limits: DataFrame, vocabulary: str = tokens.DEFAULT_VOCABULARY) -> DataFrame:
    """The pieces of each text over a limit, for every set of limits: ``PIECE_SCHEMA``.

    ``limits`` has (limit_no, max_tokens, overlap_tokens), a few rows; the
    overlap must be below the maximum. Each text is tokenized once, within its
    Arrow batch; nothing is shuffled. Texts within a limit, null and empty ones
    give no rows for it. ``shared_tokens`` tokens at the start of a piece are
    the last ones of the piece before; pieces without them, put together, are
    the text again. ``exception`` marks the pieces for which the limit or the
    overlap can't be kept, see :func:`split_text`. Repeated rows give repeated pieces, a null ``doc_id`` stays.
    """
    sets = sorted(
        (int(r["limit_no"]), int(r["max_tokens"]), int(r["overlap_tokens"] or 0))
        for r in bounded_rows(limits.where("limit_no IS NOT NULL AND max_tokens IS NOT NULL").select("limit_no", "max_tokens", "overlap_tokens").distinct())
    )
    for _, most, overlap in sets:
        if not 0 <= overlap < most:
            raise ValueError(f"an overlap of {overlap} tokens needs a larger maximum than {most}")
    smallest = min((most for _, most, _ in sets), default=0)

    def run(batches: Iterator[pd.DataFrame]):
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                # a token has at least one byte
                if not isinstance(text, str) or 4 * len(text) <= smallest:
                    continue
                offset = tokens.offsets(text, vocabulary)
                if len(offset) - 1 <= smallest:
                    continue
                penalty = boundaries(text, offset)
                for number, most, overlap in sets:
                    pieces = split_text(text, offset, penalty, most, overlap, vocabulary)
                    rows += [
                        (doc, number, i, len(pieces), a, b, n, shared, kind, text[a:b], exception)
                        for i, (a, b, n, shared, kind, exception) in enumerate(pieces)
                    ]
                if len(rows) > 5000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return spread(documents.select("doc_id", "text")).mapInPandas(run, PIECE_SCHEMA)
