"""Texts in memory that are searched for similar ones. Pure Python and numpy.

A Ratcliff-Obershelp ratio is slow to work out, but its matching blocks are a
common subsequence of both texts. So it is never above what their common
characters allow, nor above what their longest common subsequence allows; both
are quick, and only pairs that pass them are rated. Nothing is lost.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

#: Characters are counted by their code modulo this; counts that fall together only loosen the bound.
BUCKETS = 128
#: Counts stop here; a longer text counts as having so many of each.
MOST = 65535
#: Below so many texts a loop over them is quicker than arrays.
FEW = 16


def ratio(x: str, y: str) -> float:
    return SequenceMatcher(None, x, y).ratio()


def allowed(common, x: int, y):
    """The ratio of texts of lengths x and y with so many characters matched."""
    return 2.0 * common / (x + y)


def places(text: str) -> dict[str, int]:
    """Each character's places as bits."""
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def subsequence(at: dict[str, int], n: int, y: str) -> int:
    """Length of the longest common subsequence of ``y`` and the text of length ``n`` with the places ``at``."""
    v = full = (1 << n) - 1
    for c in y:
        u = v & at.get(c, 0)
        if u:
            v = (v + u) | (v - u)
    return n - (v & full).bit_count()


def buckets(text: str) -> dict[int, int]:
    """How many characters fall into each bucket."""
    if len(text) > MOST:
        return dict.fromkeys(range(BUCKETS), MOST)
    out: dict[int, int] = {}
    for c in text:
        k = ord(c) % BUCKETS
        out[k] = out.get(k, 0) + 1
    return out


class Texts:
    """Texts in the order in which they were added, with the counts of their characters."""

    def __init__(self, texts: list[str] = ()):
        self.texts: list[str] = []
        self.counts = np.zeros((BUCKETS, 64), "uint16")
        self.size = np.zeros(64, "int32")
        for text in texts:
            self.add(text)

    def add(self, text: str) -> None:
        n = len(self.texts)
        if n == len(self.size):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)], axis=1)
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        for k, c in buckets(text).items():
            self.counts[k, n] = c
        self.size[n] = len(text)
        self.texts.append(text)

    def common(self, x: str) -> np.ndarray:
        """At most so many characters of each text have a partner in ``x``."""
        n = len(self.texts)
        out = np.zeros(n, "int32")
        for k, c in buckets(x).items():
            out += np.minimum(self.counts[k, :n], np.uint16(c))
        return np.minimum(out, np.minimum(self.size[:n], len(x)))

    def first(self, x: str, threshold: float) -> str | None:
        """The first text with a ratio of at least ``threshold``, the text leading."""
        n, some = len(x), self.texts
        if len(some) > FEW:
            some = [self.texts[i] for i in np.flatnonzero(allowed(self.common(x), n, self.size[: len(some)]) >= threshold)]
        at = places(x)
        for y in some:
            m = len(y)
            if allowed(min(n, m), n, m) >= threshold and allowed(subsequence(at, n, y), n, m) >= threshold and ratio(y, x) >= threshold:
                return y
        return None


class Leaders:
    """Leader clustering of the texts of one group as they come."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.texts = Texts()
        self.of: dict[str, object] = {}

    def leader(self, text: str, node):
        """Whom the next node follows: the first leader with a similar text, else itself."""
        if text not in self.of:
            found = self.texts.first(text, self.threshold)
            self.of[text] = node if found is None else self.of[found]
            if found is None:
                self.texts.add(text)
        return self.of[text]


class Options:
    """Right sides of one group, given in order, of which each is taken once. Places are those in the order given."""

    def __init__(self, texts: list[str], threshold: float):
        self.threshold = threshold
        self.queues: dict[str, list[int]] = {}
        for i, text in enumerate(texts):
            self.queues.setdefault(text, []).append(i)
        self.none = len(texts)
        self.left = self.none
        self.known: Texts | None = None
        for q in self.queues.values():
            q.reverse()

    def take(self, text: str) -> tuple[int, float] | None:
        """Place and score of the best free one by the rule of ``text_similarity``, ties to the first; none below the threshold."""
        if not self.left:
            return None
        score, best = 1.0, text
        if not self.queues.get(text):
            if not text:
                return None
            score, best = self._search(text)
            if best is None or score < self.threshold or score <= 0:
                return None
        queue = self.queues[best]
        place = queue.pop()
        self.left -= 1
        if self.known:
            self.head[self.number[best]] = queue[-1] if queue else self.none
        return place, score

    def _index(self) -> None:
        """The texts that are free still, by characters and words."""
        self.known = Texts([t for t, q in self.queues.items() if q and t])
        self.number = {t: i for i, t in enumerate(self.known.texts)}
        if q := self.queues.get(""):
            self.number[""] = len(self.number)  # equal to blank ones only, so never searched
        self.head = np.array([self.queues[t][-1] for t in self.number], "int64")
        words: dict[str, list[int]] = {}
        self.words = np.zeros(len(self.known.texts), "int32")
        for i, t in enumerate(self.known.texts):
            own = set(t.split(" "))
            self.words[i] = len(own)
            for w in own:
                words.setdefault(w, []).append(i)
        self.having = {w: np.array(x, "int64") for w, x in words.items()}
        self.indexed = self.left

    def _search(self, x: str) -> tuple[float, str | None]:
        if not self.known or 2 * self.left < self.indexed:
            self._index()
        t, n = self.known, len(x)
        if not t.texts:
            return 0.0, None
        head, size = self.head[: len(t.texts)], t.size[: len(t.texts)]
        common = t.common(x)
        own = set(x.split(" "))
        shared = np.zeros(len(t.texts), "int32")
        for w in own:
            if w in self.having:
                shared[self.having[w]] += 1
        share = shared / np.minimum(self.words, len(own))
        sure = np.where(share >= 0.5, 0.6 + share * 0.3, 0.0)
        free = head < self.none
        least = np.minimum(size, n)
        for i in np.flatnonzero(free & (common == least) & (least >= 5) & (sure < 0.85)):
            y = t.texts[i]
            if x in y or y in x:
                sure[i] = 0.85
        sure[~free] = -1.0
        score = float(sure.max())
        best = int(np.flatnonzero(sure == score)[np.argmin(head[sure == score])])
        most = allowed(common, n, size)
        some = np.flatnonzero(free & (most >= max(score, self.threshold)))
        at = places(x)
        for i in some[np.lexsort((head[some], -most[some]))]:
            if most[i] < score:
                break
            y = t.texts[i]
            bound = allowed(subsequence(at, n, y), n, len(y))
            if bound < self.threshold or (bound, -head[i]) <= (score, -head[best]):
                continue
            s = ratio(x, y)
            if (s, -head[i]) > (score, -head[best]):
                score, best = s, int(i)
        return score, t.texts[best]
