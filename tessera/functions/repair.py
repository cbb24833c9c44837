"""JSON texts mended, stitched and merged; vectorised functions over Arrow batches."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOSERS = {"{": "}", "[": "]"}


def closed(text: str | None) -> str | None:
    """A cut-off JSON text, shortened to its last whole value and closed; None if nothing of it reads.

    Text before the first bracket goes. A text that reads as it is stays.
    """
    if not isinstance(text, str):
        return None
    start = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    if start < 0:
        return None
    text = text[start:].rstrip()
    stack: list[str] = []
    in_string = escaped = False
    ends: list[tuple[int, tuple[str, ...]]] = []
    for i, c in enumerate(text):
        if in_string:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                in_string = False
            continue
        if c == '"':
            in_string = True
        elif c in CLOSERS:
            stack.append(CLOSERS[c])
            ends.append((i + 1, tuple(stack)))
        elif c in "}]":
            if not stack or stack.pop() != c:
                return None
            if not stack:
                return text[: i + 1]
            ends.append((i + 1, tuple(stack)))
        elif c == ",":
            ends.append((i, tuple(stack)))
    for end, open_ in [(len(text), tuple(stack)), *reversed(ends[-200:])]:
        candidate = text[:end].rstrip().rstrip(",") + "".join(reversed(open_))
        try:
            json.loads(candidate)
            return candidate
        except ValueError:
            continue
    return None


def stitched(base: str, more: str, least: int = 8) -> str:
    """Two parts of one text, what the second repeats of the end of the first once; fences around the second go."""
    more = more.strip()
    for fence in ("```json", "```"):
        more = more.removeprefix(fence).lstrip() if more.startswith(fence) else more
    more = more.removesuffix("```").rstrip()
    for n in range(min(len(base), len(more), 2000), least - 1, -1):
        if base.endswith(more[:n]):
            return base + more[n:]
    return base + more


def merged(base, over):
    """Two JSON values as one: objects key by key, all else from the second; null in the second counts."""
    if isinstance(base, dict) and isinstance(over, dict):
        return {**base, **{k: merged(base[k], v) if k in base else v for k, v in over.items()}}
    return over


@F.pandas_udf(T.StringType())
def close_json(text: pd.Series) -> pd.Series:
    return text.map(closed)


@F.pandas_udf(T.StringType())
def stitch(base: pd.Series, more: pd.Series) -> pd.Series:
    return pd.Series([a if b is None else b if a is None else stitched(a, b) for a, b in zip(base, more)])


@F.pandas_udf(T.StringType())
def merge_json(base: pd.Series, over: pd.Series) -> pd.Series:
    """JSON objects merged level by level; a side that can't be read leaves the other."""

    def one(a, b):
        def read(x):
            try:
                return json.loads(x)
            except (ValueError, TypeError):
                return None

        x, y = read(a), read(b)
        return a if y is None else b if x is None else json.dumps(merged(x, y), sort_keys=True)

    return pd.Series([one(a, b) for a, b in zip(base, over)])
