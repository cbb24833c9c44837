"""Columnar shredding of nested records with repetition and definition levels.

Pure Python over decoded JSON; the operators run it inside Arrow batches. A
path is a string of steps, ``a.b[].c``; ``[]`` marks a repeated step. A column
holds one entry per leaf occurrence: (repetition level, definition level,
value). The repetition level is the number of the repeated step at which the
entry starts a new element (0: a new record); the definition level is the
number of optional steps (keys and elements) that are there.
"""

from __future__ import annotations

import json

Entry = tuple[int, int, object]


class Raw(str):
    """A JSON number as written."""


def _no_constant(name: str):
    raise ValueError(name)


def decode(text: str | None):
    """The JSON value of ``text``, numbers as written; ValueError if unreadable."""
    if text is None:
        raise ValueError("null")
    try:
        return json.loads(text, parse_float=Raw, parse_int=Raw, parse_constant=_no_constant)
    except RecursionError as x:
        raise ValueError("too deep") from x


def opened(value):
    """A string that holds a JSON array or object counts as that; all else is as it is."""
    while isinstance(value, str) and not isinstance(value, Raw) and value.lstrip(" \t\r\n")[:1] in ("{", "["):
        try:
            inner = decode(value)
        except ValueError:
            return value
        if not isinstance(inner, (dict, list)):
            return value
        value = inner
    return value


class Node:
    """Fused shape of parallel values: a node may hold an object, a list and a scalar branch at once."""

    __slots__ = ("keys", "items", "scalar")

    def __init__(self):
        self.keys: dict[str, Node] | None = None
        self.items: Node | None = None
        self.scalar = False


def fuse(value, node: Node, always: frozenset[str] = frozenset(), key: str | None = None) -> None:
    """Add the shape of ``value`` to ``node``; a key in ``always`` is repeated even where it holds one object."""
    if isinstance(value, list) or (key in always):
        node.items = node.items or Node()
        for v in value if isinstance(value, list) else [] if value is None else [value]:
            fuse(v, node.items, always)
    elif isinstance(value, dict):
        node.keys = {} if node.keys is None else node.keys
        for k, v in value.items():
            fuse(v, node.keys.setdefault(k, Node()), always, k)
    else:
        node.scalar = node.scalar or value is not None


def merge(node: Node, other: Node) -> None:
    """Add the shape ``other`` to ``node``."""
    node.scalar = node.scalar or other.scalar
    if other.items is not None:
        node.items = node.items or Node()
        merge(node.items, other.items)
    if other.keys is not None:
        node.keys = {} if node.keys is None else node.keys
        for k, child in other.keys.items():
            merge(node.keys.setdefault(k, Node()), child)


def settle(node: Node) -> None:
    """What is a list somewhere is a list everywhere: a single object's keys become those of its elements."""
    if node.items is not None and node.keys is not None:
        single = Node()
        single.keys, node.keys = node.keys, None
        merge(node.items, single)
    for child in [node.items] if node.items is not None else (node.keys or {}).values():
        settle(child)


def opened_all(value):
    """``value`` with every string that holds JSON replaced by what it holds."""
    value = opened(value)
    if isinstance(value, dict):
        return {k: opened_all(v) for k, v in value.items()}
    if isinstance(value, list):
        return [opened_all(v) for v in value]
    return value


def shred(record, always: frozenset[str] = frozenset()) -> dict[str, list[Entry]]:
    """Columns of one record by leaf path.

    Absent and null values are entries of a lower definition level, so that the
    repetition levels of a column alone give every position. A node that is a
    list somewhere is a list everywhere: a single value there is one element.
    An object has a leaf ``{}`` that is true where the object is there.
    """
    root = Node()
    fuse(record, root, always)
    settle(root)
    columns: dict[str, list[Entry]] = {}

    def put(path: str, rep: int, depth: int, value) -> None:
        columns.setdefault(path, []).append((rep, depth, value))

    def walk(node: Node, value, path: str, rep: int, depth: int, level: int) -> None:
        if node.items is not None:
            items = value if isinstance(value, list) else [] if value is None else [value]
            if not items:
                walk(node.items, None, path + "[]", rep, depth, level + 1)
            for i, v in enumerate(items):
                walk(node.items, v, path + "[]", rep if i == 0 else level + 1, depth + 1 + (v is not None), level + 1)
            return
        if node.keys is not None:
            there = value if isinstance(value, dict) else None
            put(f"{path}.{{}}" if path else "{}", rep, depth, there is not None or None)
            for k, child in node.keys.items():
                v = there.get(k) if there is not None else None
                walk(child, v, f"{path}.{k}" if path else k, rep, depth + (v is not None), level)
        if node.keys is None or node.scalar:
            put(path, rep, depth, None if isinstance(value, (dict, list)) else value)

    walk(root, record, "", 0, 0, 0)
    return columns


def ordinals(path: str, column: list[Entry]) -> list[tuple[tuple[int, ...], object]]:
    """(element number at every repeated step, value) of each entry, from the repetition levels alone."""
    steps = path.count("[]")
    at = [0] * steps
    out = []
    for n, (rep, _, value) in enumerate(column):
        if n and rep:
            at[rep - 1] += 1
            at[rep:] = [0] * (steps - rep)
        out.append((tuple(at), value))
    return out


def children(record, key: str, ident: str = "id", repeated: bool = True) -> list[tuple[object, int, object]]:
    """(parent id, position, own ``ident``) of each object under ``key`` at any depth.

    Rebuilt from the level sequences of the ancestor ``key``: positions come
    from its repetition levels, null members included; the parent is the
    nearest enclosing object with a non-null id.
    """
    columns = shred(record, frozenset([key]) if repeated else frozenset())
    tail = key + ("[]" if repeated else "") + ".{}"
    out = []
    for path, column in columns.items():
        if path != tail and not path.endswith("." + tail):
            continue
        own = path[: -len(".{}")]
        above = own[: -len(key) - (2 if repeated else 0)].rstrip(".")
        parents = []
        while True:
            parents.append((above.count("[]"), above))
            if not above:
                break
            above = above[:-2] if above.endswith("[]") else above.rpartition(".")[0]
        ids = []
        for steps, name in parents:
            at = f"{name}.id" if name else "id"
            if at in columns:
                ids.append((steps, {o: v for o, v in ordinals(at, columns[at]) if v is not None}))
        at = f"{own}.{ident}"
        mine = {o: v for o, v in ordinals(at, columns[at])} if at in columns else {}
        for o, there in ordinals(path, column):
            if there:
                parent = next((m[o[:n]] for n, m in ids if o[:n] in m), None)
                out.append((parent, o[-1] if repeated else 0, mine.get(o)))
    return out
