"""Extension surface: named transforms with declared inputs and outputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.runtime import materialize

Transform = Callable[..., DataFrame]


@dataclass(frozen=True)
class Step:
    """A transform ``f(spark, **inputs) -> DataFrame`` and what it reads and makes."""

    name: str
    run: Transform
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    tags: frozenset[str] = field(default_factory=frozenset)


class Registry:
    """Steps by name; plans run them in waves of what they depend on."""

    def __init__(self) -> None:
        self.steps: dict[str, Step] = {}

    def register(self, name: str, inputs: tuple[str, ...] = (), outputs: tuple[str, ...] | None = None, tags: tuple[str, ...] = ()):
        """A decorator; names are unique."""

        def add(f: Transform) -> Transform:
            if name in self.steps:
                raise ValueError(f"there is a step {name} already")
            self.steps[name] = Step(name, f, inputs, outputs or (name,), frozenset(tags))
            return f

        return add

    def by_output(self, output: str) -> list[Step]:
        return [s for s in self.steps.values() if output in s.outputs]

    def waves(self) -> list[list[Step]]:
        """Steps by level; those left in a cycle come last, together."""
        makers = {o: s.name for s in self.steps.values() for o in s.outputs}
        needs = {s.name: {makers[i] for i in s.inputs if i in makers and makers[i] != s.name} for s in self.steps.values()}
        out: list[list[Step]] = []
        done: set[str] = set()
        while len(done) < len(self.steps):
            ready = [n for n in self.steps if n not in done and needs[n] <= done] or [n for n in self.steps if n not in done]
            out.append([self.steps[n] for n in ready])
            done.update(ready)
        return out

    def run(self, spark: SparkSession, tables: dict[str, DataFrame], keep: bool = False) -> dict[str, DataFrame]:
        """All steps over the tables; with ``keep`` each result is written, so later waves don't compute it again."""
        known = dict(tables)
        for wave in self.waves():
            for step in wave:
                df = step.run(spark, **{i: known[i] for i in step.inputs})
                known[step.outputs[0]] = materialize(df) if keep else df
        return known
