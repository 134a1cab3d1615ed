"""Concept dictionaries (JSON): aggregates, ranges and items that a concept defines."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from os import PathLike

from staygrid.sources.place import Place


def _numbers(node: object, key: str) -> Iterator[float]:
    """Numbers under `key`, depth first; truth values aren't numbers."""
    if isinstance(node, dict):
        value = node.get(key)
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            yield float(value)
    for child in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
        yield from _numbers(child, key)


@dataclass(frozen=True)
class ConceptDict:
    """What is defined of each concept; unknown concepts define nothing."""

    concepts: dict[str, dict] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str | PathLike | None) -> ConceptDict:
        """A JSON object of concepts, or one with such an object under 'concepts'."""
        if path is None:
            return cls()
        raw = json.loads(Place(path).read_text())
        if isinstance(raw, dict) and isinstance(raw.get("concepts"), dict):
            raw = raw["concepts"]
        if not isinstance(raw, dict):
            raise ValueError(f"{path} isn't a JSON object of concepts")
        return cls(raw)

    def concept(self, name: str) -> dict:
        found = self.concepts.get(name)
        return found if isinstance(found, dict) else {}

    def bounds(self, name: str) -> tuple[float | None, float | None]:
        """The first min and the first max anywhere in the concept."""
        low, high = (next(_numbers(self.concept(name), k), None) for k in ("min", "max"))
        return low, high

    def aggregate(self, name: str, default: str = "mean") -> str:
        texts = (self.concept(name).get(k) for k in ("aggregate", "aggregation", "fun"))
        return next((t for t in texts if isinstance(t, str)), default)
