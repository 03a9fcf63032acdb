"""Column names for helpers that no column of a table has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted``, each with as many underscores behind it as make it differ from all taken names, whatever their case."""
    held = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out
