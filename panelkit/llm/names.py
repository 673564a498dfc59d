"""Names of helper columns that no caller's column has."""

from __future__ import annotations

from collections.abc import Iterable


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The ``wanted`` names, lengthened until none is that of a column; Spark ignores case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
