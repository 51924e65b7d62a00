"""Column names for operators that carry columns of any name."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], name: str) -> str:
    """`name`, with marks before it until no column has it, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def carried(carry: Iterable[str], made: Iterable[str]) -> list[str]:
    """The columns to carry: those that the made ones don't replace, each once."""
    taken = {c.lower() for c in made}
    out = []
    for c in carry:
        if c.lower() not in taken:
            taken.add(c.lower())
            out.append(c)
    return out
