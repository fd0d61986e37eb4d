"""Column names."""

from __future__ import annotations

from collections.abc import Iterable


def q(name: str) -> str:
    """Quote an identifier for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"


def unused(base: str, taken: Iterable[str]) -> str:
    """``base``, or ``base`` with a number behind it, that is not among ``taken`` in any case."""
    lower = {t.lower() for t in taken}
    name, n = base, 0
    while name.lower() in lower:
        n += 1
        name = f"{base}{n}"
    return name
