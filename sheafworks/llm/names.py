"""Column names that an input doesn't have."""

from __future__ import annotations

from collections.abc import Iterable


def free(name: str, taken: Iterable[str]) -> str:
    """``name``, with as many underscores as it takes to differ from all of ``taken`` (case doesn't count, as in Spark)."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name
