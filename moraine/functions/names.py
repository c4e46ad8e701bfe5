"""Column-name handling: case-insensitive lookup and safe quoting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The top-level column of exactly this name, dots and spaces included."""
    return F.col(quoted(name))


def by_lower_name(names: Iterable[str]) -> dict[str, str]:
    """Map lower-case name -> name as spelled; two names that are the same but for case are an error."""
    found: dict[str, str] = {}
    for name in names:
        lower = name.lower()
        if lower in found:
            raise ValueError(f"columns {found[lower]!r} and {name!r} differ only in case, if at all")
        found[lower] = name
    return found


def require(names: Iterable[str], wanted: str) -> str:
    """The spelling of ``wanted`` among ``names``; raises when it is not there."""
    names = list(names)
    found = by_lower_name(names).get(wanted.lower())
    if found is None:
        raise ValueError(f"column {wanted!r} is not among {names}")
    return found
