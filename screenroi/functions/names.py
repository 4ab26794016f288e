"""Column-name handling: snake case, synonym resolution, required-column checks.

These act on schema metadata only (driver side, no data is touched).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

_NON_ALNUM = re.compile(r"[^0-9A-Za-z]+")


def snake_case(name: str) -> str:
    """``' Movie-ID '`` -> ``'movie_id'``: trim, runs of non-alphanumerics become one
    underscore, leading/trailing underscores removed, lower case."""
    collapsed = _NON_ALNUM.sub("_", name.strip())
    return collapsed.strip("_").lower()


class ColumnCollisionError(ValueError):
    """Two source columns normalise to the same snake-case name."""


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake case in one projection.

    Raises ``ColumnCollisionError`` when two names collide (``Movie ID`` and
    ``movie-id``), which would otherwise make later references ambiguous.
    """
    targets = [snake_case(c) for c in df.columns]
    seen: dict[str, str] = {}
    for original, target in zip(df.columns, targets):
        if target in seen:
            raise ColumnCollisionError(
                f"Columns {seen[target]!r} and {original!r} both normalise to {target!r}"
            )
        seen[target] = original
    if targets == list(df.columns):
        return df
    return df.toDF(*targets)


class MissingColumnsError(ValueError):
    """An input lacks columns that an operator cannot do without."""


def resolve_columns(columns: Sequence[str], synonyms: Mapping[str, Sequence[str]], needed: Iterable[str] = (),
                    what: str = "input", strip: bool = False) -> dict[str, str | None]:
    """For each role its column: the first synonym present (any case; ``strip`` also ignores blanks
    around column names), else None. Roles in ``needed`` must have one."""
    present = {(c.strip() if strip else c).lower(): c for c in reversed(columns)}  # the leftmost of equal names wins
    found = {role: next((present[n] for n in names if n in present), None) for role, names in synonyms.items()}
    lacking = [role for role in needed if found[role] is None]
    if lacking:
        told = "; ".join(f"{role} (one of {', '.join(synonyms[role])})" for role in lacking)
        raise MissingColumnsError(f"The {what} has no column for {told}. It has {list(columns)}.")
    return found


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    """Like :func:`resolve_columns` for columns that go by one name."""
    names = sorted(required)
    resolve_columns(df.columns, {n: (n,) for n in names}, names, f"{what} data")
