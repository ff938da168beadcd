"""Keys of a panel and checks of its columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

SYMBOL, DATE, TIME = "symbol_id", "date_id", "time_id"
KEYS = (SYMBOL, DATE, TIME)


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def positive_ints(values: Iterable[int], what: str) -> list[int]:
    """Sorted distinct integers from 1 on; none at all is an error."""
    kept = sorted({int(v) for v in values if int(v) >= 1})
    if not kept:
        raise ValueError(f"{what} needs an integer from 1 on")
    return kept


def ordered_unique(names: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(names))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for temporary columns like those wanted, none of which df has, whatever the case of its letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def free_prefix(df: DataFrame) -> str:
    """Underscores with which no column of df begins."""
    p = "_"
    while any(c.startswith(p) for c in df.columns):
        p += "_"
    return p
