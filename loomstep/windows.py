"""Window specifications of a panel. Each has an explicit order, since a DataFrame has none of its own."""

from __future__ import annotations

from pyspark.sql import Window, WindowSpec

from loomstep.schema import DATE, SYMBOL, TIME


def of_symbol(*more: str) -> WindowSpec:
    """more: further keys, such as a chunk of the history, here and below."""
    return Window.partitionBy(SYMBOL, *more).orderBy(DATE, TIME)


def of_day(*more: str) -> WindowSpec:
    return Window.partitionBy(SYMBOL, *more, DATE).orderBy(TIME)


def of_tick(*more: str) -> WindowSpec:
    """The same tick on the days of a symbol."""
    return Window.partitionBy(SYMBOL, *more, TIME).orderBy(DATE)


def of_streak(*more: str) -> WindowSpec:
    return Window.partitionBy(SYMBOL, *more, "streak").orderBy(DATE, TIME)


def across_symbols() -> WindowSpec:
    return Window.partitionBy(DATE, TIME)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(1 - n, Window.currentRow)
