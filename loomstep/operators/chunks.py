"""Long histories in chunks: windows over a symbol that don't gather all of it in one task.

A chunk is a key beside the symbol. Each chunk also gets the rows before it that its windows look back on (its halo);
what is made there is dropped, so results are those of the whole history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstep.schema import DATE, SYMBOL, free_names

#: Rows of a symbol and bucket in a chunk, about.
CHUNK_ROWS = 65_536
#: Days of a symbol in a chunk.
CHUNK_DAYS = 60

Make = Callable[[DataFrame, str], DataFrame]


def _unfold(first: Column, last: Column) -> Column:
    """The numbers from first to last; null where they are null, so that such rows stay."""
    return F.coalesce(F.sequence(first, last), F.array(F.lit(None).cast("long")))


def on_day_chunks(df: DataFrame, make: Make, *, halo: int, days: int = CHUNK_DAYS) -> DataFrame:
    """make(rows, chunk) over chunks of so many calendar days of a symbol, each with halo days before it.

    make's windows have the column chunk among their keys, then one exchange serves all of them. A row is copied to
    the chunks in whose halo it lies, halo / days of all rows. Rows of a null day are a chunk.
    """
    days = max(days, halo, 1)
    [chunk] = free_names(df, "chunk")
    of = lambda d: F.floor(d / F.lit(days))
    rows = df.withColumn(chunk, F.explode(_unfold(of(F.col(DATE)), of(F.col(DATE) + halo))))
    made = make(rows.repartition(SYMBOL, chunk), chunk)
    return made.where(of(F.col(DATE)).eqNullSafe(F.col(chunk))).drop(chunk)


def on_row_chunks(df: DataFrame, make: Make, *, keys: list[str], halo: int, rows: int = CHUNK_ROWS) -> DataFrame:
    """make(rows, chunk) over chunks of about so many rows of each group of keys, in the order of days, each with at least halo rows before it.

    Days are dealt out whole, by how many rows of the group come before them: a table of a row for each group and day,
    counted from the keys alone. A day between rows * k and rows * (k + 1) is in chunk k, and in the halo of each
    chunk that begins less than halo rows after it.
    """
    rows = max(rows, halo, 1)
    chunk, first, n = free_names(df, "chunk", "first", "n")
    group = [*keys, DATE]
    other = free_names(df, *(f"day_{k}" for k in group))
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias(n))
    before = F.sum(n).over(Window.partitionBy(*keys).orderBy(DATE).rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn(first, F.coalesce(before, F.lit(0)))
    own, last = F.floor(F.col(first) / rows), F.floor((F.col(first) + F.col(n) + halo - 1) / rows)
    day = sizes.select(*(F.col(k).alias(o) for k, o in zip(group, other, strict=True)), own.alias(first), F.sequence(own, last).alias(chunk))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(group, other, strict=True)]
    # The hint keeps the rows from being broadcast: by its estimates Spark takes the days to be larger.
    dealt = df.join(day.hint("shuffle_hash"), same).drop(*other).withColumn(chunk, F.explode(chunk))
    made = make(dealt.repartition(*keys, chunk), chunk)
    return made.where(F.col(chunk) == F.col(first)).drop(chunk, first)
