"""Cleaning: rolling sigma clip and causal imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loomstep import windows
from loomstep.functions.scalar import clip, sanitize
from loomstep.operators.chunks import CHUNK_DAYS, CHUNK_ROWS, on_day_chunks, on_row_chunks
from loomstep.schema import DATE, KEYS, SYMBOL, TIME, free_prefix, require_columns


def rolling_sigma_clip(
    df: DataFrame,
    columns: list[str],
    *,
    bucket: str = "time_bucket",
    window: int = 50,
    k: float = 3.0,
    ddof: int = 1,
    min_valid: int = 10,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """df with each column held within k deviations of the mean of the window rows before it, same symbol and bucket.

    History is the raw one, never what was clipped before. Rows with fewer than min_valid earlier values stay.
    Rows are dealt out by symbol, bucket and chunk of about chunk_rows rows with the window rows before it, so the
    longest history is as many tasks as it has chunks.
    """
    require_columns(df, [*KEYS, bucket, *columns])
    if ddof not in (0, 1):
        raise ValueError("ddof is 0 or 1")
    if window < 1:
        raise ValueError("window is 1 or more")
    p = free_prefix(df)

    def clipped(rows: DataFrame, chunk: str) -> DataFrame:
        rows = rows.withColumns({c: sanitize(F.col(c)) for c in columns})
        others = [c for c in rows.columns if c not in columns]
        rows = _moments_before(rows, columns, [SYMBOL, bucket, chunk], window, p)

        def held(name: str) -> Column:
            x, n, mean = (F.col(c) for c in (name, f"{p}n_{name}", f"{p}mean_{name}"))
            std = F.sqrt(F.col(f"{p}m2_{name}") / F.when(n > ddof, n - ddof))
            return F.when(x.isNotNull() & (n >= max(min_valid, ddof + 1)), clip(x, mean - k * std, mean + k * std)).otherwise(x)

        return rows.select(*others, *(held(c).alias(c) for c in columns))

    return on_row_chunks(df, clipped, keys=[SYMBOL, bucket], halo=window, rows=chunk_rows).select(df.columns)


def _moments_before(rows: DataFrame, columns: list[str], keys: list[str], window: int, p: str) -> DataFrame:
    """rows with the number, mean and sum of squared deviations of each column's values in the window rows before.

    Each run is cut into blocks of window rows. The rows before one are the end of the last block, from window
    rows back, and the start of the own block; both are running aggregates, so a row costs the same however long
    the window is. The parts' deviations are taken from their own means, hence nothing cancels. p: a prefix that no
    column has.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(DATE, TIME)) - 1
    rows = rows.withColumn(f"{p}place", number).withColumn(f"{p}block", F.floor(F.col(f"{p}place") / window))
    block = Window.partitionBy(*keys, f"{p}block")
    start = block.orderBy(f"{p}place").rowsBetween(Window.unboundedPreceding, -1)
    end = windows.so_far(block.orderBy(F.desc(f"{p}place")))
    run = Window.partitionBy(*keys).orderBy(f"{p}place")
    parts = {"n": F.count, "mean": F.avg, "var": F.var_pop}
    rows = rows.select("*", *(f(c).over(start).alias(f"{p}{x}0_{c}") for c in columns for x, f in parts.items()))
    rows = rows.select("*", *(f(c).over(end).alias(f"{p}end_{x}_{c}") for c in columns for x, f in parts.items()))
    rows = rows.select("*", *(F.lag(f"{p}end_{x}_{c}", window).over(run).alias(f"{p}{x}1_{c}") for c in columns for x in parts))

    def joint(c: str) -> list[Column]:
        (n0, mean0, var0), (n1, mean1, var1) = ([F.coalesce(f"{p}{x}{i}_{c}", F.lit(0)) for x in parts] for i in (0, 1))
        n, apart = n0 + n1, mean1 - mean0
        share = n1 / F.when(n > 0, n)
        return [n.alias(f"{p}n_{c}"), (mean0 + apart * share).alias(f"{p}mean_{c}"), (n0 * var0 + n1 * var1 + apart * apart * n0 * share).alias(f"{p}m2_{c}")]

    return rows.select("*", *(x for c in columns for x in joint(c)))


def _carry(df: DataFrame, columns: list[str], over: WindowSpec, at: str, limit: int | None, only: Column | None = None) -> DataFrame:
    """Fills nulls with the last value before, if it lies no more than limit of at back (null: any distance)."""
    seen = windows.so_far(over)

    def filled(name: str) -> Column:
        x = F.col(name)
        value = F.last(x, ignorenulls=True).over(seen)
        where = F.last(F.when(x.isNotNull(), F.col(at)), ignorenulls=True).over(seen)
        near = F.lit(True) if limit is None else F.coalesce(F.col(at) - where <= limit, F.lit(False))
        return F.when(x.isNull() & near & (F.lit(True) if only is None else only), value).otherwise(x)

    return df.select(*(filled(c).alias(c) if c in columns else F.col(c) for c in df.columns))


def _opening(df: DataFrame, columns: list[str], ticks: tuple[int, int], ttl_days: int, *more: str) -> DataFrame:
    opening = (F.col(TIME) >= ticks[0]) & (F.col(TIME) < ticks[1])
    return _carry(df, columns, windows.of_symbol(*more), DATE, ttl_days, opening)


def impute_open(df: DataFrame, columns: list[str], *, ticks: tuple[int, int] = (0, 10), ttl_days: int = 5, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """First ticks of a day, from ticks[0] up to but without ticks[1]: the symbol's last value up to ttl_days old."""
    return on_day_chunks(df, lambda rows, chunk: _opening(rows, columns, ticks, ttl_days, chunk), halo=ttl_days, days=chunk_days)


def impute_intraday(df: DataFrame, columns: list[str], *, max_gap: int | None = 100, keys: tuple[str, ...] = ()) -> DataFrame:
    """The day's last value up to max_gap ticks before; None: however far. keys: those by which df is dealt besides the symbol."""
    return _carry(df, columns, windows.of_day(*keys), TIME, max_gap)


def impute_same_tick(df: DataFrame, columns: list[str], *, ttl_days: int | None = 5, keys: tuple[str, ...] = ()) -> DataFrame:
    """The last value at the same tick up to ttl_days before; None: no such step."""
    return df if ttl_days is None else _carry(df, columns, windows.of_tick(*keys), DATE, ttl_days)


def causal_impute(
    df: DataFrame,
    columns: list[str],
    *,
    open_ticks: tuple[int, int] = (0, 10),
    ttl_days_open: int = 5,
    max_gap: int | None = 100,
    ttl_days_same_tick: int | None = 5,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Four steps, each on the result of the one before: open, intraday, same tick, intraday again.

    No value is carried over more days than the two limits together, so rows are dealt out by symbol and chunk of days
    with that many days before it; one exchange serves all steps, and a long history is many tasks.
    """
    require_columns(df, [*KEYS, *columns])

    def filled(rows: DataFrame, chunk: str) -> DataFrame:
        rows = _opening(rows, columns, open_ticks, ttl_days_open, chunk)
        rows = impute_intraday(rows, columns, max_gap=max_gap, keys=(chunk,))
        rows = impute_same_tick(rows, columns, ttl_days=ttl_days_same_tick, keys=(chunk,))
        return impute_intraday(rows, columns, max_gap=max_gap, keys=(chunk,))

    return on_day_chunks(df, filled, halo=ttl_days_open + (ttl_days_same_tick or 0), days=chunk_days)


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.coalesce(c, F.lit(0.0)).alias(c) if c in columns else c for c in df.columns))
