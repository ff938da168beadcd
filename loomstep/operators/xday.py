"""Stage B: the same tick on the days before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstep import windows
from loomstep.functions.scalar import EPS, row_count, row_mean, row_std, trend_weights
from loomstep.schema import DATE, KEYS, positive_ints, require_columns


def same_tick(df: DataFrame, columns: list[str], lags: list[int]) -> DataFrame:
    """Keys and {column}_same_t_prev{k}: the value of the tick k rows back, if that is exactly k days back.

    So all days between must have the tick; a join on the date k days before would be looser.
    """
    require_columns(df, [*KEYS, *columns])
    w = windows.of_tick()
    value = lambda c, k: F.when(F.col(DATE) - F.lag(DATE, k).over(w) == k, F.lag(c, k).over(w))
    return df.select(*KEYS, *(value(c, k).alias(f"{c}_same_t_prev{k}") for c in columns for k in lags))


def stage_b(
    df: DataFrame,
    columns: list[str],
    *,
    lags: tuple[int, ...],
    stats_columns: list[str] | None = None,
    across: bool = True,
    cast: str = "float",
) -> DataFrame:
    """Lags of the same tick, their mean, deviation and slope per column, and across columns for one day back.

    The slope is 0 where fewer than two lags have values. across applies if 1 is among the lags.
    """
    lags = positive_ints(lags, "lags")
    rows = same_tick(df, columns, lags)
    n, weights, made = len(lags), trend_weights(len(lags)), {}
    for c in [c for c in columns if stats_columns is None or c in stats_columns]:
        past = [F.col(f"{c}_same_t_prev{k}") for k in lags]
        mean, std = row_mean(past), row_std(past)
        terms = [F.coalesce(w * ((v - mean) / (std + EPS)), F.lit(0.0)) for w, v in zip(weights, past, strict=True)]
        slope = reduce(lambda a, b: a + b, terms) / F.greatest(row_count(past), F.lit(1))
        made |= {f"{c}_same_t_last{n}_mean": mean, f"{c}_same_t_last{n}_std": std, f"{c}_same_t_last{n}_slope": slope}
    if across and 1 in lags:
        near = [F.col(f"{c}_same_t_prev1") for c in columns]
        made |= {f"prev1_same_t_mean_{len(columns)}rep": row_mean(near), f"prev1_same_t_std_{len(columns)}rep": row_std(near)}
    plain = [c for c in rows.columns if c not in KEYS]
    return rows.select(*KEYS, *(F.col(c).cast(cast).alias(c) for c in plain), *(e.cast(cast).alias(c) for c, e in made.items()))
