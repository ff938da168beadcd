"""Scalar expressions; null stays null, and no non-finite value comes out of sanitize()."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def clip_upper(x: Column, bound: Column | float) -> Column:
    return F.when(x > bound, bound).otherwise(x)


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    """least() and greatest() skip nulls, so a null x is kept apart."""
    put = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(x.isNotNull(), F.least(F.greatest(x, put(low)), put(high)))


def sanitize(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def time_bucket(time: Column, daily_ticks: int = 968, buckets: int = 6) -> Column:
    """The part of the day in which a tick lies; ticks beyond daily_ticks are in the last one."""
    at = F.floor(time * buckets / F.lit(daily_ticks)).cast("int")
    return clip_upper(at, F.lit(buckets - 1)).cast("byte")


def cyclic_time(time: Column, daily_ticks: int = 968) -> dict[str, Column]:
    phase = time * (2 * math.pi / daily_ticks)
    return {"time_pos": time.cast("float"), "time_sin": F.sin(phase).cast("float"), "time_cos": F.cos(phase).cast("float")}


def row_count(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])


def row_sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])


def row_mean(columns: list[Column]) -> Column:
    """Mean of the columns that are not null; null if all are."""
    return F.try_divide(row_sum(columns), row_count(columns))


def row_std(columns: list[Column]) -> Column:
    """Sample deviation of the columns that are not null; null below two."""
    mean, n = row_mean(columns), row_count(columns)
    return F.sqrt(F.try_divide(row_sum([(c - mean) * (c - mean) for c in columns]), F.when(n > 1, n - 1)))


def trend_weights(n: int) -> list[float]:
    """n, n - 1, ... 1, centred and scaled: the weights of a slope from the most recent value back."""
    mean = (n + 1) / 2
    std = math.sqrt(sum((x - mean) ** 2 for x in range(1, n + 1)) / n)
    return [(x - mean) / (std + EPS) for x in range(n, 0, -1)]
