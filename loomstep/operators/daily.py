"""Stage A: features of the day before, from a daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstep.schema import DATE, KEYS, SYMBOL, TIME, require_columns


def tail_lags(lags: tuple[int, ...], diffs: tuple[int, ...]) -> list[int]:
    """The places from the end of a day that a stage needs: its own, those of its differences, and the last one."""
    return sorted({*lags, *(k + 1 for k in diffs), 1})


def daily_values(df: DataFrame, columns: list[str], lags: list[int]) -> DataFrame:
    """Per symbol and day: close (last by time, null or not), mean, deviation and the L-th value from the end.

    A day's ticks are gathered in one array of rows, which a day bounds; rows of null values count as places.
    The times of the day's ticks stay as times.
    """
    require_columns(df, [*KEYS, *columns])
    ticks = F.sort_array(F.collect_list(F.struct(TIME, *columns)))
    stats = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.avg, "mean"), (F.stddev_samp, "std"))]
    rows = df.groupBy(SYMBOL, DATE).agg(ticks.alias("_ticks"), *stats)
    tails = [F.try_element_at("_ticks", F.lit(-k))[c].alias(f"{c}_tail{k}") for c in columns for k in lags]
    closes = [F.try_element_at("_ticks", F.lit(-1))[c].alias(f"{c}_close") for c in columns]
    times = F.transform("_ticks", lambda t: t[TIME]).alias("times")
    return rows.select(SYMBOL, DATE, times, *closes, *(f"{c}_{n}" for c in columns for n in ("mean", "std")), *tails)


def day_streaks(df: DataFrame) -> DataFrame:
    """Daily rows with gap (days since the symbol's day before, 1 for its first) and streak (runs of gap 1)."""
    w = Window.partitionBy(SYMBOL).orderBy(F.asc_nulls_last(DATE))  # a null day changes no other
    gap = F.coalesce(F.col(DATE) - F.lag(DATE).over(w), F.lit(1))
    rows = df.withColumn("gap", gap)
    run = F.sum((F.col("gap") != 1).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("streak", run.cast("int"))


def daily_features(
    df: DataFrame,
    columns: list[str],
    *,
    lags: tuple[int, ...] = (1,),
    diffs: tuple[int, ...] = (1,),
    rolling: tuple[int, ...] = (3,),
    cast: str = "float",
) -> DataFrame:
    """The daily table of stage A, one row per symbol and day with its times, and all values moved on by one day.

    A day takes values only from the day right before it; after a gap all are null.
    """
    places = tail_lags(lags, diffs)
    day = day_streaks(daily_values(df, columns, places))
    w = Window.partitionBy(SYMBOL).orderBy(F.asc_nulls_last(DATE))
    run = Window.partitionBy(SYMBOL, "streak").orderBy(F.asc_nulls_last(DATE))
    next_to = F.col("gap") == 1
    own: dict[str, object] = {}
    for c in columns:
        close, before = F.col(f"{c}_close"), F.when(next_to, F.lag(f"{c}_close").over(w))
        own |= {f"{c}_prev_tail_lag{k}": F.col(f"{c}_tail{k}") for k in places}
        own |= {f"{c}_prevday_{n}": F.col(f"{c}_{n}") for n in ("close", "mean", "std")}
        own |= {f"{c}_prev_tail_d{k}": F.col(f"{c}_tail1") - F.col(f"{c}_tail{k + 1}") for k in sorted(set(diffs))}
        own |= {f"{c}_prev2day_close": before, f"{c}_overnight_gap": close - before, f"{c}_prevday_close_minus_mean": close - F.col(f"{c}_mean")}
        for n in rolling:
            frame = run.rowsBetween(1 - n, 0)
            own |= {f"{c}_close_roll{n}_mean": F.avg(close).over(frame), f"{c}_close_roll{n}_std": F.stddev_samp(close).over(frame)}
    day = day.select(SYMBOL, DATE, "times", "gap", *(e.alias(n) for n, e in own.items()))
    return day.select(SYMBOL, DATE, "times", *(F.when(next_to, F.lag(n).over(w)).cast(cast).alias(n) for n in own))


def stage_a(df: DataFrame, columns: list[str], **parameters) -> DataFrame:
    """Ticks (keys only) with the features of daily_features(). Each day unfolds into its ticks again, so nothing is joined.

    Rows of a null symbol or day have no features.
    """
    day = daily_features(df, columns, **parameters)
    names = [c for c in day.columns if c not in (SYMBOL, DATE, "times")]
    known = F.col(SYMBOL).isNotNull() & F.col(DATE).isNotNull()
    ticks = day.select(SYMBOL, DATE, F.explode("times").alias(TIME), *(F.when(known, F.col(n)).alias(n) for n in names))
    return ticks.select(*KEYS, *names)
