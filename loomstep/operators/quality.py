"""Data quality of a panel: duplicates, gaps, nulls, spreads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstep.schema import DATE, KEYS, SYMBOL


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def distinct_days(df: DataFrame) -> DataFrame:
    return df.select(DATE).distinct()


def date_gaps(df: DataFrame) -> DataFrame:
    """Per symbol with gaps in its days: their number, longest, shortest, days between less one, and missing days.

    total_missing_dates takes one off the sum of all gaps, missing_dates one off each gap.
    """
    w = Window.partitionBy(SYMBOL).orderBy(DATE)
    gaps = df.select(SYMBOL, DATE).distinct().withColumn("gap", F.col(DATE) - F.lag(DATE).over(w)).where("gap > 1")
    return gaps.groupBy(SYMBOL).agg(
        F.count(F.lit(1)).alias("n_gaps"),
        F.max("gap").cast("long").alias("max_gap"),
        F.min("gap").cast("long").alias("min_gap"),
        (F.sum("gap") - 1).alias("total_missing_dates"),
        F.sum(F.col("gap") - 1).alias("missing_dates"),
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def null_fractions(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per day, the share of nulls in each column."""
    return df.groupBy(DATE).agg(*(F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_null_frac") for c in columns))


def null_fractions_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """null_fractions() with a row for each day and column."""
    wide = null_fractions(df, columns)
    long = wide.unpivot(DATE, [f"{c}_null_frac" for c in columns], "feature", "null_frac")
    return long.withColumn("feature", F.regexp_replace("feature", "_null_frac$", ""))


def null_fractions_pivot(df: DataFrame, columns: list[str], days: list[int]) -> DataFrame:
    """A row for each column and a column for each of the given days."""
    long = null_fractions_long(df, columns)
    return long.groupBy("feature").pivot(DATE, days).agg(F.first("null_frac")).select("feature", *(F.col(str(d)).alias(f"day_{d}") for d in days))


def symbol_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    kinds = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return df.groupBy(SYMBOL).agg(*(f(c).alias(f"{c}_{n}") for c in columns for n, f in kinds.items()))


def distinct_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Distinct values other than null of each column, per symbol or whatever by names; an empty by: of the whole."""
    by = [SYMBOL] if by is None else by
    return df.groupBy(*by).agg(*(F.count_distinct(c).alias(f"{c}_n_unique") for c in columns))


def low_deviation(df: DataFrame, columns: list[str], least: float = 1e-5) -> DataFrame:
    """Symbols and columns whose deviation is below least, tested for every symbol."""
    stats = df.groupBy(SYMBOL).agg(*(F.stddev_samp(c).alias(c) for c in columns))
    return stats.unpivot(SYMBOL, columns, "feature", "std").where(F.col("std") < least)
