"""Sliding cross-validation over days, and the score."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstep.schema import DATE


class Fold(NamedTuple):
    """Half-open ranges of day numbers."""

    fold: int
    tr_lo: int
    tr_hi: int
    va_lo: int
    va_hi: int


def sliding_folds(n_days: int, n_splits: int, gap: int = 5, train_to_val: int = 9) -> list[Fold]:
    """Validation ranges in a row after one training range and a gap; training is train_to_val times as long.

    What the division leaves goes to the first folds, one day each. Folds that don't fit are left out.
    """
    size, more = divmod(n_days - gap, train_to_val + n_splits)
    if size < 1:
        return []
    train, folds = train_to_val * size, []
    at = train + gap
    for k in range(n_splits):
        end = at + size + (k < more)
        if end > n_days or at - gap - train < 0:
            break
        folds.append(Fold(k + 1, at - gap - train, at - gap, at, end))
        at = end
    return folds


def day_index(df: DataFrame) -> DataFrame:
    """(date_id, day): number of each day among the distinct ones; as many rows as there are days."""
    return df.select(DATE).distinct().withColumn("day", F.row_number().over(Window.orderBy(DATE)) - 1)


def fold_table(df: DataFrame, n_splits: int, gap: int = 5, train_to_val: int = 9) -> DataFrame:
    n = df.select(DATE).distinct().count()
    schema = "fold int, tr_lo int, tr_hi int, va_lo int, va_hi int"
    return df.sparkSession.createDataFrame([tuple(f) for f in sliding_folds(n, n_splits, gap, train_to_val)], schema)


def assign_folds(df: DataFrame, folds: DataFrame) -> DataFrame:
    """df with fold and part (train or valid): a row for each fold that a row's day is in.

    Folds are expanded to days first, so rows meet them by an equality of dates. The days, a row for each day and fold, are
    what is broadcast: by its estimates Spark takes a join of days to be larger than the rows and would send those.
    """
    spans = [("train", "tr_lo", "tr_hi"), ("valid", "va_lo", "va_hi")]
    parts = [folds.select("fold", F.lit(p).alias("part"), F.explode(F.sequence(F.col(a), F.col(b) - 1)).alias("day")) for p, a, b in spans]
    days = parts[0].union(parts[1]).join(day_index(df), "day").select(DATE, "fold", "part")
    return df.join(F.broadcast(days), DATE)


def weighted_r2(df: DataFrame, y: str, prediction: str, weight: str | None = None, by: list[str] | None = None, centred: bool = True) -> DataFrame:
    """wr2 = 1 - sum w (y - p)^2 / sum w (y - mean)^2; null weight: 1; centred: mean is the weighted one, else 0.

    Two passes, as the deviations are taken around the first one's mean, and with by a join to the means; both aggregate before the shuffle.
    """
    w = F.coalesce(F.col(weight), F.lit(1.0)) if weight else F.lit(1.0)
    mean = F.sum(w * F.col(y)) / F.greatest(F.sum(w), F.lit(1e-12))
    means = df.groupBy(*(by or [])).agg(mean.alias("_mean"))
    if by:
        rows = df.join(means, by)
    else:
        rows = df.withColumn("_mean", F.lit(means.first()["_mean"]))
    middle: Column = F.col("_mean") if centred else F.lit(0.0)
    error = F.sum(w * (F.col(y) - F.col(prediction)) ** 2)
    spread = F.sum(w * (F.col(y) - middle) ** 2)
    return rows.groupBy(*(by or [])).agg((1 - error / F.greatest(spread, F.lit(1e-12))).alias("wr2"))


def fold_summary(scores: DataFrame, score: str = "wr2") -> DataFrame:
    return scores.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.count(score).alias("n"))
