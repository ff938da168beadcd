"""Boosted trees per fold, importance of features, selection, search of parameters, refit."""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstep.operators.boosting import Binned, Model, fit
from loomstep.operators.crossval import assign_folds, fold_summary
from loomstep.schema import ordered_unique
from loomstep.sources.dated import write_names
from loomstep.sources.settings import Trees


def fit_fold(binned: Binned, folds: DataFrame, fold: int, trees: Trees = Trees()) -> Model:
    """The model of one fold, which its validation days judge; all folds read the same binned rows."""
    own = assign_folds(binned.rows, folds.where(F.col("fold") == fold))
    return fit(binned, own.withColumn("valid", F.col("part") == "valid"), trees)


def fit_folds(binned: Binned, folds: DataFrame, trees: Trees = Trees()) -> tuple[DataFrame, DataFrame]:
    """(scores, importance): the best wr2 of each fold and its round, and the gain share of each feature averaged over folds."""
    spark = binned.rows.sparkSession
    numbers = [r["fold"] for r in folds.select("fold").orderBy("fold").collect()]
    models = [fit_fold(binned, folds, k, trees) for k in numbers]
    scores = [(k, max(m.scores, default=None), len(m.trees)) for k, m in zip(numbers, models, strict=True)]
    shares = [(k, c, s) for k, m in zip(numbers, models, strict=True) for c, s in zip(binned.features, m.gain_shares(), strict=True)]
    importance = spark.createDataFrame(shares, "fold int, feature string, share double").groupBy("feature").agg(F.avg("share").alias("gain_share"))
    return spark.createDataFrame(scores, "fold int, wr2 double, rounds int"), importance


def top_features(importance: DataFrame, k: int, always: list[str] = (), score: str = "gain_share") -> DataFrame:
    """(rank, feature): those always kept, then the k best others, of equal ones by name."""
    best = importance.where(~F.col("feature").isin(list(always))) if always else importance
    names = [r["feature"] for r in best.orderBy(F.desc(score), "feature").limit(k).select("feature").collect()]
    return importance.sparkSession.createDataFrame(list(enumerate(ordered_unique([*always, *names]), 1)), "rank int, feature string")


def select_features(binned: Binned, folds: DataFrame, path: str, *, k: int, always: list[str] = (), trees: Trees = Trees()) -> DataFrame:
    """top_features() by gain share over the folds, its names written to path, one a line; returns (rank, feature)."""
    _, importance = fit_folds(binned, folds, trees)
    best = top_features(importance, k, always)
    write_names(binned.rows.sparkSession, [r["feature"] for r in best.orderBy("rank").collect()], path)
    return best


def refit_rounds(best: list[int]) -> int:
    """Rounds of a fit on the whole window from those of the folds."""
    return max(50, int(sum(best) / len(best) * 1.10))


def refit(binned: Binned, best: list[int], trees: Trees = Trees()) -> Model:
    """A model of all binned rows, with refit_rounds(best) rounds; best: those of the folds."""
    return fit(binned, binned.rows.withColumn("valid", F.lit(False)), replace(trees, rounds=refit_rounds(best)))


#: A range (low, high) to draw from: whole numbers, or real ones.
Space = dict[str, tuple[int, int] | tuple[float, float]]


def draw(space: Space, rng: random.Random) -> dict:
    return {c: rng.randint(a, b) if isinstance(a, int) else rng.uniform(a, b) for c, (a, b) in space.items()}


def propose(space: Space, past: list[tuple[dict, float]], rng: random.Random, *, share: float = 0.25, candidates: int = 24) -> dict:
    """The next point by Parzen densities: of some drawn near good past points, the one most likely good rather than bad.

    The best share of past points are good. A density has a bump around each of its points and one over the whole
    range, parameter by parameter; bumps are narrower the more points there are.
    """
    ranked = sorted(past, key=lambda x: -x[1])
    n = max(1, math.ceil(share * len(ranked)))
    good, bad = [p for p, _ in ranked[:n]], [p for p, _ in ranked[n:]]

    def width(c: str, points: list[dict]) -> float:
        a, b = space[c]
        return max((b - a) / max(len(points), 1) ** 0.8, (b - a) / 100, 1e-12)

    def density(c: str, x: float, points: list[dict]) -> float:
        a, b = space[c]
        s = width(c, points)
        bumps = sum(math.exp(-0.5 * ((x - p[c]) / s) ** 2) / (s * math.sqrt(2 * math.pi)) for p in points)
        return (bumps + 1 / max(b - a, 1e-12)) / (len(points) + 1)

    def near() -> dict:
        found = {}
        for c, (a, b) in space.items():
            at = rng.randrange(len(good) + 1)
            x = rng.uniform(a, b) if at == len(good) else min(max(rng.gauss(good[at][c], width(c, good)), a), b)
            found[c] = round(x) if isinstance(a, int) else x
        return found

    tried = [near() for _ in range(candidates)]
    return max(tried, key=lambda p: sum(math.log(density(c, p[c], good)) - math.log(density(c, p[c], bad)) for c in space))


def search(space: Space, score, *, trials: int = 30, first: int = 10, at_once: int = 1, seed: int = 42) -> list[tuple[dict, float]]:
    """(point, score) of each trial in order: the first ones at random, each later one by propose() from all before its batch.

    score: a point to its score, the higher the better. at_once: trials that run together, each in a thread of its own.
    """
    rng, past = random.Random(seed), []
    while len(past) < trials:
        n = min(at_once, trials - len(past))
        points = [draw(space, rng) if len(past) < first else propose(space, past, rng) for _ in range(n)]
        if n == 1:
            past.append((points[0], score(points[0])))
        else:
            with ThreadPoolExecutor(n) as pool:
                past += zip(points, pool.map(score, points), strict=True)
    return past


def search_parameters(binned: Binned, folds: DataFrame, *, space: Space, trials: int = 30, first: int = 10, at_once: int = 1, trees: Trees = Trees(), seed: int = 42) -> DataFrame:
    """(trial, a column for each parameter, mean_wr2, std_wr2), the best trial first: search() over the folds' mean wr2.

    space: ranges of fields of Trees; the other fields are those of trees. All trials read the same binned rows.
    """
    spreads: dict[tuple, float] = {}

    @inheritable_thread_target(binned.rows.sparkSession)
    def score(point: dict) -> float:
        found = fold_summary(fit_folds(binned, folds, replace(trees, **point))[0]).first()
        spreads[tuple(point.values())] = found["std"]
        return found["mean"]

    done = search(space, score, trials=trials, first=first, at_once=at_once, seed=seed)
    rows = [(i, *map(float, p.values()), v, spreads[tuple(p.values())]) for i, (p, v) in enumerate(done)]
    fields = ", ".join(["trial int", *(f"{c} double" for c in space), "mean_wr2 double, std_wr2 double"])
    return binned.rows.sparkSession.createDataFrame(rows, fields).orderBy(F.desc("mean_wr2"), "trial")
