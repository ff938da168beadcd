"""Character Markov models as DataFrames: counts over a small alphabet, smoothed, and a table of log ratios.

Characters are mapped to a fixed alphabet, so the counts and the tables have a size that does not depend on
the input. A table is a frame of one row; scores look values of it up inside expressions, as a scalar subquery,
so that its numbers are in no plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import materialize

#: Steps of a score among which a threshold is chosen, and the range that they cover.
STEPS, RANGE = 800, 4.0


def codes(text: Column, alphabet: str) -> Column:
    """The characters of a text as an array of numbers: 1 to len(alphabet), 0 for any other character."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(letters, lambda c: F.instr(F.lit(alphabet), c))


def gram_counts(rows: DataFrame, label: str, code: str, order: int, size: int, weight: str | None = None) -> DataFrame:
    """(label, gram, n): how often each context of order codes and the code after it occur; 0 stands before the start.

    A gram is the number that its codes make to the base of size. Counts are summed before the shuffle.
    """
    padded = F.concat(F.array_repeat(F.lit(0), order), F.col(code))
    grams = F.transform(F.sequence(F.lit(1), F.size(code)), lambda i: _gram([F.get(padded, i + (k - 1)) for k in range(order + 1)], size))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    keep = [label, *([weight] if weight else [])]
    return rows.where(F.size(code) > 0).select(*keep, F.explode(grams).alias("gram")).groupBy(label, "gram").agg(n.cast("double").alias("n"))


def _gram(parts: list[Column], size: int) -> Column:
    return reduce(lambda a, b: a * size + b, parts)


def log_ratio_table(counts: DataFrame, label: str, order: int, size: int, strength: float = 1.0) -> DataFrame:
    """One row with t: for each gram, the log-probability of its last code after the others under label 1 less that under label 0.

    Variable order: the estimate after a context of k codes is its count plus strength times the estimate
    after the last k - 1 codes, over the context's count plus strength; so a context that was seen often
    decides, and one that was not leaves it to the shorter ones. The table has size ** (order + 1) numbers.
    """
    spark = counts.sparkSession
    lower = None
    for k in range(order + 1):
        n = size ** (k + 1)
        by = counts.groupBy(F.pmod("gram", F.lit(n)).alias("gram")).agg(*(F.sum(F.when(F.col(label) == v, F.col("n")).otherwise(0.0)).alias(f"n{v}") for v in (0, 1)))
        context = by.groupBy(F.floor(F.col("gram") / size).alias("context")).agg(*(F.sum(f"n{v}").alias(f"c{v}") for v in (0, 1)))
        grid = spark.range(n).select(F.col("id").alias("gram"), F.floor(F.col("id") / size).alias("context"), F.pmod("id", F.lit(n // size)).alias("shorter"))
        # Contexts and shorter grams are size ** order at most.
        grid = grid.join(by, "gram", "left").join(F.broadcast(context), "context", "left")
        if lower is None:
            grid = grid.select("*", *(F.lit(1.0 / size).alias(f"q{v}") for v in (0, 1)))
        else:
            grid = grid.join(F.broadcast(lower.select(F.col("gram").alias("shorter"), *(F.col(f"p{v}").alias(f"q{v}") for v in (0, 1)))), "shorter")
        p = [((F.coalesce(f"n{v}", F.lit(0.0)) + strength * F.col(f"q{v}")) / (F.coalesce(f"c{v}", F.lit(0.0)) + strength)).alias(f"p{v}") for v in (0, 1)]
        lower = grid.select("gram", *p)
    value = (F.log("p1") - F.log("p0")).cast("float")
    parts = lower.groupBy(F.floor(F.col("gram") / 1024).alias("part")).agg(F.sort_array(F.collect_list(F.struct("gram", value.alias("v")))).alias("x"))
    whole = parts.groupBy().agg(F.sort_array(F.collect_list(F.struct("part", F.transform("x", lambda s: s["v"]).alias("x")))).alias("y"))
    return materialize(whole.select(F.flatten(F.transform("y", lambda s: s["x"])).alias("t")), "table")


def log_ratio(code: Column, table: Column, order: int, size: int) -> Column:
    """The sum of the table's values over the grams of an array of codes; linear in its length. table: a column of the row."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("g"))
    base = size**order if order else 1
    add = lambda a, c: F.struct((a["s"] + F.get(table, (_next(a["g"], c, base, size)).cast("int"))).alias("s"), _next(a["g"], c, base, size).alias("g"))
    return F.aggregate(code, zero, add)["s"]


def mean_log_ratio(code: Column, table: Column, order: int, size: int) -> Column:
    """log_ratio() for each code; 0 for none."""
    return F.coalesce(log_ratio(code, table, order, size) / F.nullif(F.size(code), F.lit(0)), F.lit(0.0))


def _next(gram: Column, code: Column, base: int, size: int) -> Column:
    return F.pmod(gram, F.lit(base)) * size + code


def held_steps(held: DataFrame, label: str, score: Column) -> dict[int, tuple[float, float]]:
    """How many held-out rows of labels 1 and 0 have each step of the score: 2 * STEPS + 1 rows at most."""
    step = F.greatest(F.least(F.round(score * (STEPS / RANGE)), F.lit(STEPS)), F.lit(-STEPS)).cast("int")
    by = held.groupBy(step.alias("step")).agg(F.count_if(F.col(label) == 1).alias("one"), F.count_if(F.col(label) == 0).alias("none"))
    return {r["step"]: (r["one"], r["none"]) for r in by.collect()}


def threshold(held: dict[int, tuple[float, float]], most_missed: float | None = None, most_false: float = 0.0) -> float:
    """From held_steps(): the score from which on a row counts as label 1.

    Without most_missed, the mean of both error rates is smallest, of equal ones the middle. With it, the
    threshold is the highest that misses no more than that share of label 1, so that what is like neither
    label stays below it; or, where more than most_false of label 0 is above that one, the lowest that keeps
    to most_false. Without rows of both labels, every row counts as label 1 (with most_missed, as label 0).
    """
    one, none = (sum(x[i] for x in held.values()) for i in (0, 1))
    if not one or not none:
        return float("-inf") if most_missed is None else float("inf")
    cuts, missed, passed = [], 0, none
    for step in range(-STEPS, STEPS + 2):
        cuts.append(((step - 0.5) * RANGE / STEPS, missed / one, passed / none))
        g, b = held.get(step, (0, 0))
        missed, passed = missed + g, passed - b
    if most_missed is None:
        least = min(m + p for _, m, p in cuts)
        best = [cut for cut, m, p in cuts if m + p == least]
        return best[len(best) // 2]
    return max(min(c for c, _, p in cuts if p <= most_false), max(c for c, m, _ in cuts if m <= most_missed))
