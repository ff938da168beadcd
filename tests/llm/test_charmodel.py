"""The character models against counting and smoothing by hand."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomstep.llm import charmodel

ALPHABET = "abc"
SIZE = 4


def brute(rows, order, strength):
    """log P(c | context, 1) - log P(c | context, 0), the estimate of a context leaning on that of a shorter one."""
    counts = [Counter(), Counter()]
    for label, code, weight in rows:
        padded = [0] * order + code
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[label][tuple(padded[i - k : i + 1])] += weight

    def p(label, gram):
        shorter = p(label, gram[1:]) if len(gram) > 1 else 1 / SIZE
        context = sum(counts[label][(*gram[:-1], c)] for c in range(SIZE))
        return (counts[label][gram] + strength * shorter) / (context + strength)

    def ratio(code):
        padded = [0] * order + code
        return sum(math.log(p(1, g)) - math.log(p(0, g)) for i in range(order, len(padded)) for g in [tuple(padded[i - order : i + 1])])

    return counts, ratio


@pytest.mark.parametrize(("order", "strength"), [(0, 1.0), (1, 0.5), (2, 200.0)])
def test_tables_are_the_smoothed_counts(spark, order, strength):
    r = random.Random(order)
    texts = [(r.randint(0, 1), "".join(r.choice("abcx") for _ in range(r.randint(0, 9))), r.choice([1.0, 2.5])) for _ in range(40)]
    df = spark.createDataFrame(texts, "y int, text string, w double").withColumn("c", charmodel.codes(F.col("text"), ALPHABET))
    rows = [(y, ["abc".find(c) + 1 for c in t], w) for y, t, w in texts]
    assert [list(x["c"]) for x in df.collect()] == [c for _, c, _ in rows]
    counts, ratio = brute(rows, order, strength)
    grams = charmodel.gram_counts(df, "y", "c", order, SIZE, "w")
    want = {(y, sum(c * SIZE ** (order - i) for i, c in enumerate(g))): n for y in (0, 1) for g, n in counts[y].items() if len(g) == order + 1}
    assert {(x["y"], x["gram"]): x["n"] for x in grams.collect()} == pytest.approx(want)
    table = charmodel.log_ratio_table(grams, "y", order, SIZE, strength)
    asked = spark.createDataFrame([("".join(r.choice("abcx") for _ in range(n)),) for n in (0, 1, 2, 5, 30)], "text string")
    asked = asked.withColumn("c", charmodel.codes(F.col("text"), ALPHABET)).withColumn("t", table.scalar())
    got = asked.select("text", charmodel.mean_log_ratio(F.col("c"), F.col("t"), order, SIZE).alias("s")).collect()
    for x in got:
        code = ["abc".find(c) + 1 for c in x["text"]]
        assert x["s"] == pytest.approx(ratio(code) / len(code) if code else 0, abs=1e-6)


def test_threshold(spark):
    """Of all cuts, the one of the smallest mean error; or the highest that misses few, unless too many others pass it."""
    r = random.Random(3)
    held = [(1, r.gauss(0.5, 0.4)) for _ in range(200)] + [(0, r.gauss(-0.5, 0.4)) for _ in range(100)] + [(1, 99.0), (0, -99.0)]
    steps = charmodel.held_steps(spark.createDataFrame(held, "y int, s double"), "y", F.col("s"))
    step = charmodel.RANGE / charmodel.STEPS
    assert sum(a for a, _ in steps.values()) == 201 and len(steps) <= 2 * charmodel.STEPS + 1

    def errors(cut):
        missed = sum(y == 1 and round(s / step) * step < cut for y, s in held) / 201
        passed = sum(y == 0 and round(s / step) * step >= cut for y, s in held) / 101
        return missed, passed

    cuts = [(k - 0.5) * step for k in range(-charmodel.STEPS, charmodel.STEPS + 2)]
    assert sum(errors(charmodel.threshold(steps))) == pytest.approx(min(map(sum, map(errors, cuts))))
    cut = charmodel.threshold(steps, 0.05, 1.0)
    assert errors(cut)[0] <= 0.05 < errors(cut + step)[0] or errors(cut) == errors(cut + step)
    strict = charmodel.threshold(steps, 0.0, 0.01)
    assert errors(strict)[1] <= 0.01
    assert charmodel.threshold({}) == -math.inf and charmodel.threshold({}, 0.1) == math.inf
