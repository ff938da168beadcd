"""Binned rows, leaf-wise trees, early stopping, search and the whole training run."""

import bisect
import dataclasses
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstep.operators import boosting, crossval, selection
from loomstep.plans import training
from loomstep.sources import dated
from loomstep.sources.settings import Folds, Selection, Settings, Trees

SCHEMA = "symbol_id int, date_id int, time_id int, useful double, noise double, w double, y double"
PLAIN = Trees(rounds=6, patience=3, rate=0.5, leaves=5, depth=4, min_rows=3, min_weight=0.0, l1=0.3, l2=1.0, feature_fraction=1.0, bag_fraction=1.0, bag_every=1)


def learnable(spark, days=14):
    r = random.Random(9)
    rows = []
    for d in range(days):
        for t in range(25):
            x, noise = r.gauss(0, 1), r.gauss(0, 1)
            rows.append((d % 2, d, t, None if r.random() < 0.1 else x, noise, 1.0 + t % 3, 2.0 * (x > 0) + x + r.gauss(0, 0.1)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def binned(spark, tmp_path_factory):
    return boosting.write_binned(learnable(spark), ["noise", "useful"], str(tmp_path_factory.mktemp("b") / "x"), y="y", weight="w", bins=40)


def test_bins_are_exact_quantiles(spark, tmp_path):
    r = random.Random(2)
    values = [None if i % 9 == 0 else float("nan") if i % 50 == 1 else r.choice([r.gauss(0, 1), 0.0]) for i in range(700)]
    df = spark.createDataFrame([(0, i % 5, i, v, None if i == 3 else 1.0, None if i == 4 else 2.0) for i, v in enumerate(values)], "symbol_id int, date_id int, time_id int, x double, w double, y double")
    known = sorted(v for i, v in enumerate(values) if v is not None and not math.isnan(v) and i != 4)
    want = sorted({known[math.ceil(k / 30 * len(known)) - 1] for k in range(1, 30)})
    got = boosting.write_binned(df, ["x"], str(tmp_path / "x"), y="y", weight="w", bins=30)
    assert got.edges == [want]
    rows = got.rows.collect()
    assert len(rows) == 699 and len({x["row"] for x in rows}) == 699 and sum(x["w"] == 1 for x in rows) == 699
    codes = sorted(0 if v is None or math.isnan(v) else bisect.bisect_left(want, v) + 1 for i, v in enumerate(values) if i != 4)
    assert sorted(x["codes"][0] for x in rows) == codes
    assert boosting.bin_edges(df.limit(0), ["x"]) == [[]]


def brute_tree(codes, g, h, p):
    """Leaf by leaf: of all leaves and splits the one of the highest gain, until there are enough leaves."""
    kept = lambda s: math.copysign(max(abs(s) - p.l1, 0), s)
    part = lambda rows: kept(sum(g[i] for i in rows)) ** 2 / (sum(h[i] for i in rows) + p.l2)
    leaves = [(list(range(len(g))), 0)]
    gains = []
    while len(leaves) < p.leaves:
        best = None
        for at, (rows, depth) in enumerate(leaves):
            if depth >= p.depth:
                continue
            for f in range(codes.shape[1]):
                for c in range(1, 255):
                    for null_left in (True, False):
                        left = [i for i in rows if (null_left if codes[i, f] == 0 else codes[i, f] <= c)]
                        if min(len(left), len(rows) - len(left)) < p.min_rows:
                            continue
                        right = sorted(set(rows) - set(left))
                        gain = part(left) + part(right) - part(rows)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = gain, at, left, right
        if best is None:
            break
        gain, at, left, right = best
        depth = leaves.pop(at)[1] + 1
        leaves += [(left, depth), (right, depth)]
        gains.append(gain)
    value = np.zeros(len(g))
    for rows, _ in leaves:
        value[rows] = -p.rate * kept(sum(g[i] for i in rows)) / (sum(h[i] for i in rows) + p.l2)
    return value, gains


@pytest.mark.parametrize("changes", [{}, {"depth": 2}, {"min_rows": 12, "l1": 0.0}])
def test_trees_grow_as_by_brute_force(spark, changes):
    p = dataclasses.replace(PLAIN, rounds=2, **changes)
    r = random.Random(5)
    rows = [(i, 0, 0.5 + r.random(), bytes([r.choice([0, 1, 2, 3, 4, 5]), r.choice([1, 2, 9])])) for i in range(60)]
    rows = [(i, d, w, c, (c[0] > 2) * 2.0 + (c[1] == 9) - (c[0] == 0) * 1.5 + r.gauss(0, 0.3)) for i, d, w, c in rows]
    df = spark.createDataFrame(rows, "row long, date_id int, w double, codes binary, y double").repartition(3)
    model = boosting.fit(boosting.Binned(df, ["a", "b"], [[], []]), df.withColumn("valid", F.lit(False)), p)
    codes = np.array([list(x[3]) for x in rows])
    w, y = (np.array([x[k] for x in rows]) for k in (2, 4))
    margin = np.full(60, (w * y).sum() / w.sum())
    assert model.base == pytest.approx(margin[0]) and len(model.trees) == 2
    for tree in model.trees:
        value, gains = brute_tree(codes, w * (margin - y), w, p)
        assert tree.values(codes.astype(np.uint8)) == pytest.approx(value)
        assert sorted(x for f, x in zip(tree.feature, tree.gain) if f >= 0) == pytest.approx(sorted(gains))
        margin = margin + value


def wr2(rows, predict):
    mean = sum(r["w"] * r["y"] for r in rows) / sum(r["w"] for r in rows)
    return 1 - sum(r["w"] * (r["y"] - p) ** 2 for r, p in zip(rows, predict)) / sum(r["w"] * (r["y"] - mean) ** 2 for r in rows)


def test_patience_keeps_the_best_round(spark, binned):
    """Scores are those of the trees themselves; the model ends at the best one, and fits stop patience rounds behind it."""
    folds = crossval.fold_table(binned.rows, 2, 1, 3)
    p = dataclasses.replace(PLAIN, rounds=40, rate=1.0, l1=0.0, l2=0.0)
    model = selection.fit_fold(binned, folds, 1, p)
    assert len(model.scores) < 40 and len(model.scores) == len(model.trees) + p.patience
    assert max(model.scores) == model.scores[len(model.trees) - 1] > 0.8
    rows = crossval.assign_folds(binned.rows, folds).where("fold = 1 and part = 'valid'").collect()
    codes = np.frombuffer(b"".join(r["codes"] for r in rows), np.uint8).reshape(-1, 2)
    margin = np.full(len(rows), model.base)
    for tree, score in zip(model.trees, model.scores):
        margin = margin + tree.values(codes)
        assert wr2(rows, margin) == pytest.approx(score)


def test_folds_and_selection_find_the_useful_feature(spark, binned, tmp_path):
    folds = crossval.fold_table(binned.rows, 2, 1, 3)
    p = dataclasses.replace(PLAIN, bag_fraction=0.7, feature_fraction=0.6, rounds=4)
    scores, importance = selection.fit_folds(binned, folds, PLAIN)
    share = {r["feature"]: r["gain_share"] for r in importance.collect()}
    assert share["useful"] > 0.9 and sum(share.values()) == pytest.approx(1)
    assert all(1 <= r["rounds"] <= 6 and r["wr2"] > 0.7 for r in scores.collect()) and scores.count() == 2
    assert selection.fit_fold(binned, folds, 1, p) == selection.fit_fold(binned, folds, 1, p)
    best = selection.select_features(binned, folds, str(tmp_path / "names"), k=1, always=["t"], trees=dataclasses.replace(PLAIN, rounds=2))
    assert [r["feature"] for r in best.orderBy("rank").collect()] == ["t", "useful"] == dated.read_names(spark, str(tmp_path / "names"))


def test_folds_send_days_and_no_rows(spark, binned):
    own = crossval.assign_folds(binned.rows, crossval.fold_table(learnable(spark), 2, 1, 2))
    own.collect()
    plan = own._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    sent = [line for line in plan.splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
    assert "BroadcastHashJoin" in sent[0] and "BuildRight" in sent[0]
    assert sorted((r["fold"], r["part"], r["n"]) for r in own.groupBy("fold", "part").agg(F.countDistinct("date_id").alias("n")).collect()) == [(1, "train", 6), (1, "valid", 4), (2, "train", 6), (2, "valid", 3)]


def test_model_predicts_and_is_saved(spark, binned, tmp_path):
    assert selection.refit_rounds([100, 60]) == 88
    model = boosting.fit(binned, binned.rows.withColumn("valid", F.lit(False)), dataclasses.replace(PLAIN, rounds=3))
    assert len(model.trees) == 3 and model.scores == []
    boosting.save_model(spark, model, str(tmp_path / "m"), dates=[0, 13])
    again, meta = boosting.load_model(spark, str(tmp_path / "m"))
    assert again == model and meta == {"dates": [0, 13]}
    done = again.predict(learnable(spark)).collect()
    assert wr2(done, [r["prediction"] for r in done]) > 0.7
    with pytest.raises(ValueError):
        boosting.fit(binned, binned.rows.withColumn("valid", F.lit(True)))


def test_search_beats_chance_on_a_known_surface():
    """With equal trials the model-based search comes nearer to the top in most of the seeds; seeded reruns agree."""
    space = {"a": (0.0, 1.0), "b": (0, 40), "c": (0.0, 10.0)}
    surface = lambda p: -((p["a"] - 0.73) ** 2) * 4 - ((p["b"] - 11) / 40) ** 2 * 4 - ((p["c"] - 2.5) / 10) ** 2
    best = lambda first, seed: max(v for _, v in selection.search(space, surface, trials=40, first=first, seed=seed))
    assert sum(best(10, s) > best(40, s) for s in range(20)) >= 15
    assert selection.search(space, surface, trials=15, first=5, seed=3) == selection.search(space, surface, trials=15, first=5, seed=3)
    together = selection.search(space, surface, trials=9, first=4, at_once=3, seed=1)
    assert len(together) == 9 and all(isinstance(p["b"], int) and 0 <= p["b"] <= 40 for p, _ in together)


def test_search_over_folds(spark, binned):
    folds = crossval.fold_table(binned.rows, 2, 1, 3)
    trees = dataclasses.replace(PLAIN, rounds=2)
    found = selection.search_parameters(binned, folds, space={"leaves": (2, 4), "rate": (0.2, 0.9)}, trials=3, first=2, at_once=2, trees=trees).collect()
    assert [x["mean_wr2"] for x in found] == sorted((x["mean_wr2"] for x in found), reverse=True) and len(found) == 3
    own = [x["wr2"] for x in selection.fit_folds(binned, folds, dataclasses.replace(trees, leaves=int(found[0]["leaves"]), rate=found[0]["rate"]))[0].collect()]
    assert found[0]["mean_wr2"] == pytest.approx(sum(own) / 2) and found[0]["std_wr2"] == pytest.approx(abs(own[0] - own[1]) / 2)


def test_from_panel_to_model(spark, tmp_path):
    panel = learnable(spark).withColumn("time_pos", F.col("time_id").cast("float"))
    trees = dataclasses.replace(PLAIN, rounds=2, leaves=3)
    s = Settings(folds=Folds(2, 1, 3), selection=Selection(1, ("time_pos", "none")), trees=trees, selection_trees=trees)
    model, summary = training.train(panel, str(tmp_path / "run"), target="y", weight="w", s=s)
    assert model.features == ["time_pos", "useful"] and len(model.trees) == 50 and summary["n_features"] == 2
    assert dated.read_summary(spark, str(tmp_path / "run/summary")) == summary and 0.3 < summary["mean_wr2"] < 1
    assert boosting.load_model(spark, str(tmp_path / "run/model"))[0] == model
    assert dated.read_matrix(spark, str(tmp_path / "run/selected/matrix"))[0]["features"] == ["time_pos", "useful"]
