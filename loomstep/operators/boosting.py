"""Boosted regression trees that grow leaf by leaf, over a table of binned features.

Features are cut at quantiles once; a row then holds a byte a feature. Trees see nothing but these codes, so all
folds and trials read one table. Each pass over it adds up gradients by leaf, feature and code in every partition,
and finds the best split of each leaf where the sums of a feature meet; the driver gets one row a leaf.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstep.schema import DATE, require_columns
from loomstep.sources.scratch import delete, scratch_path
from loomstep.sources.settings import Trees

#: Codes of a feature: 0 for null, from 1 on for values.
CODES = 256
#: Bytes of sums that a task holds; leaves beyond that wait for another pass.
HELD_BYTES = 256 << 20
#: Features whose quantiles one job finds.
COLUMNS_AT_ONCE = 100
#: Rounds after which the margins of all rows are written anew.
ROUNDS_HELD = 20


@dataclass
class Binned:
    """rows: (row, date_id, y, w, codes), a byte a feature; edges: by feature, the upper ends of its codes but the last."""

    rows: DataFrame
    features: list[str]
    edges: list[list[float]]


def bin_edges(df: DataFrame, features: list[str], bins: int = 255, accuracy: int = 10_000) -> list[list[float]]:
    """The different quantiles of each feature at even shares, exact where a feature has up to accuracy values; null and NaN don't count."""
    if not 2 <= bins <= CODES - 1:
        raise ValueError(f"bins is 2 to {CODES - 1}")
    shares, found = [i / bins for i in range(1, bins)], []
    for at in range(0, len(features), COLUMNS_AT_ONCE):
        part = features[at : at + COLUMNS_AT_ONCE]
        values = [F.col(f"`{c}`").cast("double") for c in part]
        got = df.agg(*(F.percentile_approx(F.when(~F.isnan(v), v), shares, accuracy).alias(str(i)) for i, v in enumerate(values))).first()
        found += [sorted(set(q or ())) for q in got]
    return found


def _codes(batch: pa.RecordBatch, features: list[str], edges: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((batch.num_rows, len(features)), np.uint8)
    for i, (c, e) in enumerate(zip(features, edges, strict=True)):
        x = batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[:, i] = np.where(np.isnan(x), 0, np.searchsorted(e, x) + 1)
    return out


def write_binned(df: DataFrame, features: list[str], path: str, *, y: str, weight: str, bins: int = 255) -> Binned:
    """Bins the features once, writes rows and edges below path and reads them back.

    Rows of a null target are left out, a null weight counts as 1. row numbers rows for the bags that trees draw.
    """
    require_columns(df, [DATE, y, weight, *features])
    spark = df.sparkSession
    known = df.where(F.col(y).isNotNull())
    edges = bin_edges(known, features, bins)
    shared = [np.asarray(e, float) for e in edges]
    kept = known.select(
        F.monotonically_increasing_id().alias("_row"), F.col(DATE).cast("int").alias("_date"), F.col(y).cast("double").alias("_y"),
        F.coalesce(F.col(weight).cast("double"), F.lit(1.0)).alias("_w"), *(F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(features)),
    )
    names = [f"x{i}" for i in range(len(features))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(batch, names, shared)
            packed = pa.array([r.tobytes() for r in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_row", "_date", "_y", "_w")), packed], names=["row", DATE, "y", "w", "codes"])

    kept.mapInArrow(run, f"row long, {DATE} int, y double, w double, codes binary").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/rows")
    spark.createDataFrame(list(enumerate(map(json.dumps, zip(features, edges, strict=True)))), "place int, line string").write.mode("overwrite").parquet(f"{path}/edges")
    return read_binned(spark, path)


def read_binned(spark: SparkSession, path: str) -> Binned:
    lines = [json.loads(r["line"]) for r in spark.read.parquet(f"{path}/edges").orderBy("place").collect()]
    return Binned(spark.read.parquet(f"{path}/rows"), [c for c, _ in lines], [e for _, e in lines])


@dataclass
class Tree:
    """Nodes by number, 0 the root; feature -1 marks a leaf. Codes up to code go left, nulls where null_left says."""

    feature: list[int] = field(default_factory=list)
    code: list[int] = field(default_factory=list)
    null_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for name, x in (("feature", -1), ("code", 0), ("null_left", False), ("left", 0), ("right", 0), ("value", value), ("gain", 0.0)):
            getattr(self, name).append(x)
        return len(self.value) - 1

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, code, null_left, left, right = (np.asarray(getattr(self, c)) for c in ("feature", "code", "null_left", "left", "right"))
        node = np.zeros(len(codes), np.int64)
        on = np.flatnonzero(feature[node] >= 0)
        while len(on):
            at = node[on]
            own = codes[on, feature[at]]
            node[on] = np.where(np.where(own == 0, null_left[at], own <= code[at]), left[at], right[at])
            on = on[feature[node[on]] >= 0]
        return node

    def values(self, codes: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaves(codes)]


@dataclass
class Model:
    """What the base and the trees up to the best round predict; scores: wr2 on the validation rows after each round."""

    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    scores: list[float]

    def gain_shares(self) -> list[float]:
        """Each feature's share of the gain of all splits; zeros where there is none."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    total[f] += g
        return (total / total.sum() if total.sum() > 0 else total).tolist()

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """df with the prediction of each row; null features are codes of their own."""
        features, edges, base, trees = self.features, [np.asarray(e, float) for e in self.edges], self.base, self.trees
        names = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = _codes(batch, features, edges)
                made = base + sum((t.values(codes) for t in trees), np.zeros(len(codes)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=[*names, out])

        return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))


@dataclass
class _Node:
    """A node while a tree grows: sums of gradients, weights and rows, and its best split once a pass has found it."""

    depth: int
    g: float
    h: float
    n: int
    split: dict | None = None
    asked: bool = False
    children: tuple[int, int] | None = None


def _kept(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def leaf_gain(g, h, p: Trees):
    """What a leaf lowers the loss by, twice."""
    return _kept(g, p.l1) ** 2 / np.maximum(h + p.l2, 1e-300)


def best_splits(sums: np.ndarray, p: Trees) -> dict:
    """The best split of a leaf by one feature from its sums (code, [gradient, weight, rows]); gain -1 where none is allowed."""
    null, total = sums[0], sums.sum(axis=0)
    below = np.cumsum(sums[1:-1], axis=0)
    found = {"gain": -1.0, "code": 0, "null_left": False, "gl": 0.0, "hl": 0.0, "nl": 0, "g": float(total[0]), "h": float(total[1]), "n": int(total[2])}
    for null_left in (True, False) if null[2] else (False,):
        left = below + null * null_left
        right = total - left
        gain = leaf_gain(left[:, 0], left[:, 1], p) + leaf_gain(right[:, 0], right[:, 1], p) - leaf_gain(total[0], total[1], p)
        least = np.minimum(left[:, 2], right[:, 2]) >= max(p.min_rows, 1)
        heavy = np.minimum(left[:, 1], right[:, 1]) >= p.min_weight
        gain = np.where(least & heavy, gain, -1.0)
        at = int(np.argmax(gain))
        if gain[at] > found["gain"]:
            found |= {"gain": float(gain[at]), "code": at + 1, "null_left": null_left, "gl": float(left[at, 0]), "hl": float(left[at, 1]), "nl": int(left[at, 2])}
    return found


def _in_bag(row: np.ndarray, seed: int, fraction: float) -> np.ndarray:
    """A share of the rows by a mix of their numbers and the seed, the same whenever it is asked."""
    x = row.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x < np.uint64(min(int(fraction * 2.0**64), (1 << 64) - 1))


_FOUND = "gain double, code int, null_left boolean, gl double, hl double, nl long, g double, h double, n long"


def _pass(held: DataFrame, n_features: int, trees: list[Tree], route: Tree, asked: list[int], columns: list[int], p: Trees, bag: int) -> tuple[dict[int, dict], float]:
    """(best split by leaf, squared error of the validation rows): one pass over all rows.

    trees: those that the margins lack; route: the tree so far; asked: leaves whose splits are wanted, by columns.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(len(route.value), -1)
        slot[asked] = np.arange(len(asked))
        sums = np.zeros((3, len(columns), len(asked) * CODES))
        error = 0.0
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, n_features)
            y, w, row = (batch.column(c).to_numpy() for c in ("y", "w", "row"))
            valid = batch.column("valid").to_numpy(zero_copy_only=False)
            margin = batch.column("margin").to_numpy() + sum((t.values(codes) for t in trees), np.zeros(len(y)))
            error += float((w * (y - margin) ** 2)[valid].sum())
            use = ~valid if p.bag_fraction >= 1 else ~valid & _in_bag(row, bag, p.bag_fraction)
            own = slot[route.leaves(codes)]
            use &= own >= 0
            codes, base = codes[use], own[use] * CODES
            parts = ((w * (margin - y))[use], w[use], None)
            for i, f in enumerate(columns):
                key = base + codes[:, f]
                for k, x in enumerate(parts):
                    sums[k, i] += np.bincount(key, x, sums.shape[2])
        leaf, feature, packed = [-1], [-1], [np.array([error]).tobytes()]
        for i, f in enumerate(columns):
            for j, node in enumerate(asked):
                own = sums[:, i, j * CODES : (j + 1) * CODES]
                if own[2].any():
                    leaf.append(node)
                    feature.append(f)
                    packed.append(own.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(feature, pa.int32()), pa.array(packed, pa.binary())], names=["leaf", "feature", "sums"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for leaf, feature, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(packed)
                key = (leaf, feature)
                total[key] = total[key] + own if key in total else own
        rows = []
        for (leaf, feature), own in sorted(total.items()):
            found = best_splits(own.reshape(3, CODES).T, p) if leaf >= 0 else {"gain": float(own[0]), "code": 0, "null_left": False, "gl": 0.0, "hl": 0.0, "nl": 0, "g": 0.0, "h": 0.0, "n": 0}
            rows.append({"leaf": leaf, "feature": feature} | found)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    kinds = pa.schema([("leaf", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("code", pa.int32()), ("null_left", pa.bool_()), *((c, pa.float64()) for c in ("gl", "hl")), ("nl", pa.int64()), *((c, pa.float64()) for c in ("g", "h")), ("n", pa.int64())])
    parts = held.mapInArrow(add_up, "leaf int, feature int, sums binary").repartition("feature")
    found = parts.mapInArrow(meet, f"leaf int, feature int, {_FOUND}")
    # Of equal gains the first feature counts, then the first code.
    order = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("code")).alias("c"), "feature", "code", "null_left", "gl", "hl", "nl", "g", "h", "n")
    rows = {r["leaf"]: r["best"].asDict() for r in found.groupBy("leaf").agg(F.max(order).alias("best")).collect()}
    error = rows.pop(-1, {"gain": 0.0})["gain"]
    return rows, error


def grow(held: DataFrame, n_features: int, trees: list[Tree], columns: list[int], p: Trees, bag: int) -> tuple[Tree, float]:
    """(tree, squared error of the validation rows before it): the leaf of the highest gain is split next, until there are p.leaves.

    The order of splits needs the gains of all leaves. A pass therefore asks for all leaves without one, and also for the
    children of leaves that may be split soon; so there are about as many passes as the tree has levels, and the tree
    is the one that splitting leaf by leaf gives.
    """
    nodes, route, error = [_Node(0, 0.0, 0.0, 0)], Tree(), None
    route.add(0.0)
    most = max(1, HELD_BYTES // (24 * CODES * max(len(columns), 1)))

    def split(i: int) -> None:
        """Makes the children of a node, in the table and in the tree by which rows are led."""
        s, node = nodes[i].split, nodes[i]
        for g, h, n in ((s["gl"], s["hl"], s["nl"]), (s["g"] - s["gl"], s["h"] - s["hl"], s["n"] - s["nl"])):
            child = _Node(node.depth + 1, g, h, n)
            if child.depth >= p.depth or n < 2 * max(p.min_rows, 1):
                child.split, child.asked = {"gain": -1.0}, True
            nodes.append(child)
            route.add(0.0)
        node.children = (len(nodes) - 2, len(nodes) - 1)
        route.feature[i], route.code[i], route.null_left[i] = s["feature"], s["code"], s["null_left"]
        route.left[i], route.right[i] = node.children

    def ready(i: int) -> bool:
        return nodes[i].split is not None and nodes[i].split["gain"] > max(p.min_gain, 0)

    while True:
        leaves, chosen = [0], []
        while len(leaves) < p.leaves and all(nodes[i].split is not None for i in leaves):
            best = max((i for i in leaves if ready(i)), key=lambda i: (nodes[i].split["gain"], -i), default=None)
            if best is None:
                break
            if nodes[best].children is None:
                split(best)
            chosen.append(best)
            leaves.remove(best)
            leaves += nodes[best].children
        if len(leaves) >= p.leaves or all(nodes[i].split is not None for i in leaves):
            break
        soon = sorted((i for i in leaves if ready(i)), key=lambda i: -nodes[i].split["gain"])[: p.leaves - len(leaves)]
        for i in soon:
            if nodes[i].children is None:
                split(i)
        asked = [i for i in leaves if nodes[i].split is None]
        asked += [j for i in soon for j in nodes[i].children if nodes[j].split is None]
        for at in range(0, len(asked), most):
            part = asked[at : at + most]
            found, wrong = _pass(held, n_features, trees, route, part, columns, p, bag)
            error = wrong if error is None else error
            for i in part:
                nodes[i].split = found.get(i, {"gain": -1.0})
                if i == 0 and 0 in found:
                    nodes[0].g, nodes[0].h, nodes[0].n = (found[0][c] for c in ("g", "h", "n"))
    made, place = Tree(), {}
    for i in [0, *(j for c in chosen for j in nodes[c].children)]:
        node = nodes[i]
        place[i] = made.add(float(-p.rate * _kept(node.g, p.l1) / (node.h + p.l2)) if node.h + p.l2 > 0 else 0.0)
    for i in chosen:
        s, at = nodes[i].split, place[i]
        made.feature[at], made.code[at], made.null_left[at], made.gain[at] = s["feature"], s["code"], s["null_left"], s["gain"]
        made.left[at], made.right[at] = (place[j] for j in nodes[i].children)
    return made, error


def fit(binned: Binned, train: DataFrame, p: Trees = Trees()) -> Model:
    """A model of train: rows of binned with valid, whether a row only judges. Margins begin at the weighted mean.

    After each round wr2 of the validation rows is taken; after p.patience rounds without a better one the fit ends, and
    the trees behind the best round are left out. Without validation rows all p.rounds count. Margins are written every
    few rounds, so that no plan grows; only sums, splits and trees come to the driver.
    """
    spark, n_features = train.sparkSession, len(binned.features)
    w, y = F.col("w"), F.col("y")
    sums = {r["valid"]: r for r in train.groupBy("valid").agg(F.sum(w).alias("w"), F.sum(w * y).alias("wy"), F.count(F.lit(1)).alias("n")).collect()}
    if False not in sums:
        raise ValueError("no rows to train on")
    base = sums[False]["wy"] / max(sums[False]["w"], 1e-12)
    spread = None
    if True in sums:
        mean = sums[True]["wy"] / max(sums[True]["w"], 1e-12)
        spread = train.where("valid").agg(F.sum(w * (y - mean) ** 2).alias("s")).first()["s"]
    rng = np.random.default_rng(p.seed)
    held, path = train.select("row", "y", "w", "valid", "codes", F.lit(base).alias("margin")), None
    trees: list[Tree] = []
    written, scores = 0, []
    try:
        for turn in range(p.rounds + 1):
            if turn - written >= ROUNDS_HELD or path is None:
                held, path = _with_margins(spark, held, n_features, trees[written:], path)
                written = len(trees)
            columns = sorted(rng.choice(n_features, max(1, int(p.feature_fraction * n_features)), replace=False).tolist())
            if turn == p.rounds:
                if spread is not None and trees:
                    _, error = _pass(held, n_features, trees[written:], Tree([-1], [0], [False], [0], [0], [0.0], [0.0]), [], [], p, 0)
                    scores.append(1 - error / max(spread, 1e-12))
                break
            tree, error = grow(held, n_features, trees[written:], columns, p, p.seed + turn // max(p.bag_every, 1))
            if spread is not None and trees:
                scores.append(1 - error / max(spread, 1e-12))
                if len(scores) - 1 - int(np.argmax(scores)) >= p.patience:
                    break
            trees.append(tree)
    finally:
        if path:
            delete(spark, path)
    best = int(np.argmax(scores)) + 1 if scores else len(trees)
    return Model(binned.features, binned.edges, base, trees[:best], scores)


def _with_margins(spark: SparkSession, held: DataFrame, n_features: int, trees: list[Tree], old: str | None) -> tuple[DataFrame, str]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, n_features)
            margin = batch.column("margin").to_numpy() + sum((t.values(codes) for t in trees), np.zeros(len(codes)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(margin)], names=batch.schema.names)

    path = scratch_path(spark, "margins")
    held.mapInArrow(run, held.schema).write.parquet(path)
    if old:
        delete(spark, old)
    return spark.read.parquet(path), path


def save_model(spark: SparkSession, model: Model, path: str, **meta) -> None:
    """The model and meta below path, a line of JSON for each tree."""
    head = {"features": model.features, "edges": model.edges, "base": model.base, "scores": model.scores, "meta": meta}
    lines = [json.dumps(head), *(json.dumps(asdict(t)) for t in model.trees)]
    spark.createDataFrame(list(enumerate(lines)), "place int, line string").write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> tuple[Model, dict]:
    head, *trees = (json.loads(r["line"]) for r in spark.read.parquet(path).orderBy("place").collect())
    return Model(head["features"], head["edges"], head["base"], [Tree(**t) for t in trees], head["scores"]), head["meta"]
