"""Near copies among vectors: spherical k-means cells, blocked cosine products within them, one kept per group.

A vector is at home in the cell of its nearest centre. It also asks in each cell that lies behind a near
border: two linked vectors are at most r = sqrt(2 - 2 * least) apart, and the part of that distance that goes
straight to a border is r / sqrt(d) in the mean square for d dimensions, so a vector asks across all borders
within MARGIN times that. A pair is found if one of the two asks in the other's home; with the margin at r
itself none is missed. Recall is measured in the tests and the README. Every cosine is computed in double
precision on whole vectors, so no pair below the limit links.

Equal vectors form a class, compared once and counted as often as it has members. Cells are cut into
blocks by a hash, and a task compares a block of residents with a block of askers, so no task holds a whole
cell. A task returns a number of links for each class and a spanning forest of the pairs, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import discard, materialize
from loomstep.llm.components import components

#: Classes in a cell on average. Cells grow with the classes, from some 10 ** 6 on with their root, up to MAX_CELLS.
PER_CELL, MAX_CELLS = 400, 16384
#: Classes on which the centres are fitted, about: this many, or this many a cell. Rounds of the fit.
SAMPLE, SAMPLE_PER_CELL = 20_000, 8
ROUNDS = 8
#: How many mean distances to a border a vector asks across.
MARGIN = 1.5
#: Classes in a block, about.
BLOCK = 1024


def near_vectors(
    vectors: DataFrame,
    *,
    least: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    margin: float = MARGIN,
    per_cell: int = PER_CELL,
    seed: int = 0,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): other vectors linked directly, smallest id that links reach, whether it is this one.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do
    vectors of different lengths. A row of a null id has no links and no component and is kept; repeated rows count as vectors of their own
    but share an id, hence a component. Other columns are not read. An empty table gives no rows.
    least is above 0; margin and per_cell trade work for recall (see the module) and tasks for cells.
    """
    every = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = every.where("id is not null")
    top = F.array_max(F.transform("v", F.abs))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (top > 0)
    # Links of a class don't depend on the length of its vectors, but equal vectors are found by their bytes.
    sound = rows.where(fine)
    key = F.xxhash64("v"), F.hash("v")
    classes = sound.groupBy(key[0].alias("h1"), key[1].alias("h2"), "v").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("m"))
    classes = materialize(classes.select("c", "m", "v", F.monotonically_increasing_id().alias("k")), "classes")
    pick = classes.sparkSession.sparkContext.broadcast(_centres(classes, per_cell, seed))
    radius = float(np.sqrt(2 - 2 * least))

    def deal(batches):
        for batch in batches:
            v, size = _unit(batch.column("v"))
            c, m, k = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("c", "m", "k"))
            rows: dict[str, list] = {name: [] for name in ("d", "cell", "home", "c", "m", "k", "cells", "u")}
            for d in np.unique(size):
                of = np.flatnonzero(size == d)
                x = np.stack([v[i] for i in of])
                centres = pick.value[int(d)]
                dot = x @ centres.T
                home = dot.argmax(1)
                # How far the border between the home and each other cell is.
                apart = np.sqrt(np.maximum(2 - 2 * centres[home] @ centres.T, 1e-12))
                border = (dot[np.arange(len(of)), home][:, None] - dot) / apart
                asks = border <= radius * min(1.0, margin / np.sqrt(d))
                asks[np.arange(len(of)), home] = True
                a, cell = np.nonzero(asks)
                own = home[a] == cell
                cells = np.split(cell.astype(np.int32), np.cumsum(asks.sum(1))[:-1])
                raw = [r.tobytes() for r in x]
                rows["d"].append(np.full(len(a), d))
                rows["cell"].append(cell)
                rows["home"].append(home[a])
                for name, value in (("c", c), ("m", m), ("k", k)):
                    rows[name].append(value[of[a]])
                rows["cells"] += [cells[i] if at_home else None for i, at_home in zip(a, own, strict=True)]
                rows["u"] += [raw[i] for i in a]
            flat = lambda name: np.concatenate([np.zeros(0, np.int64), *rows[name]])
            whole = [pa.array(flat("d"), pa.int32()), pa.array(flat("cell"), pa.int32()), pa.array(flat("home"), pa.int32()), *(pa.array(flat(n), pa.int64()) for n in ("c", "m", "k"))]
            yield pa.RecordBatch.from_arrays([*whole, pa.array(rows["cells"], pa.list_(pa.int32())), pa.array(rows["u"], pa.binary())], names=list(rows))

    dealt = classes.mapInArrow(deal, "d int, cell int, home int, c long, m long, k long, cells array<int>, u binary")
    dealt = materialize(dealt, "dealt")
    held = dealt.groupBy("d", "cell").agg(F.count_if(F.col("home") == F.col("cell")).alias("residents"), F.count(F.lit(1)).alias("askers"))
    # Residents of a block meet every block of askers of their cell, and the other way round.
    block = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    held = held.select("d", "cell", F.greatest(block("residents"), F.lit(1)).alias("rb"), block("askers").alias("ab")).where("residents > 0")
    placed = dealt.join(held, ["d", "cell"])
    part = lambda c: F.pmod(F.hash("k"), F.col(c))
    residents = placed.where("home = cell").select("*", part("rb").alias("r"), F.explode(F.sequence(F.lit(0), F.col("ab") - 1)).alias("a"), F.lit(True).alias("resident"))
    askers = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("r"), part("ab").alias("a"), F.lit(False).alias("resident"))
    askers = askers.withColumn("cells", F.lit(None).cast("array<int>"))
    names = ["d", "cell", "r", "a", "resident", "home", "c", "m", "k", "cells", "u"]
    found = residents.select(*names).union(askers.select(*names)).groupBy("d", "cell", "r", "a").applyInArrow(_comparer(least), "k long, c long, links long, up long")
    found = materialize(found, "found")
    counted = found.groupBy("k").agg(F.sum("links").alias("links"))
    own = classes.join(counted, "k", "left").select("c", "v", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n"))
    same = sound.join(own, "v").select("id", "c", "n")
    same = materialize(same, "same")
    linked = same.select(F.col("id").alias("a"), F.col("c").alias("b")).union(found.where("up is not null").select("c", "up"))
    reached = components(linked)
    discard(classes, dealt, found)
    found = reached.withColumnRenamed("node", "id")
    links = same.select("id", "n").union(rows.where(~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long")))
    component = F.coalesce("component", "id")
    out = links.join(found, "id", "left").select(F.col("id").alias("vec_id"), F.col("n").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
    alone = F.lit(None).cast("long")
    return out.union(every.where("id is null").select("id", F.lit(0).cast("long"), alone, F.lit(True)))


def _unit(column) -> tuple[list[np.ndarray], np.ndarray]:
    """Each vector at length one, scaled first so that no square over- or underflows."""
    out = []
    for v in column.to_pylist():
        x = np.asarray(v, np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.linalg.norm(x))
    return out, np.array([len(x) for x in out], np.int64)


def n_cells(n: int, per_cell: int = PER_CELL) -> int:
    return max(1, min(n // per_cell, MAX_CELLS, int(4 * n**0.5)))


def _below(n: int, want: int) -> int:
    """The bound below which a fair 64-bit hash of n rows lies for about so many of them; for all, if they are no more."""
    return -(2**63) + min(2**64 * want // max(n, 1), 2**64 - 1)


def _centres(classes: DataFrame, per_cell: int, seed: int) -> dict[int, np.ndarray]:
    """Centres of unit length for each length of vectors, by spherical k-means.

    The sample is what a seeded hash puts below a bound set by the number of classes, so it is taken where the classes
    lie. It stays distributed: in a round each task adds up its rows by their nearest centre, and the sums of a cell
    meet by its number. The driver sees the centres alone, at most MAX_CELLS for a length. A cell that gets no rows
    keeps its centre.
    """
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    cells = {d: n_cells(n, per_cell) for d, n in sizes.items()}
    lower = lambda want: F.element_at(F.create_map(*(F.lit(x) for d, n in sizes.items() for x in (d, _below(n, want(cells[d]))))), F.col("d"))
    hashed = classes.select(F.size("v").alias("d"), F.xxhash64("v", F.lit(seed)).alias("h"), "v")
    sample = materialize(hashed.where(F.col("h") <= lower(lambda k: max(SAMPLE, SAMPLE_PER_CELL * k))), "sample")
    # As many rows with the lowest hashes as there are cells are the first centres; six deviations more are asked for.
    first = sample.where(F.col("h") <= lower(lambda k: k + 6 * int(k**0.5) + 64)).toArrow().sort_by([("d", "ascending"), ("h", "ascending")])
    centres = {}
    for d, k in cells.items():
        rows = first.filter(pc.equal(first.column("d"), d)).slice(0, k)
        centres[d] = np.stack(_unit(rows.column("v"))[0])
    for _ in range(ROUNDS):
        now = sample.sparkSession.sparkContext.broadcast(centres)
        sums = sample.mapInArrow(_adder(now), "d int, cell int, total binary").groupBy("d", "cell").applyInArrow(_added, "d int, cell int, total binary").toArrow()
        centres = {d: c.copy() for d, c in centres.items()}
        for d, cell, total in zip(*(sums.column(n).to_pylist() for n in ("d", "cell", "total")), strict=True):
            x = np.frombuffer(total, np.float64)
            norm = np.linalg.norm(x)
            if norm > 0:
                centres[d][cell] = x / norm
        now.destroy()
    discard(sample)
    return centres


def _adder(centres):
    """A task's sums of its rows by their nearest centre."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for batch in batches:
            v, size = _unit(batch.column("v"))
            for d in np.unique(size).tolist():
                x, near = np.stack([v[i] for i in np.flatnonzero(size == d)]), centres.value[d]
                if d not in totals:
                    totals[d] = np.zeros_like(near), np.zeros(len(near), bool)
                total, met = totals[d]
                cell = (x @ near.T).argmax(1)
                np.add.at(total, cell, x)
                met[cell] = True
        for d, (total, met) in totals.items():
            cells = np.flatnonzero(met)
            for at in range(0, len(cells), 1024):
                part = cells[at : at + 1024]
                columns = [pa.array(np.full(len(part), d), pa.int32()), pa.array(part, pa.int32()), pa.array([total[c].tobytes() for c in part], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["d", "cell", "total"])

    return add


def _added(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """The sum of a cell's sums, a row for each task, in an order of their own so that reruns agree."""
    rows = sorted(t.column("total").to_pylist())
    total = np.sum([np.frombuffer(r, np.float64) for r in rows], axis=0)
    return pa.table({"d": t.column("d")[:1], "cell": t.column("cell")[:1], "total": pa.array([total.tobytes()], pa.binary())})


def _comparer(least: float):
    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        resident, home = t.column("resident").to_numpy().astype(bool), t.column("home").to_numpy()
        x = np.frombuffer(b"".join(t.column("u").to_pylist()), np.float64).reshape(t.num_rows, -1)
        c, m, k = (t.column(n).to_numpy() for n in ("c", "m", "k"))
        res, ask = np.flatnonzero(resident), np.flatnonzero(~resident)
        # In which of the askers' homes each resident asks itself.
        homes, at_home = np.unique(home, return_inverse=True)
        asked = np.zeros((len(res), len(homes)), bool)
        lists = t.column("cells").filter(pa.array(resident)).combine_chunks()
        if len(res):
            flat, of = lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(res)), np.diff(lists.offsets.to_numpy()))
            place = np.minimum(np.searchsorted(homes, flat), len(homes) - 1)
            there = homes[place] == flat
            asked[of[there], place[there]] = True
        links = np.zeros(t.num_rows, np.int64)
        up = np.arange(t.num_rows)

        def roots(i):
            while (up[up] != up).any():
                up[:] = up[up]
            return up[i]

        for at in range(0, len(res), 512):
            own = res[at : at + 512]
            row, b = np.nonzero(x[own] @ x[ask].T >= least)
            a, b, row = own[row], ask[b], row + at
            other = k[a] != k[b]
            a, b, row = a[other], b[other], row[other]
            np.add.at(links, b, m[a])
            # The resident counts the asker here unless it asks in the asker's home itself.
            away = ~asked[row, at_home[b]]
            np.add.at(links, a[away], m[b[away]])
            while len(a):  # hooks pairs of different sets until there are none
                ra, rb = roots(a), roots(b)
                open_ = ra != rb
                a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
                np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        of = roots(np.arange(t.num_rows))
        low = c.copy()
        np.minimum.at(low, of, c)
        to = low[of]
        on = (links > 0) | (to != c)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k[on]), pa.array(c[on]), pa.array(links[on]), pa.array(np.where(to != c, to, -1)[on], mask=(to == c)[on])],
            names=["k", "c", "links", "up"],
        )

    return compare

