"""A manifest of a dataset: a Merkle tree over its rows, kept as an append log in postorder, with proofs for each row.

Each run of rows (a language, say) has a tree of its own, whose leaves ascend by id; a tree over the runs' roots
has the root of the whole. Two nodes in a row make their parent, a last one without a partner makes it alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomstep.llm.common import discard, materialize

#: Levels of the subtree that one builder makes: 4096 leaves, some 520 KB of log.
LEVELS = 12
#: What a proof's step does: nothing to join, a sibling on the left, one on the right.
ALONE, LEFT, RIGHT = 0, 1, 2
_LOG = "run string, n long, block long, nodes binary"


def leaf(columns: list[Column]) -> Column:
    """SHA-256 (hex) of the columns in a row: each as its UTF-8 bytes' number, ':' and itself, a null as '-'."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)).cast("binary"), 256)


def joined(parts: list[bytes]) -> bytes:
    """The node above one or two digests, which are hashed as hex text."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def levels_above(n: int) -> int:
    """Levels above n leaves until one node is left."""
    return max(n - 1, 0).bit_length()


def position(level: int, index: int, n: int) -> int:
    """Place in the postorder log, over n leaves, of the node over the leaves from index << level on.

    After m leaves 2m less the ones in m's binary form are complete; a full subtree of 2^level leaves adds
    2^(level+1) - 1 nodes, its root last. Nodes that lack leaves are complete after the last leaf, from the lowest on.
    """
    first = index << level
    if first + (1 << level) <= n:
        return 2 * first - first.bit_count() + (2 << level) - 2
    full = (n & -n).bit_length() - 1  # levels whose last node is full
    return 2 * n - n.bit_count() + level - 1 - full


def append_log(leaves: list[bytes], levels: int) -> list[bytes]:
    """The nodes over leaves up to so many levels in the order in which they become complete."""
    log, open_nodes = [], []  # open: (level, digest) of subtrees without a parent yet, sizes falling

    def done(level: int, digest: bytes) -> None:
        log.append(digest)
        open_nodes.append((level, digest))

    for digest in leaves:
        done(0, digest)
        while len(open_nodes) > 1 and open_nodes[-1][0] == open_nodes[-2][0]:
            (_, right), (level, left) = open_nodes.pop(), open_nodes.pop()
            done(level + 1, joined([left, right]))
    while open_nodes and (len(open_nodes) > 1 or open_nodes[-1][0] < levels):
        level, digest = open_nodes.pop()
        partner = open_nodes.pop()[1] if open_nodes and open_nodes[-1][0] == level else None
        done(level + 1, joined([digest] if partner is None else [partner, digest]))
    return log


def sibling_steps(index: int, n: int, levels: int, log: bytes) -> tuple[bytes, bytes]:
    """(steps, digests) of the proof of one leaf within a log: a byte a level, and the siblings in a row."""
    steps, found = bytearray(), []
    for level in range(levels):
        other = index ^ 1
        if other << level >= n:
            steps.append(ALONE)
        else:
            steps.append(LEFT if other < index else RIGHT)
            at = 32 * position(level, other, n)
            found.append(log[at : at + 32])
        index >>= 1
    return bytes(steps), b"".join(found)


def fold(digest: bytes, steps: bytes, siblings: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    at = 0
    for step in steps:
        if step == ALONE:
            digest = joined([digest])
        else:
            other = siblings[at : at + 32]
            digest = joined([other, digest] if step == LEFT else [digest, other])
            at += 32
    return digest


def _local(n: int, block: int) -> tuple[int, int]:
    """(leaves, levels) of a builder's block in a run of n leaves: all levels, if other blocks are above it too."""
    size = min(n - (block << LEVELS), 1 << LEVELS)
    return size, LEVELS if n > 1 << LEVELS else levels_above(n)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows, which have a run, with n, the run's number of rows, and rank, a row's place in it by order, from 0.

    Rows are dealt by ranges of (run, order), so one long run is many tasks; only counts a range and run are added up.
    What is equal in all of these is told apart by its place in the input, as its order changes nothing.
    """
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["run", *order, "_tie"]
    placed = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_part", F.shiftright("_at", 33)), "ranked")
    parts = placed.groupBy("run", "_part").agg(F.min("_at").alias("_least"), F.count(F.lit(1)).alias("_n"))
    run = W.partitionBy("run")
    before = F.coalesce(F.sum("_n").over(run.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("run", "_part", (before - F.col("_least")).alias("_shift"), F.sum("_n").over(run).alias("n"))
    made = placed.join(parts, ["run", "_part"]).withColumn("rank", F.col("_at") + F.col("_shift"))
    return made.drop("_at", "_part", "_shift")


def _build(rows: DataFrame, carried: list[str]) -> DataFrame:
    """The logs of aligned blocks of (run, n, rank, digest), with the carried columns of their leaves as arrays."""
    kinds = dict(rows.dtypes)
    schema = ", ".join([_LOG, *(f"`{c}` array<{kinds[c]}>" for c in carried)])

    def run(key, group):
        group = group.sort_by("rank")
        n, block = group.column("n")[0].as_py(), key[1].as_py()
        log = append_log(group.column("digest").to_pylist(), _local(n, block)[1])
        arrays = [[key[0].as_py()], [n], [block], [b"".join(log)], *([group.column(c).to_pylist()] for c in carried)]
        fields = [pa.string(), pa.int64(), pa.int64(), pa.binary(), *(pa.list_(group.schema.field(c).type) for c in carried)]
        names = ["run", "n", "block", "nodes", *carried]
        return pa.Table.from_arrays([pa.array(a, k) for a, k in zip(arrays, fields, strict=True)], names=names)

    blocks = rows.withColumn("block", F.shiftright("rank", LEVELS)).select(*dict.fromkeys(["run", "n", "rank", "digest", "block", *carried]))
    return blocks.groupBy("run", "block").applyInArrow(run, schema)


def build(rows: DataFrame, carried: list[str] = ()) -> list[DataFrame]:
    """Append logs of all runs, lowest layer first: (run, n, block, nodes[, carried columns as arrays]).

    rows: (run, n, rank, digest, ...) from ranked(). The blocks' own roots are the leaves of the next layer, until
    each run has one block. A builder holds 4096 leaves, whatever the runs are; the driver gets one number a layer.
    """
    layers = [materialize(_build(rows, list(carried)), "log")]
    while not layers[-1].where(F.col("n") > 1 << LEVELS).isEmpty():
        more = layers[-1].where(F.col("n") > 1 << LEVELS)
        blocks = F.shiftright(F.col("n") - 1, LEVELS) + 1
        above = more.select("run", blocks.alias("n"), F.col("block").alias("rank"), F.expr("substring(nodes, -32, 32)").alias("digest"))
        layers.append(materialize(_build(above, []), "log"))
    return layers


def roots(layers: list[DataFrame]) -> DataFrame:
    """(run, digest): each run's root, the last node of its one highest block."""
    tops = [layer.where(F.col("n") <= 1 << LEVELS).select("run", F.expr("substring(nodes, -32, 32)").alias("digest")) for layer in layers]
    found = tops[0]
    for top in tops[1:]:
        found = found.union(top)
    return found


_PROOF = "run string, rank long, steps binary, siblings binary, subroot binary"


def _proofs(blocks: DataFrame, carried: list[str]) -> DataFrame:
    """The proofs of the leaves of blocks, which have the proof of their own root in steps, siblings and subroot."""
    kinds = {c: dict(blocks.dtypes)[c].removeprefix("array<").removesuffix(">") for c in carried}
    schema = ", ".join([_PROOF, *(f"`{c}` {k}" for c, k in kinds.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = {c: batch.column(c)[at] for c in batch.schema.names}
                n, block, log = one["n"].as_py(), one["block"].as_py(), one["nodes"].as_py()
                size, levels = _local(n, block)
                own = [sibling_steps(i, size, levels, log) for i in range(size)]
                steps, siblings = one["steps"].as_py(), one["siblings"].as_py()
                first = block << LEVELS
                arrays = [
                    pa.array([one["run"].as_py()] * size, pa.string()),
                    pa.array(range(first, first + size), pa.int64()),
                    pa.array([s + steps for s, _ in own], pa.binary()),
                    pa.array([s + siblings for _, s in own], pa.binary()),
                    pa.array([one["subroot"].as_py()] * size, pa.binary()),
                    *(one[c].values for c in carried),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["run", "rank", "steps", "siblings", "subroot", *carried])

    return blocks.select("run", "n", "block", "nodes", "steps", "siblings", "subroot", *carried).mapInArrow(run, schema)


def proofs(layers: list[DataFrame], carried: list[str] = (), over: DataFrame | None = None) -> DataFrame:
    """(run, rank, steps, siblings, subroot, carried columns) of every leaf: siblings from the lowest up.

    layers: what build() wrote. They are read from the top: a run's highest block goes on with over, the proof of
    the run itself by run (steps, siblings, subroot), a lower block with that of its root; leaves read their siblings
    from their block's log by position. So joins have one row a block.
    """
    nothing = {"steps": F.lit(b""), "siblings": F.lit(b""), "subroot": F.lit(None).cast("binary")}
    above = None
    for i in reversed(range(len(layers))):
        highest = layers[i].where(F.col("n") <= 1 << LEVELS)
        blocks = highest.withColumns(nothing) if over is None else highest.join(over, "run")
        if above is not None:
            up = above.select("run", F.col("rank").alias("block"), "steps", "siblings", "subroot")
            blocks = blocks.unionByName(layers[i].join(up, ["run", "block"]))
        above = _proofs(blocks, list(carried) if not i else [])
    return above


def manifest(
    docs: DataFrame,
    *,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    run_col: str = "lang",
    id_col: str = "doc_id",
    shown: Column | None = None,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, steps, siblings, folded_root), digests as bytes: one row a document.

    shown: the leaf (hex) that is folded with the document's siblings instead of its own, as when its row came from
    elsewhere; folded_root equals root where it is the same. Runs ascend as text, a null run first; leaves ascend by
    id, null first, then by leaf, so equal ids have a fixed order and rows that are equal in all columns share a
    digest. Nulls in any column count as '-', an empty table gives no rows, other columns are not read. Texts are
    hashed where they are read and never shuffled. What is read lazily stays in the shared folder.
    """
    own = leaf([F.col(f"`{c}`") for c in columns])
    # Text order, null first: a null run is the empty string, others begin with '='.
    run = F.coalesce(F.concat(F.lit("="), F.col(run_col)), F.lit(""))
    rows = docs.select(run.alias("run"), F.col(id_col).cast("long").alias("doc_id"), F.unhex(own).alias("digest"), F.unhex(own if shown is None else shown).alias("told"))
    rows = materialize(rows, "leaves")
    placed = ranked(rows, ["doc_id", "digest"])
    layers = build(placed, ["doc_id", "digest", "told"])
    tops = ranked(roots(layers).select(F.lit("").alias("run"), F.col("run").alias("of"), "digest"), ["of"])
    upper = build(tops, ["of", "digest"])
    top = roots(upper).first()
    over = proofs(upper, ["of", "digest"]).select(F.col("of").alias("run"), "steps", "siblings", F.col("digest").alias("subroot"))
    done = _folded(proofs(layers, ["doc_id", "digest", "told"], over), top["digest"] if top else None)
    discard(rows)
    return done


def _folded(proved: DataFrame, root: bytes | None) -> DataFrame:
    names = ["doc_id", "leaf", "subroot", "root", "steps", "siblings", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = map(fold, *(batch.column(c).to_pylist() for c in ("told", "steps", "siblings")))
            kept = [batch.column(c) for c in ("doc_id", "digest", "subroot")]
            top = pa.array([root] * batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([*kept, top, batch.column("steps"), batch.column("siblings"), pa.array(list(ends), pa.binary())], names=names)

    kinds = ", ".join(["doc_id long", *(f"{c} binary" for c in names[1:])])
    return proved.select("doc_id", "digest", "told", "subroot", "steps", "siblings").mapInArrow(run, kinds)


def hex_of(digest: str) -> Column:
    return F.lower(F.hex(digest))
