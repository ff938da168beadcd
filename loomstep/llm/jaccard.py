"""Documents whose sets of word shingles are similar: a grouped prefix join, exact at any threshold.

A document's set holds its distinct shingles as 64-bit hashes. All sets are ordered alike: rare shingles
first, by a table of counters over all documents, then by hash. Two sets of Jaccard similarity t or more
share one of the first n - ceil(t * n) + 1 shingles (the prefix) of each, and neither is smaller than t
times the other. Documents with the same prefix and size form a group, and only groups are joined.

Classes of equal sets are linked without a comparison. In each group and each list of groups that hold a
prefix shingle, every class is first compared with the smallest one (a star); the classes that this links
are then one component, and only pairs of different components are compared after that. So a group of
thousands of near copies costs a star and not all its pairs, while no link between components is lost.
A group may hold classes of several components; each of these parts is then compared for itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import CACHE_WORDS, discard, few_rows, materialize, raw_texts, small_batches
from loomstep.llm.components import components

#: Counters of the table by which shingles are ordered: 2 ** 20, doubled for each eightfold of this many bytes, to 2 ** 23.
#: A shingle stands out from those that share its counter by the root of their number, so lists stay about that long.
SKETCH_BITS, SKETCH_BYTES, MOST_BITS = 20, 1 << 33, 23
_SLICES = 1024
#: Counters of a set's signature.
SIGNATURE = 64
#: Up to so many ids, a filter of documents is broadcast; beyond, it is a join by shuffle.
BROADCAST_IDS = 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word):
        import xxhash

        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(texts: list[bytes], width: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, one text after the other, and how many each has.

    A-Z count as a-z. A text of fewer words than width is one shingle; one without words has none.
    """
    if len(known) > CACHE_WORDS:
        known.clear()
    split = [t.lower().split() for t in texts]
    words = [w for x in split for w in x]
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    doc = np.repeat(np.arange(len(split)), sizes)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(words)) - first[doc]
    short = np.minimum(sizes, width)
    starts = np.flatnonzero(place + short[doc] <= sizes[doc]) if len(words) else np.zeros(0, np.int64)
    out = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            there = short[doc[starts]] > k
            at = np.minimum(starts + k, max(len(words) - 1, 0))
            out = np.where(there, _mixed((out + _MIX) * np.uint64(3) + h[at]), out)
    of = doc[starts]
    order = np.lexsort((out, of))
    out, of = out[order], of[order]
    new = np.append(True, (out[1:] != out[:-1]) | (of[1:] != of[:-1])) if len(out) else np.zeros(0, bool)
    return out[new], np.bincount(of[new], minlength=len(texts)).astype(np.int64)


def _digest(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for each set."""
    ends = np.cumsum(sizes)
    sums = []
    with np.errstate(over="ignore"):
        for seed in (1, 2):
            total = np.concatenate(([np.uint64(0)], np.cumsum(_mixed(hashes + np.uint64(seed) * _MIX), dtype=np.uint64)))
            sums.append((total[ends] - total[ends - sizes]).view(np.int64))
    return sums[0], sums[1]


def sketch_bits(n_bytes: int) -> int:
    return min(MOST_BITS, SKETCH_BITS + math.ceil(math.log2(max(n_bytes, SKETCH_BYTES) / SKETCH_BYTES) / 3))


def shingle_counters(docs: DataFrame, text_col: str, width: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """How often shingles of all documents fall into each of 2 ** bits counters; a table of fixed size."""
    each = (1 << bits) // _SLICES

    def run(batches):
        total, known = np.zeros(1 << bits, np.int64), WordHashes()
        for batch in small_batches(batches):
            hashes, _ = shingle_sets(raw_texts(batch.column(0)), width, known)
            total += np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        full = np.flatnonzero(total.reshape(_SLICES, each).any(axis=1))
        part = np.minimum(total, 2**31 - 1).astype("<i4").reshape(_SLICES, each)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([part[i].tobytes() for i in full], pa.binary())], names=["slice", "part"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(each, np.int64)
        for batch in batches:
            for part in batch.column("part").to_pylist():
                total += np.frombuffer(part, "<i4")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["slice", "part"])

    parts = docs.select(text_col).mapInArrow(run, "slice int, part binary").groupBy("slice").applyInArrow(add, "slice int, part binary")
    with few_rows(docs.sparkSession):
        rows = parts.collect()
    table = np.zeros((_SLICES, each), np.int64)
    for r in rows:
        table[r["slice"]] = np.frombuffer(r["part"], "<i8")
    return table.reshape(-1)


def prefixes(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: Fraction, counters: np.ndarray) -> DataFrame:
    """(doc_id, n, s1, s2, g1, g2, prefix, signature): size and digest of each set, digest of its prefix, the prefix, how many hashes fall in each class."""
    spark = docs.sparkSession
    bits = int(len(counters)).bit_length() - 1
    table = spark.sparkContext.broadcast(np.minimum(counters, 2**32 - 1).astype(np.uint32))
    num, den = threshold.numerator, threshold.denominator

    def run(batches):
        known = WordHashes()
        for batch in small_batches(batches):
            hashes, n = shingle_sets(raw_texts(batch.column(1)), width, known)
            s1, s2 = _digest(hashes, n)
            of = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((hashes, table.value[(hashes >> np.uint64(64 - bits)).astype(np.int64)], of))
            k = n - -(-n * num // den) + (n > 0)
            first = np.cumsum(n) - n
            inside = np.arange(len(hashes)) - first[of] < k[of]
            taken = hashes[order][inside]
            g1, g2 = _digest(taken, k)
            offsets = np.concatenate(([0], np.cumsum(k))).astype(np.int32)
            held = np.bincount(of * SIGNATURE + (hashes % np.uint64(SIGNATURE)).astype(np.int64), minlength=len(n) * SIGNATURE)
            each = np.arange(0, len(held) + 1, SIGNATURE, dtype=np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(taken.view(np.int64))), pa.ListArray.from_arrays(each, pa.array(held.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), *map(pa.array, (s1, s2, g1, g2)), *lists],
                names=["doc_id", "n", "s1", "s2", "g1", "g2", "prefix", "signature"],
            )

    fields = "doc_id long, n long, s1 long, s2 long, g1 long, g2 long, prefix array<long>, signature array<int>"
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, fields)


def set_table(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, hashes): the shingle set of each document."""

    def run(batches):
        known = WordHashes()
        for batch in small_batches(batches):
            hashes, n = shingle_sets(raw_texts(batch.column(1)), width, known)
            offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))], names=["doc_id", "hashes"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, hashes array<long>")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar.

    Sets differ in at least as many shingles as their signatures do, so most pairs that only share a shingle
    by chance go before any set is built; the sets of the others are compared shingle by shingle.
    """
    num, den = threshold.numerator, threshold.denominator
    for name in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("c").alias(name), F.col("n").alias(f"n{name}"), F.col("signature").alias(f"s{name}")), name)
    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.abs(x - y)), F.lit(0), lambda t, x: t + x)
    close = pairs.where(apart * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b").distinct()
    close = materialize(close, "close")
    wanted_ids = materialize(close.select(F.col("a").alias("_wanted")).union(close.select("b")).distinct(), "wanted")
    wanted = F.broadcast(wanted_ids) if wanted_ids.count() <= BROADCAST_IDS else wanted_ids
    rows = docs.join(wanted, F.col(id_col).cast("long") == F.col("_wanted"), "left_semi")
    sets = materialize(set_table(rows, id_col, text_col, width), "sets")
    a = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    union = F.size("x") + F.size("y") - both
    links = materialize(close.join(a, "a").join(b, "b").where(den * both >= num * union).select("a", "b"), "links")
    discard(close, wanted_ids, sets)
    return links


def similar_documents(
    docs: DataFrame,
    *,
    width: int = 5,
    threshold: Fraction = Fraction(4, 5),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id): size of the set, and the smallest doc_id reachable by similar pairs.

    Rows of a null id are linked with nothing and have no component. Null texts and texts without words have an empty set and stay alone.
    Repeated rows of one id and text give one row; of one id with several texts, one row for each set, all
    in one component, as they share the id. Only id_col and text_col are read; an empty table gives no rows.
    """
    n_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    counters = shingle_counters(docs, text_col, width, sketch_bits(n_bytes))
    rows = materialize(prefixes(docs, id_col, text_col, width, threshold, counters), "prefixes")
    full = rows.where("n > 0 and doc_id is not null")
    # A class: documents with equal sets; it goes by its smallest doc_id. A group: classes with one prefix and size.
    digest = ["s1", "s2", "n"]
    classes = full.groupBy(*digest).agg(F.min(F.struct("doc_id", "g1", "g2", "prefix", "signature")).alias("m"))
    classes = materialize(classes.select(*digest, F.col("m.doc_id").alias("c"), "m.g1", "m.g2", "m.prefix", "m.signature"), "classes")
    group = ["g1", "g2", "n"]
    groups = classes.groupBy(*group).agg(F.min(F.struct("c", "prefix")).alias("m"), F.count(F.lit(1)).alias("k"))
    groups = materialize(groups.select(*group, F.col("m.c").alias("g"), "k", "m.prefix"), "groups")
    # Different sets of n shingles share n - 1 of n + 1 at most.
    near = (F.col("n") - 1) * threshold.denominator >= (F.col("n") + 1) * threshold.numerator
    members = classes.select(*group, "c").join(groups.where("k > 1").select(*group, "g"), group)
    members = materialize(members.select("g", "c", near.alias("near")), "members")
    same = full.select(*digest, "doc_id").join(classes.select(*digest, "c"), digest).where("doc_id != c")
    links = [materialize(same.select(F.col("doc_id").alias("a"), F.col("c").alias("b")), "links")]

    # Lists of the groups that hold a shingle in their prefix; one group alone isn't linked by it.
    posted = groups.select("g", "n", F.posexplode("prefix").alias("i", "t"))
    shared = posted.groupBy("t").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("t")
    band = F.floor(F.log("n") / F.lit(-math.log(float(threshold))))
    lists = materialize(posted.join(shared, "t").select("t", "g", "n", "i", band.alias("band")), "lists")
    fit = _fit(threshold)
    # Of a list of near copies, the group with the fewest rarer shingles is nearest to what they are copies of.
    chosen = F.min_by(F.struct("g", "n", "i"), F.struct("i", F.xxhash64("t", "g")))
    head = lists.groupBy("t", "band").agg(chosen.alias("h")).select("t", "band", "h.*")
    star = lists.alias("x").join(head.alias("y"), ["t", "band"]).where(fit & (F.col("x.g") != F.col("y.g"))).select(*_ends("g"))
    inner = members.where("near and g != c").select(F.col("g").alias("a"), F.col("c").alias("b"))
    pairs = materialize(star.union(inner).distinct(), "pairs")
    verified = lambda p: _verified(p, classes, docs, id_col, text_col, width, threshold)
    links.append(verified(pairs))

    # What the stars leave: pairs of parts in different components, a part being a group's classes of one component.
    first = components(links[0].union(links[1]))
    found = materialize(first, "found")
    discard(first)
    of = lambda name, new: found.select(F.col("node").alias(name), F.col("component").alias(new))
    single = members.join(of("c", "k"), "c", "left").withColumn("k", F.coalesce("k", "c"))
    single = single.join(of("g", "main"), "g", "left").withColumn("main", F.coalesce("main", "g"))
    single = materialize(single, "single")
    label = lists.join(of("g", "own"), "g", "left").join(single.select("g", "k").distinct(), "g", "left")
    label = label.withColumn("k", F.coalesce("k", "own", "g")).withColumn("part", F.struct("g", "k")).drop("own")
    label = materialize(label, "labels")
    several = label.groupBy("t").agg(F.min("k").alias("main"), F.max("k").alias("other")).where("main != other").select("t", "main")
    mixed = materialize(label.join(several, "t"), "mixed")
    apart = (F.col("x.g") != F.col("y.g")) & (F.col("x.k") != F.col("y.k")) & ((F.col("y.k") == F.col("y.main")) | (F.col("x.g") < F.col("y.g")))
    rest = mixed.where("k != main").alias("x").join(mixed.alias("y"), F.col("x.t") == F.col("y.t")).where(fit & apart)
    rest = materialize(rest.select(*_ends("part")).distinct(), "rest")
    parts = rest
    for name in ("a", "b"):  # parts are expanded to their classes
        own = single.select(F.struct("g", "k").alias(name), "c")
        rest = rest.join(own, name, "left").withColumn(name, F.coalesce("c", f"{name}.g")).drop("c")
    apart = (F.col("x.k") != F.col("y.k")) & ((F.col("y.k") == F.col("y.main")) | (F.col("x.c") < F.col("y.c")))
    inside = single.where("near and k != main").alias("x").join(single.alias("y"), F.col("x.g") == F.col("y.g")).where(apart)
    more = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(inside.select(*_ends("c")))
    more = materialize(more.distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    links.append(verified(more))
    discard(classes, groups, members, lists, pairs, found, single, label, mixed, parts, more)

    found = components(links[0].union(links[1]).union(links[2]))
    discard(*links)
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "s1", "s2").distinct()
    found = found.withColumnRenamed("node", "doc_id")
    return out.join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _ends(name: str) -> list[Column]:
    x, y = F.col(f"x.{name}"), F.col(f"y.{name}")
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _fit(threshold: Fraction) -> Column:
    """Whether sets x and y of sizes n may be similar, if the shingle at places x.i and y.i is the first that they share.

    No more shingles than from there on can be shared. Similar sets pass at their first common shingle, which
    is enough for a pair to be found; later ones may fail.
    """
    num, den = threshold.numerator, threshold.denominator
    sizes = (F.col("x.n") * den >= F.col("y.n") * num) & (F.col("y.n") * den >= F.col("x.n") * num)
    most = F.least(F.col("x.n") - F.col("x.i"), F.col("y.n") - F.col("y.i"))
    return sizes & (most * (num + den) >= (F.col("x.n") + F.col("y.n")) * num)
