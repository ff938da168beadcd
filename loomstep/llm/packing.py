"""Best-fit packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomstep.llm.common import materialize, raw_texts, small_batches

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker keeps before it starts again, some 200 MB.
KNOWN_WORDS = 1_000_000


def tokenize_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and end_id, cut where longer than capacity.

    The vocabulary drops ASCII white space and no token spans it, so the ids of a text are those of its
    words in a row; a worker encodes a word once for as long as its bounded cache of words holds it. Null text is empty (one piece with
    end_id alone), repeated rows give repeated pieces, other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast({"json": f.read()})
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        if "words" not in model.value:  # a worker's copy: what it has encoded serves its later tasks as well
            model.value["words"] = WordIds(model.value["json"])
        known = model.value["words"]
        for batch in small_batches(batches):
            # The model lowers letters itself, but special tokens count only as they are written.
            split = [(t if b"<|" in t else t.lower()).split() for t in raw_texts(batch.column(1))]
            known.learn(set().union(*split).difference(known.of))
            rows = []
            for doc_id, words in zip(batch.column(0).to_pylist(), split, strict=True):
                ids = b"".join(map(known.of.__getitem__, words)) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if with_ids else row)
            known.shrink()
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = list(zip(*rows, strict=True)) or [[]] * (5 + with_ids)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, fields)


#: Lower-case letters of words whose pre-tokens are found here: they have no other form, neither by case nor by composition.
_LETTERS = "".join(c for c in map(chr, range(0x180)) if c.isalpha() and c.lower() == c)
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_PLAIN = re.compile(f"[{re.escape(_LETTERS + _MARKS)}0-9]+")
#: The tokenizer's own pre-tokens, over these characters.
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{re.escape(_LETTERS)}]+|[0-9]|[{re.escape(_MARKS)}]+")
#: The characters that stand for bytes in the vocabulary: those that print stand for themselves.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}


class WordIds:
    """of: the ids of words as bytes. Most words skip the tokenizer's steps before its model: they are lower-case
    letters, digits and ASCII marks, whose pre-tokens one pattern finds; the model splits each pre-token once.
    """

    def __init__(self, json: str, most: int = KNOWN_WORDS):
        from tokenizers import Tokenizer

        self.of: dict[bytes, bytes] = {}
        self.tok, self.most = Tokenizer.from_str(json), most
        self.split = self.tok.model.tokenize
        raw = np.arange(max(self.tok.get_vocab(with_added_tokens=True).values()) + 1, dtype="<u4").tobytes()
        self.raw = [raw[i : i + 4] for i in range(0, len(raw), 4)]

    def learn(self, new: set[bytes]) -> None:
        """Encodes words that aren't known yet."""
        hard = []
        for w in new:
            text = w.decode()
            if b"<|" in w or not _PLAIN.fullmatch(text):
                hard.append(w)
            elif len(parts := _PARTS.findall(text)) == 1:
                self.of[w] = self.ids(text)
            else:
                self.of[w] = b"".join([self.of.get(p.encode()) or self.ids(p) for p in parts])
        self.of.update(_encoded(self.tok, sorted(hard)))

    def ids(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(_BYTE_CHARS)
        return b"".join([self.raw[t.id] for t in self.split(part)])

    def shrink(self) -> None:
        if len(self.of) > self.most:
            self.of.clear()


def _encoded(tok, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Each word with its ids; the words are encoded as one text, in which a token lies within one word."""
    if not words:
        return
    texts = [w.decode() for w in words]
    found = tok.encode(" ".join(texts), add_special_tokens=False)
    raw = np.asarray(found.ids, "<u4").tobytes()
    starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
    at = 0
    for w, end in zip(words, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist(), strict=True):
        yield w, raw[4 * at : 4 * end]
        at = end


@dataclass
class _Bins:
    """n bins that hold the same lengths; slots: (length, first rank, items a bin, offset in the bin)."""

    n: int
    slots: list[tuple[int, int, int, int]] = field(default_factory=list)

    def split(self, m: int) -> _Bins:
        """Takes the first m bins away."""
        first = _Bins(m, self.slots)
        self.n, self.slots = self.n - m, [(size, rank + m * k, k, at) for size, rank, k, at in self.slots]
        return first


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[_Bins]:
    """Bins for so many items of each length, from the counts alone: cost and memory follow the number of lengths.

    Items above a third of the capacity: the largest is matched with the largest that fits beside it, two a
    bin at most. The others, in descending order, go to the bin with the smallest gap that holds them.
    """
    left, used = dict(counts), defaultdict(int)
    gaps: dict[int, list[_Bins]] = defaultdict(list)
    order: list[int] = []

    def put(bins: _Bins, gap: int) -> None:
        if gap not in gaps or not gaps[gap]:
            insort(order, gap)
        gaps[gap].append(bins)

    def take(size: int, n: int) -> int:
        used[size] += n
        left[size] -= n
        return used[size] - n

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for a in large:
        for b in large:
            if not left[a] or b > a or a + b > capacity or not left[b]:
                continue
            m = left[a] // 2 if a == b else min(left[a], left[b])
            if m and a == b:
                put(_Bins(m, [(a, take(a, 2 * m), 2, 0)]), capacity - 2 * a)
            elif m:
                put(_Bins(m, [(a, take(a, m), 1, 0), (b, take(b, m), 1, a)]), capacity - a - b)
        if left[a]:
            m = left[a]
            put(_Bins(m, [(a, take(a, m), 1, 0)]), capacity - a)
    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[s]:
            i = bisect_left(order, s)
            if i == len(order):
                k = min(capacity // s, left[s])
                m = left[s] // k
                put(_Bins(m, [(s, take(s, m * k), k, 0)]), capacity - k * s)
                continue
            gap = order[i]
            bins = gaps[gap][-1]
            k = min(gap // s, left[s])
            m = min(bins.n, left[s] // k)
            if m == bins.n:
                gaps[gap].pop()
                if not gaps[gap]:
                    order.pop(i)
            else:
                bins = bins.split(m)
            put(_Bins(m, [*bins.slots, (s, take(s, m * k), k, capacity - gap)]), gap - k * s)
    return [b for gap in sorted(gaps) for b in gaps[gap]]


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset: which sequence holds the piece, and where, gapless from 0.

    The plan needs only how many pieces have each length (capacity numbers at most), so the driver makes it
    whatever the number of pieces. A piece's place follows from its rank within its length; ranks are taken in
    salted parts of a length, their number growing as the root of that of the pieces, so a length or an id
    that a third of all pieces share is dealt out. Order and result are those of pieces sorted by (doc_id,
    piece, ids_crc32), hence reruns agree. No pieces give no rows.
    """
    order_of = pieces.columns
    pieces = materialize(pieces, "pieces")
    salts = math.ceil(math.sqrt(pieces.count()) / 8) or 1
    pieces = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = pieces.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    first = materialize(counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))), "counts")
    total = {r["length"]: r["n"] for r in first.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    starts, slots, base = [], [], 0
    for bins in plan_bins(total, capacity):
        for size, rank, k, at in bins.slots:
            starts.append((size << 44) + rank)
            slots.append((rank, k, base, at))
        base += bins.n
    order = np.argsort(np.asarray(starts, np.int64))
    plan = pieces.sparkSession.sparkContext.broadcast(
        (np.asarray(starts, np.int64)[order], np.asarray(slots, np.int64).reshape(-1, 4)[order])
    )
    rank = F.row_number().over(W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32"))
    # The window needs the rows dealt by these keys anyway, so the table of counts is merged and never sent whole.
    ranked = pieces.join(first.select("length", "_salt", "_first").hint("merge"), ["length", "_salt"]).withColumn("_rank", rank - 1 + F.col("_first"))
    ranked = ranked.drop("_salt", "_first")
    names = [c for c in ranked.columns if c != "_rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")

    def place(batches):
        keys, table = plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            size, r = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_rank"))
            start, k, seq, at = table[np.searchsorted(keys, (size << 44) + r, side="right") - 1].T
            which = r - start
            more = [pa.array(seq + which // k), pa.array(at + which % k * size)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *more], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long").select(*order_of, "sequence_id", "offset")
