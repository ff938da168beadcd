"""Alignment of two tokenizers' tokens of the same texts, by the bytes that they cover.

Tokens of both tile a text's bytes. Two tokens are linked where their ranges overlap; where both end, the text is
cut into groups.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomstep.llm.common import CACHE_WORDS, above_bin, discard, materialize, small_batches

#: Words that one pair of pointers walks; a longer document is walked by several pairs at once.
LANE = 64
#: Words of a group of documents whose pointers advance together, about.
GROUP_WORDS = 200_000
#: Linked pairs, at most, whose counts every worker holds (some 4 MB); the others' counts are joined.
FREQUENT = 1 << 18
#: Letters of a word that is kept for later documents, at most.
KEPT_LETTERS = 64
#: A blank between other characters: both tokenizers begin a token there, whatever stands around it.
_BREAK = re.compile("(?<=[^ ]) (?=[^ ])")
#: Bits of an id of the second vocabulary in a pair.
_BITS = 15


def words_of(text: str) -> list[str]:
    """Parts of a text that each tokenizer encodes by themselves, without the blank before each."""
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _BREAK.split(text)
    return text.split(" ")


def walk(a_ends: np.ndarray, b_ends: np.ndarray, a: np.ndarray, a_stop: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, cut) of each link: token numbers, and whether both tokens end there.

    a, b: the first tokens of each lane, a_stop: behind its last one. All lanes' pointers are one state vector: a
    step links the tokens under the pointers and moves the one that ends first, both where they end together, which
    is a cut. Finished lanes leave the vector.
    """
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    on = a < a_stop
    a, b, a_stop = a[on], b[on], a_stop[on]
    while len(a):
        ea, eb = a_ends[a], b_ends[b]
        steps.append((a, b, ea == eb))
        a, b = a + (ea <= eb), b + (eb <= ea)
        on = a < a_stop
        if not on.all():
            a, b, a_stop = a[on], b[on], a_stop[on]
    if not steps:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    return tuple(np.concatenate(part) for part in zip(*steps, strict=True))


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers below n in decimal: a row of characters each, and how many count."""
    text = np.char.mod("%d", np.arange(n)).astype("S")
    return text.view(np.uint8).reshape(n, -1), np.char.str_len(text).astype(np.int64)


def _spans(sizes: np.ndarray) -> np.ndarray:
    """Where each of so large parts begins, and the end."""
    return np.append(0, np.cumsum(sizes))


def _gather(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each part in a row."""
    starts = _spans(sizes)
    return np.repeat(first - starts[:-1], sizes) + np.arange(starts[-1])


class Tokens:
    """Both tokenizers, and the ids of words that they have met: word number i has ids a[a_at[i] : a_at[i + 1]]."""

    def __init__(self, a_json: str, b_proto: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a_model = Tokenizer.from_str(a_json)
        self.a_model.encode_special_tokens = True
        self.b_model = sentencepiece.SentencePieceProcessor(model_proto=b_proto)
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printed)))}
        named = {i: w for w, i in self.a_model.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(of[c] for c in w) if all(c in of for c in w) else w.encode() for w in (named.get(i, "") for i in range(max(named) + 1))]
        b = self.b_model
        self.b_bytes = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.a_digits, self.b_digits = _digits(len(self.a_bytes)), _digits(len(self.b_bytes))
        self.clear()

    def clear(self) -> None:
        self.of: dict[str, int] = {}
        self.a, self.b = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.a_at, self.b_at = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.good = np.zeros(0, bool)

    def learn(self, words: list[str]) -> int:
        """Encodes words (without the blank before them) and returns the number of the first."""
        first = len(self.good)
        if not words:
            return first
        whole = [" " + w for w in words]
        batch = getattr(self.a_model, "encode_batch_fast", self.a_model.encode_batch)
        a = [e.ids for e in batch(whole, add_special_tokens=False)]
        b = self.b_model.encode(words, num_threads=1)
        good = [b"".join(map(self.a_bytes.__getitem__, x)) == b"".join(map(self.b_bytes.__getitem__, y)) == w.encode() for x, y, w in zip(a, b, whole, strict=True)]
        self.good = np.append(self.good, good)
        self.a, self.a_at = self._more(self.a, self.a_at, a)
        self.b, self.b_at = self._more(self.b, self.b_at, b)
        return first

    @staticmethod
    def _more(flat: np.ndarray, at: np.ndarray, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        new = np.fromiter((i for x in lists for i in x), np.int32, int(sizes.sum()))
        return np.append(flat, new), np.append(at, at[-1] + np.cumsum(sizes))

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """The words' numbers of each text; none of a text that the tokens of either don't give back."""
        split = [words_of(t) if t else [] for t in texts]
        new = sorted({w for words in split for w in words if len(w) <= KEPT_LETTERS and w not in self.of})
        first = self.learn(new)
        self.of.update(zip(new, range(first, first + len(new)), strict=True))
        found = []
        for text, words in zip(texts, split, strict=True):
            long = [w for w in words if len(w) > KEPT_LETTERS]
            at = iter(range(first := self.learn(long), first + len(long)))
            own = np.fromiter((self.of[w] if len(w) <= KEPT_LETTERS else next(at) for w in words), np.int64, len(words)) if long else np.fromiter(map(self.of.__getitem__, words), np.int64, len(words))
            if not self.good[own].all():  # as a whole it may still be right
                own = np.array([self.learn([text])])
                own = own[self.good[own]]
            found.append(own)
        return found


@dataclass
class Aligned:
    """What a group of documents gives: numbers by document, and its different linked pairs with their times."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    pairs: np.ndarray
    times: np.ndarray
    pairs_at: np.ndarray


def align(tokens: Tokens, texts: list[str | None]) -> Aligned:
    """Walks all texts together. Bytes are counted through all of them, so a document needs no offset of its own."""
    numbers = tokens.numbers(texts)
    n = len(texts)
    sizes = np.fromiter(map(len, numbers), np.int64, n)
    words = np.concatenate(numbers) if n else np.zeros(0, np.int64)
    a_n, b_n = np.diff(tokens.a_at)[words], np.diff(tokens.b_at)[words]
    a, b = tokens.a[_gather(tokens.a_at[words], a_n)], tokens.b[_gather(tokens.b_at[words], b_n)]
    a_at, b_at, doc_at = _spans(a_n), _spans(b_n), _spans(sizes)
    lanes = -(-sizes // LANE)
    place = _gather(np.zeros(n, np.int64), lanes) * LANE
    starts = np.repeat(doc_at[:-1], lanes) + place
    stops = np.minimum(starts + LANE, np.repeat(doc_at[1:], lanes))
    a_link, b_link, cut = walk(np.cumsum(tokens.a_sizes[a]), np.cumsum(tokens.b_sizes[b]), a_at[starts], a_at[stops], b_at[starts])
    a_doc, b_doc = a_at[doc_at], b_at[doc_at]
    doc = np.repeat(np.arange(n), np.diff(a_doc))[a_link]
    a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_last[a_link[cut]], b_last[b_link[cut]] = True, True
    key, times = np.unique(doc << 31 | a[a_link].astype(np.int64) << _BITS | b[b_link], return_counts=True)
    pairs_at = np.searchsorted(key, np.arange(n + 1) << 31)
    made = _group_texts(tokens, a, b, a_last, b_last, a_doc, b_doc)
    return Aligned(
        np.diff(a_doc), np.diff(b_doc), np.bincount(doc[cut], minlength=n), np.bincount(doc, minlength=n), made,
        (key & (1 << 31) - 1).astype(np.int32), times.astype(np.int32), pairs_at,
    )


def _group_texts(tokens: Tokens, a, b, a_last, b_last, a_doc, b_doc) -> list[bytes]:
    """`a1,a2|b1;a3|b2` of each document. A token's place among both follows from the tokens of the groups before."""
    a_group, b_group = (np.cumsum(x) - x for x in (a_last, b_last))
    a_ends, b_ends = np.flatnonzero(a_last) + 1, _spans(np.diff(np.append(0, np.flatnonzero(b_last) + 1)))
    places = (np.arange(len(a)) + b_ends[a_group], np.arange(len(b)) + a_ends[b_group])
    sizes = np.zeros(len(a) + len(b), np.int64)
    sides = [(places[0], a, tokens.a_digits, np.where(a_last, ord("|"), ord(","))), (places[1], b, tokens.b_digits, np.where(b_last, ord(";"), ord(",")))]
    for place, ids, (_, width), _ in sides:
        sizes[place] = width[ids] + 1
    at = _spans(sizes)
    out = np.empty(at[-1], np.uint8)
    for place, ids, (digits, width), mark in sides:
        begin, wide = at[place], width[ids]
        for k in range(digits.shape[1]):
            more = wide > k
            out[begin[more] + k] = digits[ids[more], k]
        out[begin + wide] = mark
    ends = at[a_doc + b_doc]
    whole = out.tobytes()
    return [whole[i : j - 1] for i, j in zip(ends[:-1].tolist(), np.maximum(ends[1:], ends[:-1] + 1).tolist(), strict=True)]


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def align_documents(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each row, by one pass without a shuffle.

    a_path: a byte-level model of the tokenizers library; b_path: a sentencepiece model. Both encode a blank and the
    text, special tokens' strings as plain text. pairs: the different linked ids, a << 15 | b, ascending; times: how
    often the document links them. A text that is null, empty, or that the tokens of either don't give back has zeros,
    empty arrays and an empty digest. Words between blanks are encoded once for as long as the bounded cache holds them.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        shared = spark.sparkContext.broadcast({"files": (f.read(), g.read())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if "tokens" not in shared.value:
            shared.value["tokens"] = Tokens(*shared.value["files"])
        tokens, ids, texts, held = shared.value["tokens"], [], [], 0

        def rows() -> pa.RecordBatch:
            got = align(tokens, texts)
            if len(tokens.good) > CACHE_WORDS:
                tokens.clear()
            at = pa.array(got.pairs_at, pa.int32())
            digests = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(got.groups, got.n_a, strict=True)]
            numbers = [pa.array(getattr(got, c), pa.int64()) for c in _NUMBERS]
            lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (got.pairs, got.times)]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *numbers, pa.array(digests), *lists], names=["doc_id", *_NUMBERS, "groups_sha256", "pairs", "times"])

        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "")
                if held > 6 * GROUP_WORDS:
                    yield rows()
                    ids, texts, held = [], [], 0
        if ids:
            yield rows()

    kinds = ", ".join(["doc_id long", *(f"{c} long" for c in _NUMBERS), "groups_sha256 string, pairs array<int>, times array<int>"])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, kinds)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents link a pair, and whether no pair of the same first id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    most = F.max("n").over(W.partitionBy(F.shiftright("pair", _BITS)))  # as many rows as the second vocabulary has ids, at most
    return counts.withColumn("best", F.col("n") == most)


def score_links(aligned: DataFrame, *, frequent: int = FREQUENT) -> DataFrame:
    """aligned with n_best and count_sum instead of pairs and times: links that are a best one of their first id, and
    the sum of counts, over all links of a document.

    aligned: rows as of align_documents(), in files that stay. The counts of frequent pairs are broadcast, so that most
    links are counted where they lie; those of all others meet their counts by a join.
    """
    numbered = aligned.withColumn("_row", F.monotonically_increasing_id())
    held = materialize(numbered, "aligned")
    counts = materialize(pair_counts(held), "pairs")
    top = counts.where(above_bin(counts, "n", frequent)).select("pair", "n", "best").toArrow().sort_by("pair")
    shared = aligned.sparkSession.sparkContext.broadcast({c: top.column(c).to_numpy() for c in top.column_names})
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = (shared.value[c] for c in ("pair", "n", "best"))
        for batch in small_batches(batches):
            lists = batch.column("pairs")
            own, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            known = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], doc[known], times[known] * best[at[known]])
            np.add.at(sums[1], doc[known], times[known] * n[at[known]])
            rest = pa.array(_spans(np.bincount(doc[~known], minlength=batch.num_rows)), pa.int32())
            lists = [pa.ListArray.from_arrays(rest, pa.array(x[~known])) for x in (own, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), batch.column("_row"), *map(pa.array, sums), *lists], names=[*kept, "_row", "_best", "_sum", "_pairs", "_times"])

    kinds = dict(aligned.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "_row long, _best long, _sum long, _pairs array<int>, _times array<long>"])
    part = materialize(held.mapInArrow(run, schema), "parts")
    rest = part.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("p")).select("_row", F.col("p._pairs").alias("pair"), F.col("p._times").alias("times"))
    rest = rest.join(counts, "pair").groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_b"), F.sum(F.col("times") * F.col("n")).alias("_s"))
    whole = part.join(rest, "_row", "left")
    discard(held)
    return whole.select(*kept, (F.col("_best") + F.coalesce("_b", F.lit(0))).alias("n_best"), (F.col("_sum") + F.coalesce("_s", F.lit(0))).alias("count_sum"))
