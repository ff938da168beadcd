"""Language-model scores by classes of words: exchange clustering, class transitions and emissions of words.

Every word has a type: the most frequent words are types of their own, the others share types by their endings, as
do words that training never met. Exchange assigns types, and so all words, to classes. A text's probability is that
of its words and an end in a row: P(class | class before) * P(word | class).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import CACHE_WORDS, above_bin, discard, materialize, raw_texts, small_batches

#: The end of a text, which also stands before its first word; no word is empty.
END = b""
#: Words, at most, whose counts every worker holds, and bytes of such a word: 16 MB at most.
FREQUENT, SHORT = 1 << 18, 64
#: Words, at most, that are types of their own, and types of endings.
OWN_TYPES, ENDINGS = 1 << 14, 1 << 12
CLASSES = 64
ROUNDS = 4
#: Parts of the types that are exchanged at once, each against the others' classes of the round before.
PARTS = 8
#: Tokens whose pairs a worker counts at once.
GROUP_TOKENS = 2_000_000


def held_out(doc_id: Column, fold: int = 2, folds: int = 7) -> Column:
    """Whether a document is kept out of training, by the CRC-32 of its id; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def tokens_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered, and the end."""
    words = text.lower().split()
    words.append(END)
    return words


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of all tokens of all texts; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return found

        for batch in small_batches(batches):
            for text in raw_texts(batch.column(0)):
                counts.update(tokens_of(text))
            if len(counts) > CACHE_WORDS:
                yield rows()
        if counts:
            yield rows()

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Types(dict):
    """The type of each word: its place among the frequent ones, or one of ENDINGS behind them by its last letters.

    What words outside of the frequent ones have is kept until there are too many of them.
    """

    def __init__(self, frequent: Iterable[bytes], own: int):
        self.frequent, self.own = list(frequent), own
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.update((w, i if i < self.own else self.ending(w)) for i, w in enumerate(self.frequent))

    def ending(self, word: bytes) -> int:
        return self.own + zlib.crc32(word[-3:]) % ENDINGS

    def __missing__(self, word: bytes) -> int:
        self[word] = found = self.ending(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > len(self.frequent) + CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _types(state: dict) -> Types:
    """A worker's own table, made once."""
    if "types" not in state:
        state["types"] = Types(state["frequent"], state["own"])
    return state["types"]


def count_pairs(docs: DataFrame, shared, n_types: int, text_col: str = "text") -> DataFrame:
    """(a, b, n): how often type b comes after type a in all texts; an end comes before each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, held, size = _types(shared.value), [], 0

        def rows() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array((key // n_types).astype(np.int32)), pa.array((key % n_types).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

        for batch in small_batches(batches):
            texts = raw_texts(batch.column(0))
            if not texts:
                continue
            ids = types.of(list(chain([END], *map(tokens_of, texts))))  # a text begins behind the end of the one before
            held.append(ids[:-1] * n_types + ids[1:])
            size += len(ids)
            if size > GROUP_TOKENS:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    return docs.select(text_col).mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of the training text under its classes, but for a part that no exchange changes."""
    return float(_xlogx(table).sum() - 2 * _xlogx(table.sum(axis=1)).sum())


def exchange(vectors: Iterable[tuple[int, int, np.ndarray, np.ndarray, float]], table: np.ndarray) -> Iterator[tuple[int, int]]:
    """(type, best class) of each type in turn: the one that gives the most likelihood with all others where they are.

    vectors: type, class, counts of each class before it and after it, and how often it comes after itself.
    table: counts of each class after each; every move changes it for the types that come later.
    """
    table = table.astype(float)
    total = table.sum(axis=1)
    for kind, own, left, right, self_n in vectors:
        n = right.sum() + self_n
        table[:, own] -= left
        table[own, :] -= right
        table[own, own] -= self_n
        total[own] -= n
        rows, columns = np.flatnonzero(left), np.flatnonzero(right)
        gain = (_xlogx(table[rows] + left[rows, None]) - _xlogx(table[rows])).sum(axis=0)
        gain += (_xlogx(table[:, columns] + right[columns]) - _xlogx(table[:, columns])).sum(axis=1)
        # Within the class itself, what comes before and after add to one count.
        both = np.diagonal(table)
        apart = _xlogx(both + left) + _xlogx(both + right) - 2 * _xlogx(both)
        gain += _xlogx(both + left + right + self_n) - _xlogx(both) - apart
        gain -= 2 * (_xlogx(total + n) - _xlogx(total))
        best = int(np.argmax(gain))
        if gain[best] <= gain[own] + 1e-9:
            best = own
        table[:, best] += left
        table[best, :] += right
        table[best, best] += self_n
        total[best] += n
        yield kind, best


def _class_vectors(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(type, class, near): near has (class, before, after) counts; class -1 has how often the type follows itself."""
    of = lambda end, name: F.broadcast(classes.select(F.col("type").alias(end), F.col("class").alias(name)))  # noqa: E731  a row for each type
    apart = pairs.where("a != b")
    after = apart.join(of("b", "near"), "b").groupBy(F.col("a").alias("type"), "near").agg(F.lit(0).cast("long").alias("before"), F.sum("n").alias("after"))
    before = apart.join(of("a", "near"), "a").groupBy(F.col("b").alias("type"), "near").agg(F.sum("n").alias("before"), F.lit(0).cast("long").alias("after"))
    itself = pairs.where("a = b").select(F.col("a").alias("type"), F.lit(-1).alias("near"), F.col("n").alias("before"), F.col("n").alias("after"))
    # Three rows at most for each type and class.
    rows = before.unionByName(after).unionByName(itself).groupBy("type").agg(F.collect_list(F.struct("near", "before", "after")).alias("near"))
    return rows.join(of("type", "class"), "type")


def _unpacked(batch: pa.RecordBatch, n_classes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, float]]:
    near = batch.column("near")
    at, flat = near.offsets.to_numpy(), near.flatten()
    which, before, after = (flat.field(i).to_numpy() for i in range(3))
    at = at - at[0]
    for i, (kind, own) in enumerate(zip(batch.column("type").to_pylist(), batch.column("class").to_pylist(), strict=True)):
        w, b, a = (x[at[i] : at[i + 1]] for x in (which, before, after))
        left, right = np.zeros(n_classes + 1), np.zeros(n_classes + 1)
        np.add.at(left, w, b)
        np.add.at(right, w, a)
        yield kind, own, left[:-1], right[:-1], float(right[-1])


def _class_table(vectors: DataFrame, n_classes: int) -> np.ndarray:
    """Counts of each class after each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((n_classes, n_classes), np.int64)
        for batch in batches:
            for _, own, _, right, self_n in _unpacked(batch, n_classes):
                table[own] += right.astype(np.int64)
                table[own, own] += int(self_n)
        a, b = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(table[a, b])], names=["a", "b", "n"])

    table = np.zeros((n_classes, n_classes), np.int64)
    for r in vectors.select("type", "class", "near").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        table[r["a"], r["b"]] = r["n"]
    return table


def cluster(pairs: DataFrame, n_types: int, *, n_classes: int = CLASSES, rounds: int = ROUNDS, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each type, counts of each class after each) by rounds of exchange over all pairs.

    A round deals the types out to parts; each part exchanges its types one after the other, the most common first,
    and sees the others in the classes of the round before. A round that lowers the likelihood is the last one and does not
    count. The driver gets a class for each type and a table of classes, whatever the corpus.
    """
    spark = pairs.sparkSession
    classes = np.arange(n_types) % n_classes
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for turn in range(rounds + 1):
        frame = spark.createDataFrame(pa.table({"type": pa.array(np.arange(n_types), pa.int32()), "class": pa.array(classes, pa.int32())}))
        vectors = materialize(_class_vectors(pairs, frame), "vectors")
        table = _class_table(vectors, n_classes)
        now = likelihood(table)
        if best is None or now > best[0]:
            best = now, classes, table
        elif turn:
            discard(vectors)
            break
        if turn < rounds:
            shared = spark.sparkContext.broadcast(table)

            def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                own = chain.from_iterable(_unpacked(b, n_classes) for b in batches)
                found = list(exchange(own, shared.value))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([c for _, c in found], pa.int32())], names=["type", "class"])

            dealt = vectors.repartition(parts, F.pmod(F.xxhash64("type"), F.lit(parts))).sortWithinPartitions("type")
            moved = dealt.select("type", "class", "near").mapInArrow(run, "type int, class int").toArrow()
            classes = classes.copy()
            classes[moved.column("type").to_numpy()] = moved.column("class").to_numpy()
        discard(vectors)
    return best[1], best[2]


@dataclass
class ClassModel:
    """What scoring needs; all but vocabulary, a table of (word, n), is of bounded size.

    singles: by class, how many words came once. A class's unknown words are one word that counts as often, and once more.
    """

    vocabulary: DataFrame
    frequent: list[bytes]
    counts: np.ndarray
    own: int
    n_tokens: int
    n_words: int
    classes: np.ndarray
    table: np.ndarray
    singles: np.ndarray

    def log_transitions(self) -> np.ndarray:
        """log10 of P(class | class before): counts, and a class's share of all tokens as often as there are classes."""
        k = len(self.table)
        total = self.table.sum(axis=0)
        share = (total + 1) / (total.sum() + k)
        return np.log10((self.table + k * share) / (self.table.sum(axis=1, keepdims=True) + k))

    def class_sizes(self) -> np.ndarray:
        """By class, what the counts of its words and of its unknown word add up to."""
        return self.table.sum(axis=0) + self.singles + 1


def fit(docs: DataFrame, *, text_col: str = "text", n_classes: int = CLASSES, rounds: int = ROUNDS, own_types: int = OWN_TYPES, frequent: int = FREQUENT) -> ClassModel:
    """A model of all docs. Words and pairs of types are counted over whole texts; their number may grow without bound,
    what the driver and the workers hold (frequent words, types, classes) may not. Null and empty texts are an end
    alone; no rows give a model by which every token is unknown.
    """
    spark = docs.sparkSession
    vocabulary = materialize(count_words(docs, text_col), "vocabulary")
    sums = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    common = vocabulary.where(above_bin(vocabulary, "n", frequent) & (F.octet_length("word") <= SHORT)).toArrow()
    words, counts = [w.encode() for w in common.column("word").to_pylist()], common.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    words, counts = [words[i] for i in order], counts[order]
    own = min(own_types, len(words))
    shared = spark.sparkContext.broadcast({"frequent": words, "own": own})
    n_types = own + ENDINGS
    pairs = materialize(count_pairs(docs, shared, n_types, text_col), "pairs")
    classes, table = cluster(pairs, n_types, n_classes=n_classes, rounds=rounds)
    discard(pairs)
    singles = _singles(vocabulary, shared, classes, n_classes)
    return ClassModel(vocabulary, words, counts, own, sums["n"] or 0, sums["v"], classes, table, singles)


def _singles(vocabulary: DataFrame, shared, classes: np.ndarray, n_classes: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, total = _types(shared.value), np.zeros(n_classes, np.int64)
        for batch in batches:
            total += np.bincount(classes[types.of(raw_texts(batch.column(0)))], minlength=n_classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_classes)), pa.array(total)], names=["class", "n"])

    total = np.zeros(n_classes, np.int64)
    for r in vocabulary.where("n = 1").select("word").mapInArrow(run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        total[r["class"]] = r["n"]
    return total


_ROW = "_row long, n_tokens long, known long, base double, score double, words array<string>, times array<long>, kinds array<int>"


def score(docs: DataFrame, model: ClassModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each row's whole text, log10 probabilities.

    base_score is that of the words' own shares, one added to each count and one word for all unknown ones. Frequent
    words are looked up where the text is read; the others, whose number has no bound, meet their counts by a join of
    (row, word, times). Texts are not shuffled. Null and empty texts are an end alone, repeated rows repeat, an
    empty table gives no rows, other columns are not read.
    """
    spark = docs.sparkSession
    sizes, transitions = model.class_sizes(), model.log_transitions()
    shared = spark.sparkContext.broadcast({
        "frequent": model.frequent, "own": model.own, "classes": model.classes, "transitions": transitions, "sizes": np.log10(sizes),
        "counts": model.counts, "all": float(np.log10(model.n_tokens + model.n_words + 1)),
    })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        types = _types(state)
        if "places" not in state:
            counts = np.append(state["counts"], 0)  # the last place is that of all other words
            state |= {"places": {w: i for i, w in enumerate(state["frequent"])}, "logs": (np.log10(counts + 1), np.log10(np.maximum(counts, 1)))}
        places, (base_logs, own_logs), rest = state["places"], state["logs"], len(state["frequent"])
        for batch in small_batches(batches):
            texts = list(map(tokens_of, raw_texts(batch.column(1))))
            n = np.fromiter(map(len, texts), np.int64, len(texts))
            words = list(chain.from_iterable(texts))
            place = np.fromiter((places.get(w, rest) for w in words), np.int64, len(words))
            cls = state["classes"][types.of(words)]
            before = np.append(0, cls[:-1])  # the first token of each text comes after an end, as the end of the one before is
            starts = np.cumsum(n) - n
            if len(n):
                before[0] = state["classes"][types.of([END])[0]]
            logs = state["transitions"][before, cls] - state["sizes"][cls] + own_logs[place]
            doc = np.repeat(np.arange(len(n)), n)
            sums = [np.bincount(doc, x, len(n)) for x in (base_logs[place] - state["all"], logs)]
            known = np.bincount(doc, place < rest, len(n)).astype(np.int64)
            others = np.flatnonzero(place == rest)
            found = [Counter() for _ in n]
            for d, i in zip(doc[others].tolist(), others.tolist(), strict=True):
                found[d][words[i]] += 1
            flat = list(chain.from_iterable(found))
            at = pa.array(np.append(0, np.cumsum(list(map(len, found)))), pa.int32())
            kinds = state["classes"][types.of(flat)].astype(np.int32)
            lists = [pa.array(flat, pa.binary()).cast(pa.string()), pa.array(list(chain.from_iterable(c.values() for c in found)), pa.int64()), pa.array(kinds)]
            arrays = [batch.column(0), batch.column(2), pa.array(n), pa.array(known), *map(pa.array, sums), *(pa.ListArray.from_arrays(at, x) for x in lists)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "_row", "n_tokens", "known", "base", "score", "words", "times", "kinds"])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col), F.monotonically_increasing_id())
    part = materialize(rows.mapInArrow(run, "doc_id long, " + _ROW), "parts")
    rest = part.select("_row", F.explode(F.arrays_zip("words", "times", "kinds")).alias("w")).select("_row", "w.*").withColumnRenamed("words", "word")
    unknown = F.element_at(F.array(*(F.lit(float(x)) for x in np.log10(model.singles + 1))), F.col("kinds") + 1)
    times = F.col("times")
    more = rest.join(model.vocabulary, "word", "left").groupBy("_row").agg(
        F.sum(F.when(F.col("n").isNotNull(), times).otherwise(0)).alias("k"),
        F.sum(times * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("b"),
        F.sum(times * F.coalesce(F.log10("n"), unknown)).alias("s"),
    )
    whole = part.join(more, "_row", "left")
    add = lambda c, d: F.col(c) + F.coalesce(d, F.lit(0))
    return whole.select("doc_id", "n_tokens", add("known", "k").alias("n_known"), add("base", "b").alias("base_score"), add("score", "s").alias("score"))
