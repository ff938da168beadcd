"""What the operators of this subpackage share: tables, shared folders, batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstep.sources.scratch import delete, shared_dir

#: White space of the contracts: blank and the control characters tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of texts that a Python worker takes at once.
BATCH_ROWS = 128
#: Words a worker keeps in one of its caches before it starts again.
CACHE_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_folder: ContextVar[str] = ContextVar("folder", default="loomstep")


def materialize(df: DataFrame, name: str = "part", *, compression: str = "snappy") -> DataFrame:
    """Writes the rows to the shared folder and reads them back: lineage ends here and any executor can be lost.

    compression: zstd for tables that hold texts, where it takes a quarter off.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_folder.get()}/{name}-{uuid.uuid4().hex}"
    with few_rows(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes the files behind frames from materialize(), once nothing reads them any more."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            delete(df.sparkSession, file.rsplit("/", 1)[0])


@contextmanager
def own_folder(spark: SparkSession) -> Iterator[None]:
    """What materialize() writes meanwhile goes to a folder of its own, which is deleted in the end."""
    folder = f"loomstep/{uuid.uuid4().hex}"
    before = _folder.set(folder)
    try:
        yield
    finally:
        _folder.reset(before)
        delete(spark, f"{shared_dir(spark)}/{folder}")


@contextmanager
def kept_folder() -> Iterator[None]:
    """Inside own_folder(): what is written meanwhile stays."""
    before = _folder.set("loomstep")
    try:
        yield
    finally:
        _folder.reset(before)


@contextmanager
def few_rows(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile sends Python workers batches of BATCH_ROWS rows; the session's option is put back in the end."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(batches):
    """The same rows in batches of BATCH_ROWS at most; Spark bounds the bytes of those that it sends."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("long")


def let(value: Column, use) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op) -> Column:
    """The array's running op from the left, op being associative, by steps of doubled length: n log n for n values."""

    def step(done: Column, k: Column) -> Column:
        d = F.pow(F.lit(2), k).cast("int")
        return F.transform(done, lambda v, i: F.when(i >= d, op(F.get(done, i - d), v)).otherwise(v))

    def scan(x: Column) -> Column:
        steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(x))).cast("int") - 1)
        return F.when(F.size(x) < 2, x).otherwise(F.aggregate(steps, x, step))

    return let(values, scan)


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def cut_out(text: Column, spans: Column, few: int = 16) -> Column:
    """Array of the parts of a text at spans (start, length).

    A part is found by counting characters from the text's start; of more than a few, by an array of them all,
    so the cost stays linear in the text.
    """
    each = F.transform(spans, lambda s: F.substring(text, s["start"] + 1, s["length"]))
    whole = let(characters(text), lambda chars: F.transform(spans, lambda s: F.array_join(F.slice(chars, s["start"] + 1, s["length"]), "")))
    return F.when(F.size(spans) <= few, each).otherwise(whole)


def above_bin(counts: DataFrame, n: str, most: int) -> Column:
    """A condition that holds for the rows of the largest n, as many as possible but no more than most.

    Rows are counted by the logarithm of n in eighths, so the driver gets some 500 numbers at most, whatever the rows.
    """
    bin_of = F.floor(F.log2(F.col(n)) * 8).cast("int")
    least, held = None, 0
    for r in counts.groupBy(bin_of.alias("bin")).count().orderBy(F.desc("bin")).collect():
        held += r["count"]
        if held > most:
            break
        least = r["bin"]
    return F.lit(False) if least is None else bin_of >= least


def raw_texts(column) -> list[bytes]:
    """The UTF-8 bytes of a string column of an Arrow batch; null is empty."""
    return [b"" if t is None else t for t in column.cast("binary").to_pylist()]


class WordIds(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0
