"""The matrix as dense blocks of float32 rows, numbered in the order of keys, and as files for memory maps."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomstep.operators.validate import read_in_order
from loomstep.schema import DATE
from loomstep.sources.dated import read_summary, write_summary

#: Files of an export, what they hold and of which type.
PARTS = {"X": "float32", "y": "float32", "w": "float32", "date": "int32"}


def numbered_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a matrix that write_matrix() left below path, with their places in the whole, from 0.

    Files are in the order of their names and rows in theirs, so a place is the number of rows in the files before,
    one number a file, and the row's own in its file. No row is moved.
    """
    rows = read_in_order(spark, path)
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    first = files.select("file", F.coalesce(before, F.lit(0)).alias("first"))
    return rows.join(F.broadcast(first), "file").withColumn("place", F.col("first") + F.col("row")).drop("file", "row", "first")


def write_dense(spark: SparkSession, matrix: str, path: str) -> dict:
    """Writes the matrix below matrix as blocks to path, and a manifest; returns the manifest.

    A block is a stretch of rows that a task has read in a row: its first place, how many, and the bytes of X (row by
    row), y, w and date. Tasks write what they read, so nothing is shuffled and the driver sees no row. Nulls are NaN.
    """
    meta = read_summary(spark, f"{matrix}.manifest")
    features = meta["features"]
    rows = numbered_rows(spark, matrix).select("place", DATE, "y", "w", *(f"`{c}`" for c in features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(place) != 1) + 1, len(place)).tolist()
            x = np.empty((len(place), len(features)), np.float32)
            for i in range(len(features)):
                x[:, i] = batch.column(4 + i).to_numpy(zero_copy_only=False)
            parts = {"X": x, **{c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float32) for c in ("y", "w")}, "date": batch.column(DATE).to_numpy(zero_copy_only=False).astype(np.int32)}
            low, found = 0, []
            for high in cuts:
                if high > low:
                    found.append({"first": int(place[low]), "n": high - low} | {c: parts[c][low:high].tobytes() for c in PARTS})
                low = high
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=kinds)

    kinds = pa.schema([("first", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in PARTS)])
    blocks = rows.mapInArrow(run, "first long, n long, " + ", ".join(f"{c} binary" for c in PARTS))
    blocks.write.mode("overwrite").option("compression", "zstd").parquet(path)
    write_summary(spark, meta | {"layout": PARTS}, f"{path}.manifest")
    return meta | {"layout": PARTS}


def _blocks(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    return spark.read.parquet(path).where((F.col("first") < high) & (F.col("first") + F.col("n") > low))


def dense_rows(spark: SparkSession, path: str, low: int, high: int) -> dict[str, np.ndarray]:
    """The arrays X, y, w and date of places low up to but without high, which the driver must be able to hold."""
    width = read_summary(spark, f"{path}.manifest")["n_feat"]
    found = {c: [] for c in PARTS}
    for r in _blocks(spark, path, low, high).orderBy("first").toLocalIterator():
        own = slice(max(low - r["first"], 0), min(high - r["first"], r["n"]))
        for c, kind in PARTS.items():
            whole = np.frombuffer(r[c], kind)
            found[c].append((whole.reshape(-1, width) if c == "X" else whole)[own])
    empty = {c: np.zeros((0, width) if c == "X" else 0, kind) for c, kind in PARTS.items()}
    return {c: np.concatenate([empty[c], *found[c]]) for c in PARTS}


def unpacked(spark: SparkSession, path: str) -> DataFrame:
    """(place, date_id, y, w, features) of dense blocks, NaN as null."""
    features = read_summary(spark, f"{path}.manifest")["features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x = np.frombuffer(r["X"], np.float32).reshape(r["n"], len(features))
                arrays = [np.arange(r["first"], r["first"] + r["n"]), np.frombuffer(r["date"], np.int32), *(np.frombuffer(r[c], np.float32) for c in ("y", "w")), *x.T]
                yield pa.RecordBatch.from_arrays([pa.array(a, from_pandas=True) for a in arrays], names=["place", DATE, "y", "w", *features])

    schema = f"place long, {DATE} int, y float, w float, " + ", ".join(f"`{c}` float" for c in features)
    return spark.read.parquet(path).mapInArrow(run, schema)


def export_maps(spark: SparkSession, path: str, folder: str) -> dict[str, str]:
    """Files X.bin, y.bin, w.bin and date.bin in a folder that the driver and all executors share; returns their paths.

    Each block goes to its place in files of full size, from the task that reads it; a task that runs again writes the
    same bytes, so lost executors do no harm. The files are what numpy.memmap opens with the manifest's sizes.
    """
    meta = read_summary(spark, f"{path}.manifest")
    n, width = meta["n_rows"], meta["n_feat"]
    sizes = {c: 4 * (width if c == "X" else 1) for c in PARTS}
    files = {c: os.path.join(folder, f"{c}.bin") for c in PARTS}
    os.makedirs(folder, exist_ok=True)
    for c, file in files.items():
        with open(file, "wb") as f:
            f.truncate(n * sizes[c])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            for r in batch.to_pylist():
                for c, file in files.items():
                    with open(file, "r+b") as f:
                        f.seek(r["first"] * sizes[c])
                        f.write(r[c])
                written += r["n"]
        yield pa.RecordBatch.from_arrays([pa.array([written])], names=["n"])

    done = spark.read.parquet(path).mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
    if done != n:
        raise AssertionError(f"{path}: {done} rows, not {n}")
    return files
