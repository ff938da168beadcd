"""Parquet datasets in blocks of dates, and manifests beside matrices."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstep.operators.validate import assert_time_monotone, date_range
from loomstep.schema import DATE, KEYS, SYMBOL, TIME, free_names, ordered_unique, require_columns

BLOCK_DAYS = 30
#: Values (rows times columns) of a file, about: 256 MB of 4 bytes each before compression.
FILE_VALUES = 1 << 26


def with_block(df: DataFrame, first: int = 0, days: int = BLOCK_DAYS) -> DataFrame:
    """df with date_block, the number of the block of calendar days that a row is in, counted from first."""
    return df.withColumn("date_block", F.floor((F.col(DATE) - first) / F.lit(days)).cast("int"))


def write_dated(
    df: DataFrame, path: str, *, first: int = 0, days: int = BLOCK_DAYS, file_values: int = FILE_VALUES, counted: DataFrame | None = None, mode: str = "overwrite"
) -> None:
    """Writes the panel in folders of date_block, zstd, in order of time within a file and from one file to the next by name.

    A block is cut by date and time into as many files as make them file_values large, each written by a task of its
    own, and files are numbered in the order of time. counted: a table of the same keys that is cheaper to count than df.
    Rows without a date are written in the last file.
    """
    blocks = with_block(counted if counted is not None else df, first, days)
    sizes = blocks.groupBy("date_block").agg(F.count(F.lit(1)).alias("n"), F.max(TIME).alias("t")).agg(F.max("n").alias("n"), F.max("t").alias("t"), F.min("date_block").alias("low"), F.max("date_block").alias("high")).first()
    low, high, ticks = sizes["low"] or 0, sizes["high"] or 0, (sizes["t"] or 0) + 1
    slices = -(-(sizes["n"] or 1) * len(df.columns) // file_values)
    rows = with_block(df, first, days)
    tick = (F.col(DATE) - first - F.col("date_block") * days) * F.lit(ticks) + F.coalesce(F.col(TIME), F.lit(0))
    [file] = free_names(rows, "file")
    number = (F.col("date_block") - low) * slices + F.floor(tick * slices / (days * ticks))
    last = (high - low + 1) * slices
    rows = rows.withColumn(file, F.coalesce(F.least(F.greatest(number, F.lit(0)), F.lit(last - 1)), F.lit(last)).cast("int"))
    rows = rows.repartitionById(last + 1, file).drop(file).sortWithinPartitions("date_block", DATE, TIME, SYMBOL)
    rows.write.mode(mode).option("compression", "zstd").partitionBy("date_block").parquet(path)


def read_dated(spark: SparkSession, path: str, low: int | None = None, high: int | None = None, *, first: int = 0, days: int = BLOCK_DAYS) -> DataFrame:
    """Rows of dates low to high, both included; folders outside are never listed for reading."""
    rows = spark.read.parquet(path)
    if low is not None:
        rows = rows.where((F.col("date_block") >= (low - first) // days) & (F.col(DATE) >= low))
    if high is not None:
        rows = rows.where((F.col("date_block") <= (high - first) // days) & (F.col(DATE) <= high))
    return rows.drop("date_block")


def read_raw(spark: SparkSession, root: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Raw ticks below root, in folders partition_id=*: keys as int, the folder's number as partition_id."""
    rows = spark.read.parquet(root)
    require_columns(rows, ["partition_id", *KEYS])
    rows = rows.withColumns({k: F.col(k).cast("int") for k in KEYS})
    if low is not None:
        rows = rows.where(F.col(DATE) >= low)
    return rows if high is None else rows.where(F.col(DATE) <= high)


def matrix_columns(df: DataFrame, *, target: str, weight: str, chosen: list[str] | None = None, always: list[str] = ()) -> list[str]:
    """Features in order: all but keys, target and weight; or those always kept and those chosen, as far as df has them."""
    if chosen is None:
        return [c for c in df.columns if c not in {*KEYS, target, weight}]
    return [c for c in ordered_unique([*always, *chosen]) if c in df.columns]


def to_matrix(df: DataFrame, features: list[str], *, target: str, weight: str, low: int, high: int) -> DataFrame:
    """Keys, y, w and the features as float, of dates low to high exactly."""
    require_columns(df, [*KEYS, target, weight, *features])
    rows = df.where(F.col(DATE).between(low, high))
    return rows.select(*KEYS, F.col(target).cast("float").alias("y"), F.col(weight).cast("float").alias("w"), *(F.col(c).cast("float").alias(c) for c in features))


def size_gb(n_rows: int, n_features: int) -> float:
    """Of a matrix of 4-byte numbers with target, weight and date."""
    return n_rows * (n_features + 3) * 4 / 1e9


def footer_range(spark: SparkSession, path: str) -> DataFrame:
    """(min_date, max_date, n_rows) of Parquet files from the statistics in their footers; no row is read.

    The aggregate is pushed to the source, which Spark offers for its newer reader only, so this runs in a session of
    its own and the caller's options stay as they are. Keys whose files lack statistics are an error of the source.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return date_range(own.read.parquet(path))


def write_matrix(matrix: DataFrame, path: str) -> dict:
    """Writes the matrix in global time-major order by ranges of keys, and a manifest; returns the manifest.

    The files are read again: an order of time that is broken within one or from one to the next is an AssertionError.
    """
    matrix.repartitionByRange(DATE, TIME, SYMBOL).sortWithinPartitions(DATE, TIME, SYMBOL).write.mode("overwrite").option("compression", "zstd").parquet(path)
    spark = matrix.sparkSession
    assert_time_monotone(spark, path)
    r = footer_range(spark, path).first()
    features = [c for c in matrix.columns if c not in {*KEYS, "y", "w"}]
    meta = {"n_rows": r["n_rows"], "n_feat": len(features), "dtype": "float32", "features": features, "dates": [r["min_date"], r["max_date"]], "size_gb": size_gb(r["n_rows"], len(features))}
    write_summary(spark, meta, f"{path}.manifest")
    return meta


def read_matrix(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    return read_summary(spark, f"{path}.manifest"), spark.read.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small table as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_names(spark: SparkSession, path: str) -> list[str]:
    """A list of names, one a line; blank lines are dropped."""
    return [r["value"].strip() for r in spark.read.text(path).collect() if r["value"].strip()]


def write_summary(spark: SparkSession, values: dict, path: str) -> None:
    """One JSON object in one line."""
    spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_summary(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def run_tag(low: int, high: int, n_splits: int, gap: int, ratio: int, seed: int, extra: str = "") -> str:
    """The name of a run by its dates, folds and seed."""
    return f"{low}-{high}__cv{n_splits}-g{gap}-r{ratio}__seed{seed}" + (f"__{extra}" if extra else "")


def write_names(spark: SparkSession, names: list[str], path: str) -> None:
    spark.createDataFrame([(n,) for n in names], "value string").coalesce(1).write.mode("overwrite").text(path)
