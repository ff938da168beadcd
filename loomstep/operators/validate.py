"""Checks of written shards: order of rows within and across files, and range of dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomstep.schema import DATE, TIME

#: Rows of a file that one task compares.
STRETCH = 1_000_000


def order_breaks(df: DataFrame, file: str = "file", row: str = "row", date: str = DATE, time: str = TIME, *, stretch: int = STRETCH) -> DataFrame:
    """(n_rows, date_breaks, time_breaks, file_breaks): how often the order of time is broken, in one row.

    Rows whose date is below that of the row before in the file; of equal dates, whose time is; and files that begin
    before the end of the file before, in the order of file. row: places in the file, without gaps. Files are cut into stretches of rows, each with the row
    before it, so a large file is many tasks; of each file only its first and last key are gathered.
    """
    key = F.struct(F.col(date).alias("d"), F.col(time).alias("t"))
    of = lambda r: F.floor(r / F.lit(stretch))
    own = F.floor(F.col("row") / F.lit(stretch)) == F.col("stretch")
    rows = df.select(F.col(file).alias("file"), F.col(row).alias("row"), key.alias("key"), F.explode(F.sequence(of(F.col(row)), of(F.col(row) + 1))).alias("stretch"))
    before = F.lag("key").over(Window.partitionBy("file", "stretch").orderBy("row"))
    rows = rows.select("file", "row", "key", own.alias("own"), before.alias("before")).where("own")
    down, earlier = F.col("key.d") < F.col("before.d"), (F.col("key.d") == F.col("before.d")) & (F.col("key.t") < F.col("before.t"))
    files = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(down).alias("d"), F.count_if(earlier).alias("t"),
        F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last"),
    )
    ends = F.sort_array(F.collect_list(F.struct("file", "first", "last")))
    whole = files.agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.sum("t").alias("t"), ends.alias("ends"))
    late = F.transform("ends", lambda e, i: (i > 0) & (e["first"] < F.get("ends", i - 1)["last"]))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return whole.select(zero("n").alias("n_rows"), zero("d").alias("date_breaks"), zero("t").alias("time_breaks"), F.size(F.filter(late, lambda x: x)).cast("long").alias("file_breaks"))


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of Parquet files with file and row, their place in it: a DataFrame itself has no order."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def assert_time_monotone(spark: SparkSession, path: str, *, across: bool = True) -> None:
    """The files below path are in order of time within and (across) from one to the next, in the order of their names."""
    r = order_breaks(read_in_order(spark, path)).first()
    if r["date_breaks"] or r["time_breaks"] or across and r["file_breaks"]:
        raise AssertionError(f"{path}: {r['date_breaks']} dates, {r['time_breaks']} times and {r['file_breaks']} files go back")


def assert_panel_shard(spark: SparkSession, path: str, low: int, high: int) -> None:
    """assert_time_monotone(), and the dates reach from low to high."""
    assert_time_monotone(spark, path)
    r = date_range(spark.read.parquet(path)).first()
    if (r["min_date"], r["max_date"]) != (low, high):
        raise AssertionError(f"{path}: dates {r['min_date']} to {r['max_date']}, not {low} to {high}")


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min(DATE).alias("min_date"), F.max(DATE).alias("max_date"), F.count(F.lit(1)).alias("n_rows"))
