"""Parts of a panel in buckets of their keys, so that parts of the same rows are joined where they lie."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomstep.schema import DATE, KEYS, SYMBOL, TIME
from loomstep.sources.dated import FILE_VALUES

#: Rows of a bucket, about: joining a bucket's parts is one task, however narrow they are.
BUCKET_ROWS = 1 << 17


def buckets_of(n_rows: int, n_columns: int, file_values: int = FILE_VALUES, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets by which the widest part has files of about so many values and rows at most. All parts that are to be joined take the same number."""
    return max(1, -(-n_rows * n_columns // file_values), -(-n_rows // bucket_rows))


def write_bucketed(df: DataFrame, path: str, buckets: int) -> DataFrame:
    """Writes df below path in one file for each bucket of the keys, in the order of time within a file, and reads it back.

    A bucket is dealt to one task, so there is one exchange. The frame that comes back knows its buckets: joins by all
    keys with another of as many buckets need none.
    """
    rows = df.repartition(buckets, *KEYS).sortWithinPartitions(DATE, TIME, SYMBOL)
    name = f"loomstep_{uuid.uuid4().hex}"
    rows.write.mode("overwrite").option("compression", "zstd").option("path", path).bucketBy(buckets, *KEYS).sortBy(DATE, TIME, SYMBOL).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """What write_bucketed() left below path, from any session: the files don't say how they are dealt."""
    name = f"loomstep_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({DATE}, {TIME}, {SYMBOL}) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(name)
