"""Parquet tables packed by size, with a manifest of what lies where."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestfold.operators.flatten import q

#: Folder of the manifest below a table; readers of the table skip it.
MANIFEST = "_manifest"
FILE_BYTES = 128 << 20


def write_packed(df: DataFrame, path: str, key: str, n_bytes: int, file_bytes: int = FILE_BYTES, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` so that rows of one ``key`` (a source file, a bundle) lie
    side by side, many keys to a file, and return the manifest: ``key``,
    ``file``, ``first_row`` and ``n_rows``.

    The number of files follows ``n_bytes``, the size of the data, not the
    number of keys. Rows are dealt by ranges of (key, place in the input), so
    a key with a third of the rows is spread over a third of the files, in as
    many ranges. Rows without a key come first. With ``mode="append"`` the
    manifest is made again for the whole table."""
    spark, place = df.sparkSession, "_place_in_input"
    n = max(1, math.ceil(n_bytes / file_bytes))
    rows = df.withColumn(place, F.monotonically_increasing_id())
    rows.repartitionByRange(n, q(key), q(place)).sortWithinPartitions(q(key), q(place)).drop(place).write.mode(mode).parquet(path)
    where = F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    ranges = spark.read.parquet(path).select(q(key), *where).groupBy(key, "file").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n_rows"))
    ranges.repartitionByRange(q(key)).sortWithinPartitions(q(key), "file").write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_key(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """The rows of one key: only the files that the manifest names are opened,
    and in them, as they are sorted, only the row groups that may hold it."""
    same = q(key).isNull() if value is None else q(key) == F.lit(value)
    files = [r["file"] for r in read_manifest(spark, path).where(same).select("file").collect()]  # one key's files
    table = spark.read.parquet(path)
    return (spark.read.schema(table.schema).parquet(*[f"{path}/{f}" for f in files]) if files else table).where(same)
