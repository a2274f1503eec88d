"""A history of ids already loaded, the ids still to load, and
first-occurrence dedupe. Whole loads are in ``increments``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestfold.operators.flatten import q
from nestfold.session import path_exists, remove


def read_history(spark: SparkSession, path: str | None, key: str, key_type: str = "bigint") -> DataFrame:
    """The id history at ``path``, or an empty one on the first run."""
    if path is None:
        return spark.createDataFrame([], f"`{key}` {key_type}")
    return spark.read.parquet(path).select(q(key))


def update_history(history: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Union-distinct of the ids in ``history`` and ``new`` (one shuffle on the
    id; duplicates are removed map-side first)."""
    return history.select(q(key)).unionByName(new.select(q(key))).dropDuplicates([key])


def write_history(df: DataFrame, root: str, version: int, compression: str = "snappy") -> str:
    """Write a new history version to ``<root>/v=<version>``; a version is
    never overwritten while it may be read, readers switch by version. What a
    write that broke off left there (no ``_SUCCESS``) is removed first."""
    path = f"{root.rstrip('/')}/v={version:08d}"
    spark = df.sparkSession
    if path_exists(spark, path) and not path_exists(spark, f"{path}/_SUCCESS"):
        remove(spark, path)
    df.write.mode("errorifexists").option("compression", compression).parquet(path)
    return path


def new_ids(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose id is not in the history (left anti join; the
    planner broadcasts the history only when its measured size is small)."""
    return df.join(history.select(q(key)).dropDuplicates([key]), on=key, how="left_anti")


def dedupe_first(df: DataFrame, keys, seq: str, columns=None, digest: bool = True) -> DataFrame:
    """First row per key in ``seq`` order. With ``digest`` the rows are grouped
    on the SHA-256 of the key columns, so long keys (whole texts) are not
    shuffled; ``min_by`` aggregates partially, so a key held by a third of the
    rows is combined map-side."""
    keys = list(keys)
    columns = [c for c in (columns or df.columns)]
    if digest:
        k = F.sha2(F.to_json(F.struct(*[q(c) for c in keys])), 256) if len(keys) > 1 else F.sha2(
            q(keys[0]).cast("string"), 256
        )
        group = [k.alias("_key")]
    else:
        group = [q(c) for c in keys]
    row = F.struct(*[q(c) for c in columns])
    return df.groupBy(*group).agg(F.min_by(row, q(seq)).alias("_r")).select("_r.*")
