"""Counts taken while the data is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(df: DataFrame, path: str, good: Column, counts: dict[str, Column] | None = None, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame, dict]:
    """Write the good rows of ``df`` and those it rejects in one pass, counting
    on the way: ``(good rows, rejected rows, counts)`` as written.

    ``counts`` names aggregates over all rows; ``n_rows``, ``n_good`` and
    ``n_rejected`` are always there. They are observed by the write itself, so
    nothing is read or parsed a second time to count it. A condition that is
    null rejects its row."""
    spark, mark = df.sparkSession, "_good"
    seen = Observation()
    marked = df.withColumn(mark, F.coalesce(good, F.lit(False)))
    n = {"n_rows": F.count(F.lit(1)), "n_good": F.count_if(mark), "n_rejected": F.count_if(~F.col(mark)), **(counts or {})}
    watched = marked.observe(seen, *[c.alias(k) for k, c in n.items()])
    watched.write.mode(mode).partitionBy(mark).parquet(path)
    back = spark.read.schema(marked.schema).parquet(path)
    return back.where(F.col(mark)).drop(mark), back.where(~F.col(mark)).drop(mark), dict(seen.get)
