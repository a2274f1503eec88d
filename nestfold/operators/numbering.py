"""Distributed row numbers and paging in a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestfold.operators.flatten import q
from nestfold.session import scratch_path


def _named(order) -> list[Column]:
    return [q(c) if isinstance(c, str) else c for c in order]


def numbered(df: DataFrame, order, name: str = "row_number") -> DataFrame:
    """``df`` with each row's number, from 1, in ``order`` (columns that
    together are unique give the same numbers each time).

    Rows are sorted by range, one task a range, and numbered in their task; a
    range's first number is the sum of the counts of the ranges before it. The
    driver sees one count per range. No window over all rows is used: that
    would be one task. Values that tie in ``order`` share a range, so a key
    that may be frequent needs further columns behind it."""
    spark, place = df.sparkSession, "_place_of_row"
    path = scratch_path(spark, "numbered")
    columns = _named(order)
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.shiftright(F.col(place), 33)
    counts = sorted(tuple(r) for r in rows.groupBy(part.cast("int")).count().collect())
    first, before = [0] * (counts[-1][0] + 1 if counts else 1), 0
    for p, n in counts:
        first[p] = before
        before += n
    offset = F.element_at(F.lit(first).cast("array<bigint>"), part.cast("int") + 1)
    return rows.withColumn(name, offset + F.col(place).bitwiseAND((1 << 33) - 1) + 1).drop(place)


def paged(df: DataFrame, order, page_size: int, page: str = "page", number: str = "row_number", total: str = "n_total") -> DataFrame:
    """``df`` with its pages of ``page_size`` rows in ``order``: each row's
    ``number``, ``page`` (both from 1) and the ``total`` of rows."""
    rows = numbered(df, order, number)
    n = rows.count()  # from the footers
    return rows.withColumn(page, F.floor((q(number) - 1) / page_size).cast("bigint") + 1).withColumn(total, F.lit(n).cast("bigint"))


def next_page(df: DataFrame, key: str, page_size: int, after=None) -> tuple[DataFrame, object]:
    """One page of ``df`` by a unique ``key``, and the token with which the next
    call goes on (None behind the last page). The token is the page's last
    key, so rows that come or go meanwhile shift nothing, and a page reads
    only keys behind the token: a top-``page_size`` of each task, merged."""
    rows = df if after is None else df.where(q(key) > F.lit(after))
    page = rows.orderBy(q(key)).limit(page_size)
    path = scratch_path(df.sparkSession, "page")
    page.write.parquet(path)
    page = df.sparkSession.read.schema(df.schema).parquet(path)
    last, n = page.agg(F.max(q(key)), F.count(F.lit(1))).first()
    return page, (last if n == page_size else None)
