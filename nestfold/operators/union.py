"""Stacking frames whose schemas drift, schema comparison and conformance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from nestfold.operators.flatten import q


def union_drift(dfs, cast_conflicts: bool = True) -> DataFrame:
    """Stack frames by column name; a column missing from a frame is null
    there. Equal schemas are the plain stack, so no schema test is needed.
    Where two frames give one column different types, both sides are cast to
    string first (``cast_conflicts``) instead of failing at run time."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("nothing to union")
    if cast_conflicts:
        types: dict[str, set] = {}
        for d in dfs:
            for f in d.schema.fields:
                types.setdefault(f.name, set()).add(f.dataType.simpleString())
        conflict = {n for n, t in types.items() if len(t) > 1}
        if conflict:
            dfs = [
                d.select(*[q(c).cast(StringType()).alias(c) if c in conflict else q(c) for c in d.columns])
                for d in dfs
            ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_drifting_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below ``path`` as one frame: columns by name, missing
    ones null, types widened (see ``drift.read_drifting``)."""
    from nestfold.operators.drift import read_drifting

    return read_drifting(spark, path)


def schema_rows(df: DataFrame):
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """Column-by-column comparison of two schemas:
    ``(column_name, type_a, type_b, status)`` with status ``same``, ``type``,
    ``only_a`` or ``only_b``."""
    ta, tb = dict(schema_rows(a)), dict(schema_rows(b))
    rows = []
    for name in list(ta) + [n for n in tb if n not in ta]:
        x, y = ta.get(name), tb.get(name)
        status = "only_b" if x is None else "only_a" if y is None else "same" if x == y else "type"
        rows.append((name, x, y, status))
    return spark.createDataFrame(rows, "column_name string, type_a string, type_b string, status string")


def schema_equal(a: DataFrame, b: DataFrame) -> bool:
    return schema_rows(a) == schema_rows(b)


def conform(df: DataFrame, columns, cast: str | None = "string") -> DataFrame:
    """Select ``columns`` in the given order; a declared column the frame
    lacks is an all-null column. Columns not declared are left out (see
    ``extra_columns``)."""
    have = set(df.columns)
    out = []
    for c in columns:
        col = q(c) if c in have else F.lit(None)
        out.append((col.cast(cast) if cast else col).alias(c))
    return df.select(*out)


def extra_columns(df: DataFrame, columns) -> list[str]:
    declared = set(columns)
    return [c for c in df.columns if c not in declared]
