"""Profiles of frames and records: shape and non-null counts, record row
counts, byte lengths, schema paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from nestfold.operators.flatten import fanout_expr, q


def profile(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, n_rows, n_non_null)`` per column — shape and
    schema in one aggregation pass."""
    fields = df.schema.fields
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(q(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.col("_n").alias("n_rows"),
                    F.col(f"c{i}").alias("n_non_null"),
                )
                for i, f in enumerate(fields)
            ]
        )
    )
    return agg.select(rows.alias("p")).select("p.*")


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def record_counts(df: DataFrame, id_col: str, name: str = "n_rows") -> DataFrame:
    """Rows each record yields when flattened by exploding, per record id —
    computed from the arrays' sizes, without exploding; records sharing an id
    are summed."""
    nested = df.drop(id_col)
    per = df.select(q(id_col), fanout_expr(nested).alias(name))
    return per.groupBy(q(id_col)).agg(F.sum(name).alias(name))


def json_bytes(df: DataFrame, col: str, by=None) -> DataFrame:
    """Number and total UTF-8 byte length of serialised values, optionally per
    group."""
    aggs = [F.count(q(col)).alias("n_values"), F.sum(F.octet_length(q(col))).alias("n_bytes")]
    return df.groupBy(*[q(b) for b in (by or [])]).agg(*aggs)


def leaf_paths(schema: StructType, sep: str = ".") -> list[tuple[str, str, str]]:
    """``(path, kind, data_type)`` for every node of a nested schema; kind is
    ``struct``, ``array`` or ``scalar``; array elements add ``[]``."""
    out = []

    def rec(dt, path):
        if isinstance(dt, StructType):
            if path:
                out.append((path, "struct", "struct"))
            for f in dt.fields:
                rec(f.dataType, f"{path}{sep}{f.name}" if path else f.name)
        elif isinstance(dt, ArrayType):
            out.append((path, "array", dt.simpleString()))
            rec(dt.elementType, path + "[]")
        elif isinstance(dt, MapType):
            out.append((path, "map", dt.simpleString()))
        else:
            out.append((path, "scalar", dt.simpleString()))

    rec(schema, "")
    return out
