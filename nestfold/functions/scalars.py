"""Scalar rendering: values as text, NULLs spelled out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, StringType, StructType

from nestfold.functions.jsontext import to_json_text
from nestfold.operators.flatten import q


def stringify_col(c: Column, dtype, bool_style: str = "json") -> Column:
    """Text form of a value. Booleans are ``true``/``false`` (JSON spelling) or
    ``True``/``False`` with ``bool_style="python"``; nested values become
    JSON."""
    if isinstance(dtype, StringType):
        return c
    if isinstance(dtype, BooleanType):
        if bool_style == "python":
            return F.when(c, F.lit("True")).when(~c, F.lit("False"))
        return c.cast("string")
    if isinstance(dtype, (StructType, ArrayType, MapType)):
        return to_json_text(c)
    return c.cast("string")


def stringify(df: DataFrame, columns=None, bool_style: str = "json") -> DataFrame:
    """Cast ``columns`` (default: all) to text."""
    cols = set(df.columns if columns is None else columns)
    return df.select(
        *[
            stringify_col(q(f.name), f.dataType, bool_style).alias(f.name) if f.name in cols else q(f.name)
            for f in df.schema.fields
        ]
    )


def null_render(df: DataFrame, columns=None, null_text: str = "NULL") -> DataFrame:
    """Every value as text, a NULL as ``null_text``."""
    cols = set(df.columns if columns is None else columns)
    return df.select(
        *[
            F.coalesce(stringify_col(q(f.name), f.dataType), F.lit(null_text)).alias(f.name) if f.name in cols else q(f.name)
            for f in df.schema.fields
        ]
    )
