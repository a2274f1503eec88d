"""Schemas and paths of JSON records, found from the records themselves."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestfold.operators.flatten import q
from nestfold.session import scratch_path

#: Variant schemas' scalars as the JSON reader's; all others are text.
TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType()}


def _split(text: str) -> list[str]:
    """``text`` cut at the commas outside brackets and quotes."""
    parts, depth, quoted, begin = [], 0, False, 0
    for i, c in enumerate(text):
        if c == "`":
            quoted = not quoted
        elif not quoted:
            depth += (c in "<(") - (c in ">)")
            if c == "," and depth == 0:
                parts.append(text[begin:i])
                begin = i + 1
    return [p.strip() for p in [*parts, text[begin:]] if p.strip()]


def struct_of(schema: str) -> T.DataType | None:
    """The type of a variant schema (``OBJECT<a: BIGINT, ...>``): numbers as
    the JSON reader infers them, values of different types and nulls as text.
    An object without fields, or an array of such, has no type (None)."""
    if schema.startswith("OBJECT<"):
        fields = []
        for part in _split(schema[7:-1]):
            name, kind = re.fullmatch(r"(`(?:[^`]|``)*`|[^:]*): (.*)", part, re.S).groups()
            inner = struct_of(kind)
            if inner is not None:
                fields.append(T.StructField(name.strip("`").replace("``", "`") if name.startswith("`") else name, inner))
        return T.StructType(fields) if fields else None
    if schema.startswith("ARRAY<"):
        inner = struct_of(schema[6:-1])
        return T.ArrayType(inner) if inner is not None else None
    if schema.startswith("DECIMAL"):  # also 6.0, whose scale is 0
        return T.DoubleType()
    return TYPES.get(schema, T.StringType())


def infer_schemas(df: DataFrame, text: str, by: str, sizes: dict | None = None) -> dict:
    """The schema of the JSON records in ``text`` for each value of ``by``, from
    all records in one scan: schemas merge in partial aggregates, and the
    driver gets one row per value. Texts that are no JSON object are left out.
    ``sizes`` is given the bytes of each value's records as plain lines."""
    v = F.try_parse_json(q(text))
    n_bytes = F.sum(F.octet_length(q(text)) + 1).alias("n_bytes")
    found = df.groupBy(q(by).alias("by")).agg(F.schema_of_variant_agg(v).alias("s"), n_bytes).collect()
    if sizes is not None:
        sizes.update({r["by"]: r["n_bytes"] or 0 for r in found})
    out = {}
    for r in found:
        kind = struct_of(r["s"]) if r["s"] else None
        out[r["by"]] = kind if isinstance(kind, T.StructType) else T.StructType()
    return out


def _kind(schema: Column) -> Column:
    """``object``, ``array``, ``null`` or the scalar type of a variant schema."""
    head = F.lower(F.regexp_extract(schema, "^([A-Z]+)", 1))
    return F.when(head == "void", "null").otherwise(head)


def path_catalogue(df: DataFrame, text: str, max_depth: int = 64) -> DataFrame:
    """``path``, ``kind`` and ``n``: how many values of each kind the JSON records
    in ``text`` have at each path, from the data itself, so a path of several
    types shows them all. Kinds are ``object``, ``array``, ``null``, and the
    scalars ``bigint``, ``decimal``, ``double``, ``boolean``, ``string``, ...;
    the root's path is empty, fields add ``.name``, elements ``[]``. Text that
    is no JSON is ``invalid`` at the root; null text does not count.

    Level by level: the objects and arrays of a level are written and exploded
    to the next, so each value is parsed once and read once; counts combine
    before their shuffle. A record deeper than ``max_depth`` raises."""
    spark = df.sparkSession
    now = df.where(q(text).isNotNull()).select(F.lit("").alias("path"), F.try_parse_json(q(text)).alias("v"))
    counts = []
    for depth in range(max_depth + 1):
        kind = F.when(F.col("v").isNull(), "invalid").otherwise(_kind(F.schema_of_variant("v")))
        path = scratch_path(spark, "paths")
        now.withColumn("kind", kind).write.parquet(path)
        level = spark.read.parquet(path)
        counts.append(level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")))
        nested = level.where("kind IN ('object', 'array')")
        if nested.limit(1).count() == 0:
            break
        if depth == max_depth:
            raise ValueError(f"records are nested deeper than {max_depth}")
        below = nested.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("kind") == "array", "[]").otherwise(F.concat(F.when(F.col("path") == "", "").otherwise("."), F.col("key")))
        now = below.select(F.concat("path", step).alias("path"), F.col("value").alias("v"))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
