"""Parquet files whose columns drift in presence, name case and type, as one
frame."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestfold.operators.flatten import q
from nestfold.sources.files import list_files

#: Digits before the point that each integer type needs.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
INTEGERS = list(DIGITS)
MOST_DIGITS = 38


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point of an exact number type."""
    if type(t) in DIGITS:
        return DIGITS[type(t)], 0
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return None


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of this lattice that holds the values of both.

    Integers widen by size, exact numbers to a decimal that fits, other numbers
    to double; date to timestamp without, then with time zone; structs field by
    field (names by lower case), arrays and maps by their parts. All else meets
    in string, the top. Order and repetition of types make no difference."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in DIGITS and type(b) in DIGITS:
        return max(a, b, key=lambda t: INTEGERS.index(type(t)))
    numbers = (T.FloatType, T.DoubleType)
    x, y = _decimal(a), _decimal(b)
    if x and y:
        before, behind = max(x[0], y[0]), max(x[1], y[1])
        return T.DecimalType(before + behind, behind) if before + behind <= MOST_DIGITS else T.DoubleType()
    if (x or isinstance(a, numbers)) and (y or isinstance(b, numbers)):
        return T.DoubleType()
    times = [T.DateType, T.TimestampNTZType, T.TimestampType]
    if type(a) in times and type(b) in times:
        return max(a, b, key=lambda t: times.index(type(t)))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType))
    return T.StringType()


def merged(schemas: list[T.StructType]) -> T.StructType:
    """The schema that holds all of ``schemas``: every column of any, by lower
    case, under the name that comes first, with the widest type."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            k = f.name.lower()
            kind = plain(f.dataType)
            found[k] = T.StructField(found[k].name, wider(found[k].dataType, kind)) if k in found else T.StructField(f.name, kind)
    return T.StructType(list(found.values()))


def plain(t: T.DataType) -> T.DataType:
    """``t`` with every part nullable and without metadata."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(plain(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(plain(t.keyType), plain(t.valueType))
    return t


def widen(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` of type ``have`` as ``want``, a type ``wider`` made of it."""
    if have == want:
        return c
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    if isinstance(want, T.StructType):
        fields = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            own = fields.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if own is None else widen(c.getField(own.name), own.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: widen(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        keys = F.transform_keys(c, lambda k, v: widen(k, have.keyType, want.keyType))
        return F.transform_values(keys, lambda k, v: widen(v, have.valueType, want.valueType))
    return c.cast(want)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``schema`` (JSON) and ``fingerprint`` of every Parquet file
    below ``path``. Tasks read the footers, nothing else of the files, through
    the file systems that Arrow knows (local, HDFS, S3, GCS)."""

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            rows = []
            for uri in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(uri.replace("file:///", "/", 1) if uri.startswith("file:///") else uri)
                arrow = pq.read_schema(name, filesystem=store)
                own = (arrow.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                schema = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(arrow)
                text = plain(schema).json()
                rows.append((uri, text, hashlib.sha256(text.encode()).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * 3, names=["file", "schema", "fingerprint"])

    files = list_files(spark, path).where(F.col("path").rlike(r"\.parquet$")).select("path")
    return files.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(read, "file string, schema string, fingerprint string")


def read_drifting(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below ``path`` as one frame with the merged schema;
    a column a file lacks is null in its rows, one of another type is widened.

    Footers are read in tasks and files grouped by schema; each group is read
    once, with its own schema, and widened by projection, so filters and
    columns still prune its scan. The plan has one scan per different schema,
    not per file; the driver holds the file names, as for any read."""
    groups = footers(spark, path).groupBy("fingerprint").agg(F.first("schema").alias("schema"), F.sort_array(F.collect_list("file")).alias("files"))
    found = sorted(groups.collect(), key=lambda r: r["files"][0])
    if not found:
        raise ValueError(f"no Parquet files below {path}")
    schemas = [T.StructType.fromJson(json.loads(r["schema"])) for r in found]
    want = merged(schemas)
    parts = []
    for r, schema in zip(found, schemas):
        have = {f.name.lower(): f for f in schema.fields}
        df = spark.read.schema(schema).parquet(*r["files"])
        columns = []
        for f in want.fields:
            own = have.get(f.name.lower())
            c = F.lit(None).cast(f.dataType) if own is None else widen(q(own.name), own.dataType, f.dataType)
            columns.append(c.alias(f.name))
        parts.append(df.select(*columns))
    return reduce(DataFrame.unionByName, parts)
