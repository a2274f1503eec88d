"""Sinks: per-type Parquet, NDJSON, CSV, JSON documents, JDBC."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from nestfold.functions.variants import infer_schemas
from nestfold.functions.jsontext import JSON_WRITE_OPTIONS, to_json_text  # noqa: F401
from nestfold.operators.flatten import flatten, q
from nestfold.sinks.packed import write_packed


#: Codec of JSON lines that only later steps read; readers know it by the ending.
#: Each task writes files of its own, so that none need be split.
STAGED_CODEC = "snappy"


def write_ndjson(df: DataFrame, path: str, json_col: str | None = None, partition_by=None, mode: str = "overwrite", compression: str = "none"):
    """One JSON object per line. ``json_col`` names a column that already
    holds JSON text (written verbatim); otherwise each row is serialised."""
    if json_col is None:
        w = df.write.mode(mode).options(**JSON_WRITE_OPTIONS).option("compression", compression)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.json(path)
        return path
    cols = list(partition_by or []) + [F.col(json_col).alias("value")]
    w = df.select(*cols).write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)
    return path


def read_ndjson(spark: SparkSession, path: str, schema=None, primitives_as_string: bool = False) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if primitives_as_string:
        r = r.option("primitivesAsString", True)
    return r.json(path)


#: How NULL is written in CSV, so that it differs from empty text. A text that
#: starts with a backslash gets another one before it, so none reads as NULL.
CSV_NULL = r"\N"


def _texts(df: DataFrame, change) -> DataFrame:
    """``change`` made to every text column that has a backslash in front."""
    return df.select(*[F.when(q(f.name).startswith("\\"), change(q(f.name))).otherwise(q(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else q(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", null_text: str = CSV_NULL):
    """Header row, quoted fields (embedded newlines survive with ``multiLine``
    on read), ``"`` as the escape character, NULL as ``null_text``."""
    if null_text == CSV_NULL:
        df = _texts(df, lambda c: F.concat(F.lit("\\"), c))
    (
        df.write.mode(mode)
        .option("nullValue", null_text)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def read_csv(spark: SparkSession, path: str, schema=None, infer: bool = False, sep: str = ",", null_text: str = CSV_NULL) -> DataFrame:
    """Read a header CSV. ``infer=True`` scans all rows to pick types;
    otherwise give ``schema`` (no inference pass). Only ``null_text`` is NULL;
    empty text stays empty, and with the default ``null_text`` the backslash
    that ``write_csv`` put before another one is taken off."""
    r = spark.read.option("nullValue", null_text).option("emptyValue", "").option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True).option("samplingRatio", 1.0)
    df = r.csv(path)
    return _texts(df, lambda c: F.when(c.startswith("\\\\"), F.substr(c, F.lit(2))).otherwise(c)) if null_text == CSV_NULL else df


#: Table of entries that name no type.
UNTYPED = "untyped"


def write_types(entries: DataFrame, raw: str) -> dict[str, str]:
    """Split entries by record type into ``<raw>/res_name=<Type>`` JSON lines
    (each line ``{"_bundle_id": .., "resource": {..}}``) and return the folder
    of each type present (``None``: entries without a type). One pass over the
    entries; later steps read one type's folder each."""
    head = F.regexp_replace(F.to_json(F.struct(F.col("bundle_id").alias("_bundle_id"))), r"\}$", "")
    text = F.concat(
        F.when(F.col("bundle_id").isNull(), F.lit("{")).otherwise(F.concat(head, F.lit(","))),
        F.lit('"resource":'),
        F.col("res_data"),
        F.lit("}"),
    )
    staged = entries.select("res_name", text.alias("value")).write.mode("errorifexists").option("compression", STAGED_CODEC)
    staged.partitionBy("res_name").text(raw)
    # the types are the partition folders just written: one directory listing;
    # a folder's name may be an escaped form of the type
    found = {}
    for name in _folders(entries.sparkSession, raw):
        if name.startswith("res_name="):
            t = unquote(name[len("res_name=") :])
            found[None if t == "__HIVE_DEFAULT_PARTITION__" else t] = name
    return dict(sorted(found.items(), key=lambda x: (x[0] is None, x[0] or "")))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def write_by_type(
    entries: DataFrame,
    out: str,
    mode: str = "overwrite",
    flatten_mode: str = "explode",
    partition_by_source: bool = False,
    max_fanout: int | None = 1_000_000,
    packed_bytes: int | None = None,
) -> dict[str, str]:
    """Bundle entries → one flat Parquet table per record type at
    ``<out>/<Type>`` (a type's name is escaped as in partition folders; entries
    without a type go to ``<out>/untyped``). Each type's schema is inferred
    from all of its records in this load (one scan for all types), the
    records are flattened with the type as column prefix, and ``_bundle_id`` is
    kept. The load's entries are staged in a folder of their own, which is
    removed, so an ``append`` adds this load's records once. A record that
    would explode to more than ``max_fanout`` rows raises before its table is
    written. An ``overwrite`` also removes the tables of an earlier load whose
    type is gone. ``packed_bytes`` sorts each table by bundle id into files of
    about that many bytes of JSON, many bundles to a file, with a manifest of
    which rows of which file a bundle has (``packed.read_key`` reads one);
    ``partition_by_source`` makes a folder per bundle (for few bundles)."""
    spark = entries.sparkSession
    raw = f"{out}/_raw/load={uuid.uuid4().hex}"
    paths = {}
    try:
        folders = write_types(entries, raw)
        # one scan of the staged lines gives the schemas of all types
        lines = spark.read.schema("value string, res_name string").text(raw) if folders else None
        sizes = {}
        schemas = infer_schemas(lines, "value", "res_name", sizes) if folders else {}
        for t, folder in folders.items():
            name, column = (UNTYPED, UNTYPED) if t is None else (folder[len("res_name=") :], t)
            recs = spark.read.schema(schemas[t]).json(f"{raw}/{folder}")
            # keep the bundle id next to the flattened fields; a type whose
            # resources are all empty objects has no inferred "resource" column
            keep = [c for c in ("_bundle_id", "resource") if c in recs.columns]
            limit = max_fanout if flatten_mode == "explode" else None
            flat = flatten(recs.select(*keep), prefix=None, mode=flatten_mode, max_fanout=limit)
            flat = flat.select(
                *[q(c).alias(column + c[len("resource"):]) if c.startswith("resource_") else q(c) for c in flat.columns]
            )
            path = f"{out}/{name}"
            if packed_bytes is not None and "_bundle_id" in flat.columns:
                write_packed(flat, path, "_bundle_id", sizes[t], packed_bytes, mode)
            else:
                w = flat.write.mode(mode)
                (w.partitionBy("_bundle_id") if partition_by_source else w).parquet(path)
            paths[UNTYPED if t is None else t] = path
        _list_tables(spark, out, {p.rsplit("/", 1)[-1] for p in paths.values()}, mode)
    finally:
        p, fs = _fs(spark, raw)
        fs.delete(p, True)
    return paths


def _list_tables(spark: SparkSession, out: str, names: set[str], mode: str) -> None:
    """Keep the names of the tables below ``out`` in ``_TABLES``; an overwrite
    removes tables of an earlier load whose type is gone."""
    at, fs = _fs(spark, f"{out}/_TABLES")
    before = set()
    if fs.exists(at):
        stream = fs.open(at)
        before = set(json.loads(bytes(stream.readAllBytes()).decode()))
        stream.close()
    if mode == "overwrite":
        for gone in before - names:
            fs.delete(_fs(spark, f"{out}/{gone}")[0], True)
        before = set()
    stream = fs.create(at, True)
    stream.write(json.dumps(sorted(before | names)).encode())
    stream.close()


def to_json_documents(df: DataFrame, key: str, rows_per_doc: int = 10000) -> DataFrame:
    """Wrap rows into JSON documents ``{"<key>": [row, ...]}`` of at most
    ``rows_per_doc`` rows each. Documents are cut within input partitions
    (``monotonically_increasing_id`` keeps the partition in its upper bits), so
    no document, group or task grows with the data."""
    mid = F.monotonically_increasing_id()
    chunk = F.struct(
        F.shiftright(mid, 33).alias("part"), F.floor((mid.bitwiseAND(F.lit((1 << 33) - 1))) / rows_per_doc).alias("n")
    )
    rows = df.select(chunk.alias("doc"), F.struct(*[q(c) for c in df.columns]).alias("r"))
    return rows.groupBy("doc").agg(to_json_text(F.struct(F.collect_list("r").alias(key))).alias("document"))


def write_jdbc(df: DataFrame, url: str, table: str, columns=None, mode: str = "append", properties=None):
    """Insert ``columns`` of ``df`` into a database table; each executor task
    writes its partition in batches."""
    if columns is not None:
        df = df.select(*[q(c) for c in columns])
    df.write.mode(mode).jdbc(url, table, properties=properties or {})


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties=None,
    null_text: str | None = "NULL",
    column: str | None = None,
    lower=None,
    upper=None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a database table; with ``null_text`` every column is rendered as
    text with NULLs spelled out. ``column`` (numeric, date or timestamp) with
    ``lower``, ``upper`` and ``partitions`` splits the read into that many
    range queries; without it one task reads the table."""
    properties = {"fetchsize": str(fetch_size), **(properties or {})}
    split = {}
    if column is not None:
        split = {"column": column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    df = spark.read.jdbc(url, table, properties=properties, **split)
    if null_text is None:
        return df
    from nestfold.functions.scalars import null_render

    return null_render(df, null_text=null_text)
