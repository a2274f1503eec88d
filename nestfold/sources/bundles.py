"""Reading record bundles.

A bundle is a JSON object ``{"resourceType": "Bundle", "id", "entry": [...]}``.
It is parsed with ``from_json`` against a schema that declares each entry's
``resource`` as a *string*: Spark keeps that subtree as raw JSON text, so one
pass splits every bundle without knowing any record type's schema. Files that
do not parse land in ``_corrupt_record`` and are dropped; roots that are not
bundles are dropped.

Layouts: ``"file"`` — one bundle per file (UTF-8, read whole by one task: many
small files are packed per task by ``maxPartitionBytes``); ``"lines"`` — one
bundle per line (NDJSON), splittable, the layout to prefer at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

ENTRY_SCHEMA = StructType(
    [
        StructField("fullUrl", StringType()),
        StructField("request", StructType([StructField("url", StringType()), StructField("method", StringType())])),
        StructField("resource", StringType()),
    ]
)

BUNDLE_SCHEMA = StructType(
    [
        StructField("resourceType", StringType()),
        StructField("id", StringType()),
        StructField("type", StringType()),
        StructField("page", LongType()),
        StructField("status", StringType()),
        StructField("entry", ArrayType(ENTRY_SCHEMA)),
        StructField("_corrupt_record", StringType()),
    ]
)


def read_bundle_text(spark: SparkSession, path: str, layout: str = "file") -> DataFrame:
    """``(source_file, value)``: one row per bundle text."""
    if layout == "file":
        df = spark.read.text(path, wholetext=True)
    elif layout == "lines":
        df = spark.read.text(path)
        df = df.where(F.length(F.trim("value")) > 0)
    else:
        raise ValueError("layout must be 'file' or 'lines'")
    return df.select(F.col("_metadata.file_path").alias("source_file"), "value")


def parse_bundles(text: DataFrame, value_col: str = "value", keep_invalid: bool = False) -> DataFrame:
    """Parse bundle texts: ``(<other columns>, resource_type, bundle_id, entry,
    valid)``. Unparsable texts and non-bundle roots are dropped unless
    ``keep_invalid``."""
    parsed = F.from_json(F.col(value_col), BUNDLE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    others = [c for c in text.columns if c != value_col]
    df = text.select(*others, parsed.alias("b"))
    return _bundles(text.select(*others, parsed.alias("b")).select(*others, "b.*"), others, keep_invalid)


def _bundles(parsed: DataFrame, others: list, keep_invalid: bool) -> DataFrame:
    """Parsed roots → ``(<others>, resource_type, bundle_id, page, status, entry, valid)``.
    A bundle in one piece is page 0 of itself."""
    valid = F.col("_corrupt_record").isNull() & F.col("resourceType").eqNullSafe(F.lit("Bundle"))
    df = parsed.select(
        *others,
        F.col("resourceType").alias("resource_type"),
        F.col("id").alias("bundle_id"),
        F.coalesce("page", F.lit(0)).alias("page"),
        "status",
        "entry",
        valid.alias("valid"),
    )
    return df if keep_invalid else df.where("valid").drop("valid")


#: Fixed value: what no JSON text holds, in any encoding (control characters are
#: escaped in it). As the end of a line it makes a line of each whole file.
NO_LINE_END = "\x00\x01" * 4


def _json_options(reader, layout: str):
    """With ``multiLine`` the JSON source would open a file again for every
    ``resource``, to fetch its text by place; of a line it has the bytes."""
    if layout not in ("file", "lines"):
        raise ValueError("layout must be 'file' or 'lines'")
    reader = reader.schema(BUNDLE_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.option("lineSep", NO_LINE_END) if layout == "file" else reader


def _roots(parsed: DataFrame, layout: str) -> DataFrame:
    """The JSON source gives empty text for the objects in a file of UTF-16 or
    UTF-32, as their places are counted in characters: such a file is broken."""
    if layout == "lines":
        return parsed
    some = lambda test: F.coalesce(F.exists("entry", lambda e: test(e["resource"])), F.lit(False))
    lost = some(lambda r: r == "") & ~some(lambda r: r.startswith("{"))
    return parsed.withColumn("_corrupt_record", F.when(lost, F.lit("")).otherwise(F.col("_corrupt_record")))


def read_bundles(spark: SparkSession, path: str, layout: str = "file", keep_invalid: bool = False) -> DataFrame:
    """Directory of bundle files → parsed bundles with their ``source_file``
    (corrupt / non-bundle dropped). The JSON source parses each text once; a
    parse as an expression is repeated in every filter it is pushed into."""
    roots = _json_options(spark.read, layout).json(path)
    return _bundles(_roots(roots, layout).select(F.col("_metadata.file_path").alias("source_file"), "*"), ["source_file"], keep_invalid)


def stream_bundles_source(spark: SparkSession, path: str, layout: str, files_per_trigger: int) -> DataFrame:
    """The same over files that land in ``path`` and its sub-folders."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", True)
    return _bundles(_roots(_json_options(reader, layout).json(path), layout), [], False)
