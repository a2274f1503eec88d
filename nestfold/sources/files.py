"""File-level sources: listings, source files, whole-file reads."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _binary(spark: SparkSession, path: str, recursive: bool, glob: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("ignoreMissingFiles", True)
    return (r.option("pathGlobFilter", glob) if glob else r).load(path)


def _empty_files(df: DataFrame, n_read: int | None = None) -> DataFrame:
    """Paths of the files of length 0, which the source lists but does not read.
    The names are those of the driver's listing, which any read has; they leave
    the JVM, one call each, and go to tasks only if some file is empty.
    ``n_read`` is the number of the others, where it is known."""
    spark, read = df.sparkSession, df.select("path")
    if len(df._jdf.inputFiles()) == (read.count() if n_read is None else n_read):
        return spark.createDataFrame([], "path string")
    names = df.inputFiles()
    plain = [n if "%" not in n else unquote(n) for n in names]
    same = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")  # file:/x and file:///x
    listed = spark.createDataFrame([(n,) for n in plain], "path string").withColumn("same", same)
    return listed.join(read.select(same.alias("same")), "same", "left_anti").select("path")


def list_files(spark: SparkSession, path: str, limit: int | None = None, recursive: bool = True) -> DataFrame:
    """``(path, length)`` of every file below ``path`` (object stores included,
    given their Hadoop configuration), empty ones too. Only file metadata is
    read: the content column is pruned. ``limit`` returns the first files by
    name; for further pages see ``numbering``."""
    found = _binary(spark, path, recursive)
    df = found.select("path", "length").unionByName(_empty_files(found).withColumn("length", F.lit(0).cast("bigint")))
    if limit is not None:
        df = df.orderBy("path").limit(limit)
    return df


#: A task reads so many small files, or so many bytes of larger ones: each task
#: that writes a tree makes folders of its own.
TASK_FILES, TASK_BYTES = 1000, 128 << 20


def _listed_path() -> Column:
    """A file's path as the listing has it, by which a filter leaves out files
    that then are not opened (one on the source's own ``path`` reads them all)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path")


def read_whole_files(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """``(path, content BINARY, length)`` — one row per file, bytes as stored;
    an empty file has empty content. Files that a filter on ``path`` leaves out
    are not read."""
    found = _binary(spark, path, recursive, glob)
    n, size = found.agg(F.count("*"), F.sum("length")).first()
    tasks = max(spark.sparkContext.defaultParallelism, n // TASK_FILES, (size or 0) // TASK_BYTES)
    none = _empty_files(found, n).select("path", F.unhex(F.lit("")).alias("content"), F.lit(0).cast("bigint").alias("length"))
    return found.select(_listed_path(), "content", "length").coalesce(tasks).unionByName(none)


def source_files(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Files that contributed rows: ``(source_file, n_rows)``."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"))


def relative_path(path: Column, root: str) -> Column:
    """A file's path below ``root``, however either writes the scheme."""
    tail = root.split("://", 1)[-1].removeprefix("file:").strip("/").split("/")[-1]  # the root's own name
    return F.substring_index(path, f"/{tail}/", -1)
