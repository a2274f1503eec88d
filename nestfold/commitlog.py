"""A folder of numbered JSON entries, each created whole or not at all.

Renames must be atomic and fail on an existing target, as on a file system or
HDFS; an object store needs a committer that gives this.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Taken(RuntimeError):
    """Another writer created this entry first."""


def fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str) -> list:
    """File statuses in the folder ``path``, none if it is not there."""
    p, fs = fs_path(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the entries, ascending, from one listing."""
    names = [st.getPath().getName() for st in listed(spark, folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_entry(spark: SparkSession, folder: str, version: int) -> dict:
    p, fs = fs_path(spark, f"{folder}/{version:08d}.json")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_entry(spark: SparkSession, folder: str, version: int, entry: dict) -> None:
    """Create entry ``version``, which must not be there (else ``Taken``)."""
    temp, fs = fs_path(spark, f"{folder}/.{version:08d}-{uuid.uuid4().hex}")
    stream = fs.create(temp, False)
    stream.write(json.dumps(entry).encode())
    stream.close()
    target = fs_path(spark, f"{folder}/{version:08d}.json")[0]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE  # never over an existing entry
    try:
        files.rename(temp, target, how)
    except Py4JJavaError as e:
        fs.delete(temp, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise Taken(f"{target} is there already") from e
        raise
