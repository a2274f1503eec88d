"""A stream of record bundles whose types and fields are not known before."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from nestfold import commitlog
from nestfold.functions.variants import infer_schemas
from nestfold.operators.drift import merged
from nestfold.operators.entries import explode_entries
from nestfold.operators.flatten import flatten
from nestfold.session import path_exists
from nestfold.sources.bundles import stream_bundles_source

#: Entries as they came, by type and batch; the versions of the schemas.
ENTRIES, SCHEMAS = "entries", "_schemas"
#: Stands for entries without a type, here and in the registry.
UNTYPED = ""
ENTRY_COLUMNS = T.StructType().add("bundle_id", "string").add("res_data", "string").add("_batch", "long").add("res_name", "string")


def registry(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[str, T.StructType]]:
    """The newest (or a stated) version of the schemas, and its number; 0 and
    none before the first."""
    folder = f"{root}/{SCHEMAS}"
    found = commitlog.versions(spark, folder)
    if not found:
        return 0, {}
    version = version or found[-1]
    entry = commitlog.read_entry(spark, folder, version)
    return version, {t: T.StructType.fromJson(s) for t, s in entry["types"].items()}


def register_types(spark: SparkSession, root: str, types: dict[str, T.StructType]) -> int:
    """Merge ``types`` into the registry: new types and fields are added, types
    that differ widened. Nothing new, no new version. Returns the version."""
    while True:
        version, known = registry(spark, root)
        after = dict(known)
        for t, schema in types.items():
            after[t] = merged([known[t], schema]) if t in known else merged([schema])
        if after == known:
            return version
        try:
            commitlog.write_entry(spark, f"{root}/{SCHEMAS}", version + 1, {"types": {t: json.loads(s.json()) for t, s in after.items()}})
            return version + 1
        except commitlog.Taken:  # another stream of the same root
            continue


def stream_evolving(
    spark: SparkSession,
    src: str,
    root: str,
    checkpoint: str,
    files_per_trigger: int = 4,
    trigger: str = "availableNow",
    whole_file: bool = False,
) -> StreamingQuery:
    """Bundles landing as files → entries kept by type, with a registry of the
    schemas that the entries of each type have had so far.

    A micro-batch is one write, whatever the number of types, and one scan of
    what it wrote, which gives the schemas of all its types. A batch with an
    unknown type or field adds a version to the registry before it ends;
    ``read_type`` reads all entries, earlier ones too, by the newest. A batch
    that is replayed after a failure replaces its own partitions, and a schema
    registered twice is registered once."""
    bundles = stream_bundles_source(spark, src, "file" if whole_file else "lines", files_per_trigger)
    entries = explode_entries(bundles).select("bundle_id", "res_data", F.coalesce("res_name", F.lit(UNTYPED)).alias("res_name"))
    out = f"{root}/{ENTRIES}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch", "res_name").parquet(out)
        if path_exists(own, f"{out}/_batch={batch_id}"):
            written = own.read.schema(ENTRY_COLUMNS).parquet(out).where(F.col("_batch") == batch_id)
            named = written.withColumn("res_name", F.coalesce("res_name", F.lit(UNTYPED)))
            register_types(own, root, infer_schemas(named, "res_data", "res_name"))

    w = entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    return (w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)).start()


def read_type(spark: SparkSession, root: str, record_type: str | None, version: int | None = None, flat: bool = True) -> DataFrame:
    """All entries of one type by the registry's newest (or a stated) schema,
    flattened with the type as prefix beside ``_bundle_id``. A registered type
    without entries is an empty table with its columns; one that nobody has
    registered raises."""
    name = UNTYPED if record_type is None else record_type
    _, types = registry(spark, root, version)
    if name not in types:
        raise KeyError(f"no schema of {record_type!r} below {root}")
    prefix = "untyped" if record_type is None else record_type
    out = f"{root}/{ENTRIES}"
    rows = spark.read.schema(ENTRY_COLUMNS).parquet(out) if path_exists(spark, out) else spark.createDataFrame([], ENTRY_COLUMNS)
    rows = rows.where(F.coalesce("res_name", F.lit(UNTYPED)) == name)
    schema = types[name] if types[name].fields else T.StructType().add("_none", "string")
    typed = rows.select(F.col("bundle_id").alias("_bundle_id"), F.from_json("res_data", schema).alias(prefix))
    if not types[name].fields:
        typed = typed.select("_bundle_id")
    return flatten(typed) if flat else typed
