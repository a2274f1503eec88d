"""Structured Streaming: landed files → append table, and landed JSON
records or bundles → flattened append table.

Every stream declares its schema (a file stream cannot infer one) and keeps
its progress in a checkpoint folder, so a restarted query resumes where it
stopped and files are never appended twice. The flattening steps are
stateless (``from_json``, ``explode_outer``, projections), so no state store or
watermark is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from nestfold.operators.entries import explode_entries, select_types
from nestfold.operators.flatten import flatten
from nestfold.sources.bundles import stream_bundles_source


def _sink(df: DataFrame, out: str, checkpoint: str, fmt: str, trigger: str, partition_by=None) -> StreamingQuery:
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger == "once":
        w = w.trigger(once=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start(out)


def stream_append(
    spark: SparkSession,
    src: str,
    out: str,
    schema,
    checkpoint: str,
    files_per_trigger: int = 4,
    fmt: str = "parquet",
    trigger: str = "availableNow",
    source_format: str = "parquet",
) -> StreamingQuery:
    """Append every file landing below ``src`` (sub-folders included) to the
    table at ``out``, at most ``files_per_trigger`` files per micro-batch.
    ``fmt`` is the sink format: ``parquet`` here, ``delta`` where that package
    is installed."""
    stream = (
        spark.readStream.format(source_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", True)
        .load(src)
    )
    return _sink(stream, out, checkpoint, fmt, trigger)


def stream_flatten(
    spark: SparkSession,
    src: str,
    out: str,
    schema,
    checkpoint: str,
    prefix: str | None = None,
    files_per_trigger: int = 4,
    fmt: str = "parquet",
    trigger: str = "availableNow",
    whole_file: bool = False,
) -> StreamingQuery:
    """JSON records landing as text (one per line, or one per file with
    ``whole_file``) → parsed with the declared ``schema`` → flattened by
    exploding → appended. Broken records are left out here; ``stream_rejects``
    over the same folder keeps them."""
    recs = _records(spark, src, schema, files_per_trigger, whole_file)
    return _sink(flatten(recs.where(f"{BROKEN} IS NULL").drop(BROKEN), prefix=prefix), out, checkpoint, fmt, trigger)


BROKEN = "_corrupt_record"


def _records(spark, src, schema, files_per_trigger, whole_file) -> DataFrame:
    """Landing JSON records parsed once; ``BROKEN`` holds the text of a broken one."""
    declared = StructType([*schema.fields, StructField(BROKEN, StringType())])
    return (
        spark.readStream.schema(declared)
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("multiLine", whole_file)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", True)
        .json(src)
    )


def stream_rejects(
    spark: SparkSession,
    src: str,
    out: str,
    schema,
    checkpoint: str,
    files_per_trigger: int = 4,
    fmt: str = "parquet",
    trigger: str = "availableNow",
    whole_file: bool = False,
) -> StreamingQuery:
    """The records that ``stream_flatten`` leaves out, as ``value`` text and the
    JSON ``parsed`` of them, appended to a table of their own. (The source
    does not parse a record whose text alone is asked for.)"""
    recs = _records(spark, src, schema, files_per_trigger, whole_file).where(f"{BROKEN} IS NOT NULL")
    parsed = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]))
    return _sink(recs.select(F.col(BROKEN).alias("value"), parsed.alias("parsed")), out, checkpoint, fmt, trigger)


def stream_bundles(
    spark: SparkSession,
    src: str,
    out: str,
    record_type: str,
    schema,
    checkpoint: str,
    files_per_trigger: int = 4,
    fmt: str = "parquet",
    trigger: str = "availableNow",
    whole_file: bool = False,
    rest: bool = False,
) -> StreamingQuery:
    """Bundles landing as files → entries of one record type → parsed with the
    type's declared schema → flattened with the type as prefix → appended.
    One stream per record type keeps each table's schema fixed; ``rest`` adds a
    ``_rest`` column for the fields it does not declare."""
    bundles = stream_bundles_source(spark, src, "file" if whole_file else "lines", files_per_trigger)
    entries = select_types(explode_entries(bundles), include=[record_type])
    return _sink(_typed(entries, record_type, schema, rest), out, checkpoint, fmt, trigger)


def _typed(entries: DataFrame, record_type: str, schema, rest: bool) -> DataFrame:
    """Entries of one type parsed with its declared schema and flattened. With
    ``rest``, ``_rest`` is a JSON object of the top-level fields the schema does
    not declare, or NULL without any."""
    cols = [F.col("bundle_id").alias("_bundle_id"), F.from_json("res_data", schema).alias(record_type)]
    if rest:
        names = F.array(*[F.lit(f.name) for f in schema.fields])
        fields = F.variant_get(F.try_parse_json("res_data"), "$", "map<string,variant>")
        others = F.map_filter(fields, lambda k, v: ~F.array_contains(names, k))
        cols.append(F.when(F.size(others) > 0, F.to_json(others)).alias("_rest"))
    return flatten(entries.select(*cols))


#: Table of entries whose type has no declared schema.
OTHER = "other_types"


def stream_split_by_type(
    spark: SparkSession,
    src: str,
    out_root: str,
    schemas: dict,
    checkpoint: str,
    files_per_trigger: int = 4,
    trigger: str = "availableNow",
    whole_file: bool = False,
    rest: bool = False,
) -> StreamingQuery:
    """One stream over landing bundles that feeds one flat table per record
    type (``<out_root>/<Type>``), each type parsed with its declared schema.

    Each micro-batch is parsed once, kept for the duration of the batch, and
    written per type into ``_batch=<id>`` partitions with dynamic partition
    overwrite: a batch replayed after a failure rewrites its own partitions
    instead of appending twice. Entries of types not in ``schemas``, or of no
    type, go to ``<out_root>/other_types`` as they came."""
    bundles = stream_bundles_source(spark, src, "file" if whole_file else "lines", files_per_trigger)
    entries = explode_entries(bundles).select("bundle_id", "res_name", "res_data")

    def put(flat: DataFrame, name: str, batch_id: int) -> None:
        (
            flat.withColumn("_batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch")
            .parquet(f"{out_root}/{name}")
        )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for rtype, schema in schemas.items():
                put(_typed(batch.where(F.col("res_name") == rtype), rtype, schema, rest), rtype, batch_id)
            known = F.coalesce(F.col("res_name").isin(list(schemas)), F.lit(False))
            put(batch.where(~known).withColumnRenamed("bundle_id", "_bundle_id"), OTHER, batch_id)
        finally:
            batch.unpersist()

    w = entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()
