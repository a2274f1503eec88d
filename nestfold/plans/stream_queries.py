"""Streaming queries: landed files appended to a table, landed JSON records
and bundles flattened into append tables. Each runs its stream to the end of
the landed input (``availableNow``) and returns the sink table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from nestfold.operators.union import union_drift
from nestfold.plans.bundle_queries import _TABLES, LANDING_CODEC, land_bundles
from nestfold.plans.registry import register
from nestfold.session import scratch_path
from nestfold.sinks.writers import to_json_text
from nestfold.sources.tables import table
from nestfold.streaming.evolving import read_type, registry, stream_evolving
from nestfold.streaming.streams import stream_append, stream_bundles, stream_flatten, stream_rejects, stream_split_by_type

LANDED_FILES = 8


def _run(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@register("q_stream_append", "SELECT * FROM events")
def q_stream_append(spark, sf_dir):
    """Parquet files landing in a folder (8 files) appended to a table, four
    files per micro-batch."""
    events = table(spark, sf_dir, "events")
    landing = scratch_path(spark, "landing-events")
    events.repartition(LANDED_FILES).write.parquet(landing)
    out = scratch_path(spark, "events-table")
    _run(stream_append(spark, landing, out, events.schema, scratch_path(spark, "ckpt-append")))
    return spark.read.schema(events.schema).parquet(out)


EVENT_JSON = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StructType([StructField("k", LongType())])),
    ]
)


@register(
    "q_stream_flatten",
    """
SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events
""",
)
def q_stream_flatten(spark, sf_dir):
    """Nested JSON records landing as lines, parsed with a declared schema and
    flattened (``props.k`` → ``props_k``) by a stream."""
    events = table(spark, sf_dir, "events")
    nested = events.select(
        to_json_text(
            F.struct("event_id", "ts", "user_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))
        ).alias("value")
    )
    landing = scratch_path(spark, "landing-event-json")
    nested.repartition(LANDED_FILES).write.text(landing)
    out = scratch_path(spark, "events-flat")
    _run(stream_flatten(spark, landing, out, EVENT_JSON, scratch_path(spark, "ckpt-flatten")))
    return spark.read.parquet(out)


LINE_JSON = StructType(
    [
        StructField("resourceType", StringType()),
        StructField("id", StringType()),
        StructField("orderkey", LongType()),
        StructField("linenumber", LongType()),
        StructField("partkey", LongType()),
        StructField("suppkey", LongType()),
        StructField("quantity", DoubleType()),
        StructField("extendedprice", DoubleType()),
        StructField("returnflag", StringType()),
        StructField("shipdate", StringType()),
    ]
)


@register(
    "q_stream_bundles",
    """
SELECT CAST(l.l_orderkey AS VARCHAR) AS _bundle_id, 'Line' AS Line_resourceType,
       CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS Line_id,
       l.l_orderkey AS Line_orderkey, CAST(l.l_linenumber AS BIGINT) AS Line_linenumber,
       l.l_partkey AS Line_partkey, l.l_suppkey AS Line_suppkey, l.l_quantity AS Line_quantity,
       l.l_extendedprice AS Line_extendedprice, l.l_returnflag AS Line_returnflag,
       strftime(l.l_shipdate, '%Y-%m-%d') AS Line_shipdate
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""",
)
def q_stream_bundles(spark, sf_dir):
    """Bundles landing as files, continuously split: the Line entries parsed
    with their declared schema, flattened and appended."""
    landing = land_bundles(spark, sf_dir)
    out = scratch_path(spark, "lines-flat")
    _run(stream_bundles(spark, landing, out, "Line", LINE_JSON, scratch_path(spark, "ckpt-bundles")))
    return spark.read.parquet(out)


ORDER_JSON = StructType(
    [
        StructField("resourceType", StringType()),
        StructField("id", StringType()),
        StructField("custkey", LongType()),
        StructField("status", StringType()),
        StructField("totalprice", DoubleType()),
        StructField("orderdate", StringType()),
        StructField("priority", StringType()),
    ]
)


CUSTOMER_JSON = StructType(
    [
        StructField("resourceType", StringType()),
        StructField("id", StringType()),
        StructField("name", StringType()),
        StructField("nationkey", LongType()),
        StructField("acctbal", DoubleType()),
    ]
)


@register(
    "q_stream_split",
    """
SELECT t.* EXCLUDE (Customer_segment), CASE WHEN Customer_id IS NOT NULL THEN '{"segment":"' || Customer_segment || '"}' END AS _rest
FROM ("""
    + _TABLES
    + ") t",
)
def q_stream_split(spark, sf_dir):
    """One stream over landing bundles feeding a flat table per record type;
    all tables read back and stacked. The customers' schema does not declare
    the segment, which so is in ``_rest``."""
    out = scratch_path(spark, "split-tables")
    schemas = {"Order": ORDER_JSON, "Line": LINE_JSON, "Customer": CUSTOMER_JSON}
    _run(stream_split_by_type(spark, land_bundles(spark, sf_dir), out, schemas, scratch_path(spark, "ckpt-split"), rest=True))
    tables = [spark.read.parquet(f"{out}/{t}").drop("_batch") for t in sorted(schemas)]
    return union_drift(tables)


@register("q_stream_evolving", _TABLES)
def q_stream_evolving(spark, sf_dir):
    """Landing bundles kept by type while the registry learns their schemas: a
    first run sees finished orders, a second one, which goes on from its
    checkpoint, all others; every type read by the newest schema."""
    root, landing, checkpoint = scratch_path(spark, "evolving"), scratch_path(spark, "landing-two"), scratch_path(spark, "ckpt-evolving")
    texts = spark.read.text(land_bundles(spark, sf_dir))
    done = F.coalesce(F.get_json_object("value", "$.status") == "F", F.lit(False))
    for part in (texts.where(done), texts.where(~done)):
        part.write.mode("append").option("compression", LANDING_CODEC).text(landing)
        _run(stream_evolving(spark, landing, root, checkpoint, files_per_trigger=16))
    _, types = registry(spark, root)
    return union_drift([read_type(spark, root, t) for t in sorted(types)])


@register(
    "q_stream_rejects",
    """
SELECT event_type, 'good' AS kind, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events WHERE user_id % 2 = 0 GROUP BY ALL
UNION ALL SELECT NULL, 'rejected', count(*), NULL FROM events WHERE user_id % 2 = 1
""",
)
def q_stream_rejects(spark, sf_dir):
    """A feed in which the lines of every other user break off: the stream's
    good rows, and the rejected lines in a table of their own."""
    events = table(spark, sf_dir, "events")
    text = to_json_text(F.struct("event_id", "ts", "user_id", "event_type", "value"))
    cut = F.when(F.col("user_id") % 2 == 1, F.expr("substring(text, 1, length(text) - 5)")).otherwise(F.col("text"))
    landing = scratch_path(spark, "landing-damaged")
    events.select("user_id", text.alias("text")).select(cut.alias("value")).repartition(LANDED_FILES).write.text(landing)
    out, bad = scratch_path(spark, "events-good"), scratch_path(spark, "events-bad")
    _run(stream_flatten(spark, landing, out, EVENT_JSON, scratch_path(spark, "ckpt-good")))
    _run(stream_rejects(spark, landing, bad, EVENT_JSON, scratch_path(spark, "ckpt-bad")))
    good = spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
    rejected = spark.read.parquet(bad).agg(F.count("*").alias("n"))
    none = F.lit(None)
    return good.select("event_type", F.lit("good").alias("kind"), "n", "ids").unionByName(
        rejected.select(none.cast("string").alias("event_type"), F.lit("rejected").alias("kind"), "n", none.cast("long").alias("ids"))
    )
