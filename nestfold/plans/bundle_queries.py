"""Queries over record bundles landed as files: parse, explode entries,
route by type, per-type statistics and per-type outputs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from nestfold.functions.variants import infer_schemas
from nestfold.operators.entries import bundle_stats, explode_entries, first_type, out_path, select_types, type_counts
from nestfold.operators.flatten import flatten
from nestfold.operators.union import union_drift
from nestfold.plans.records import bundle_texts
from nestfold.plans.registry import register
from nestfold.session import landed, scratch_path
from nestfold.sinks.packed import read_manifest
from nestfold.sinks.tree import write_tree
from nestfold.sinks.writers import STAGED_CODEC, read_ndjson, write_by_type, write_ndjson
from nestfold.sources.bundles import read_bundles
from nestfold.sources.files import list_files, source_files
from nestfold.sources.tables import table


# Landed bundle files are compressed the way landing zones usually hold JSON;
# the readers decompress transparently. One file per writer task, so the
# codec's lack of splitting costs no parallelism.
LANDING_CODEC = "snappy"


def land_bundles(spark, sf_dir, faults=False):
    """The bundles derived from the tables, landed as NDJSON files below the
    shared scratch folder (once per session); returns the folder."""
    return landed(
        spark,
        "bundles",
        (sf_dir, faults),
        lambda path: bundle_texts(spark, sf_dir, faults=faults)
        .select("value")
        .write.option("compression", LANDING_CODEC)
        .text(path),
    )


def landed_entries(spark, sf_dir, faults=False):
    path = land_bundles(spark, sf_dir, faults)
    return explode_entries(read_bundles(spark, path, layout="lines")), path


def _res_id():
    return F.get_json_object("res_data", "$.id")


# Entries of the bundles derived from the tables, in SQL. ``st``/``pr`` carry
# the order's status and priority, which decide the injected faults.
_ENTRIES = """
WITH e AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS bundle_id, 'Order' AS res_name,
         CAST(o_orderkey AS VARCHAR) AS res_id, o_orderstatus AS st, o_orderpriority AS pr
  FROM orders
  UNION ALL
  SELECT CAST(o.o_orderkey AS VARCHAR), 'Customer', CAST(c.c_custkey AS VARCHAR), o.o_orderstatus, o.o_orderpriority
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  UNION ALL
  SELECT CAST(o.o_orderkey AS VARCHAR), 'Line', CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR),
         o.o_orderstatus, o.o_orderpriority
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
), faulty AS (
  SELECT * FROM e
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), NULL, 'n' || CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority FROM orders
), valid AS (
  SELECT * FROM faulty WHERE st <> 'P' AND pr <> '5-LOW'
)
"""


@register("q_bundle_read", _ENTRIES + "SELECT bundle_id, res_name, res_id FROM e")
def q_bundle_read(spark, sf_dir):
    """Bundle files → one row per entry: bundle, record type (from the
    request URL) and record id."""
    entries, _ = landed_entries(spark, sf_dir)
    return entries.select("bundle_id", "res_name", _res_id().alias("res_id"))


@register("q_bundle_typed", _ENTRIES + "SELECT bundle_id, res_name, res_id FROM valid")
def q_bundle_typed(spark, sf_dir):
    """Damaged feed: truncated files and non-bundle roots are skipped, entries
    without a resource are skipped, an entry without a request keeps a NULL
    type."""
    entries, _ = landed_entries(spark, sf_dir, faults=True)
    return entries.select("bundle_id", "res_name", _res_id().alias("res_id"))


@register(
    "q_exclude_types",
    _ENTRIES + "SELECT bundle_id, res_name, res_id FROM valid WHERE res_name IS NULL OR res_name NOT IN ('Order', 'Customer')",
)
def q_exclude_types(spark, sf_dir):
    """Drop two record types; entries with no type are kept, as a plain
    inequality test keeps them."""
    entries, _ = landed_entries(spark, sf_dir, faults=True)
    kept = select_types(entries, exclude=["Order", "Customer"])
    return kept.select("bundle_id", "res_name", _res_id().alias("res_id"))


@register("q_include_types", _ENTRIES + "SELECT bundle_id, res_name, res_id FROM e WHERE res_name IN ('Order', 'Customer')")
def q_include_types(spark, sf_dir):
    """Keep only the listed record types."""
    entries, _ = landed_entries(spark, sf_dir)
    kept = select_types(entries, include=["Order", "Customer"])
    return kept.select("bundle_id", "res_name", _res_id().alias("res_id"))


@register(
    "q_split_by_type",
    _ENTRIES + "SELECT res_name, count(*) AS n_entries, count(DISTINCT bundle_id) AS n_bundles FROM e GROUP BY res_name",
)
def q_split_by_type(spark, sf_dir):
    """Entries grouped by record type: entries and bundles per type."""
    entries, _ = landed_entries(spark, sf_dir)
    return type_counts(entries)


@register(
    "q_first_type",
    """
SELECT CAST(o.o_orderkey AS VARCHAR) AS bundle_id,
       CASE WHEN o.o_orderstatus = 'O' AND c.c_custkey IS NOT NULL THEN 'Customer' ELSE 'Order' END AS first_type
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""",
)
def q_first_type(spark, sf_dir):
    """The record type of each bundle's first entry, in arrival order."""
    entries, _ = landed_entries(spark, sf_dir)
    return first_type(entries)


@register(
    "q_bundle_stats",
    _ENTRIES
    + """
SELECT count(DISTINCT bundle_id) AS n_bundles, count(*) AS n_type_files, CAST(sum(n) AS BIGINT) AS n_entries
FROM (SELECT bundle_id, res_name, count(*) AS n FROM e GROUP BY bundle_id, res_name)
""",
)
def q_bundle_stats(spark, sf_dir):
    """Bundles read, per-type outputs they give (distinct types per bundle,
    summed) and entries."""
    entries, _ = landed_entries(spark, sf_dir)
    return bundle_stats(entries)


@register(
    "q_out_path",
    _ENTRIES
    + """
SELECT DISTINCT bundle_id, res_name,
       '/out/' || res_name || '/' || replace('bundle_' || bundle_id || '.json', '.json', '') || '_' || res_name AS out_path
FROM e
""",
)
def q_out_path(spark, sf_dir):
    """Output path per (bundle file, record type): ``<root>/<Type>/<file>_<Type>``,
    the file name with ``.json`` removed. Files are named after their bundle."""
    entries, _ = landed_entries(spark, sf_dir)
    pairs = entries.select("bundle_id", "res_name").distinct()
    named = pairs.withColumn("source_file", F.concat(F.lit("bundle_"), F.col("bundle_id"), F.lit(".json")))
    return out_path(named, "/out").select("bundle_id", "res_name", "out_path")


# The three record types as flat tables, in SQL.
_TABLES = """
SELECT CAST(o_orderkey AS VARCHAR) AS _bundle_id, 'Order' AS Order_resourceType, CAST(o_orderkey AS VARCHAR) AS Order_id,
       o_custkey AS Order_custkey, o_orderstatus AS Order_status, o_totalprice AS Order_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS Order_orderdate, o_orderpriority AS Order_priority
FROM orders
UNION ALL BY NAME
SELECT CAST(o.o_orderkey AS VARCHAR) AS _bundle_id, 'Customer' AS Customer_resourceType,
       CAST(c.c_custkey AS VARCHAR) AS Customer_id, c.c_name AS Customer_name, c.c_nationkey AS Customer_nationkey,
       c.c_acctbal AS Customer_acctbal, c.c_mktsegment AS Customer_segment
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
UNION ALL BY NAME
SELECT CAST(o.o_orderkey AS VARCHAR) AS _bundle_id, 'Line' AS Line_resourceType,
       CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS Line_id,
       l.l_orderkey AS Line_orderkey, CAST(l.l_linenumber AS BIGINT) AS Line_linenumber,
       l.l_partkey AS Line_partkey, l.l_suppkey AS Line_suppkey, l.l_quantity AS Line_quantity,
       l.l_extendedprice AS Line_extendedprice, l.l_returnflag AS Line_returnflag,
       strftime(l.l_shipdate, '%Y-%m-%d') AS Line_shipdate
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
"""


@register("q_write_by_type", _TABLES)
def q_write_by_type(spark, sf_dir):
    """Entries → one flat Parquet table per record type (schema inferred per
    type); all tables read back and stacked."""
    entries, _ = landed_entries(spark, sf_dir)
    paths = write_by_type(entries, scratch_path(spark, "by-type"))
    return union_drift([spark.read.parquet(p) for _, p in sorted(paths.items())])


@register(
    "q_bundles_to_tables",
    _TABLES
    + """
UNION ALL BY NAME
SELECT CAST(o_orderkey AS VARCHAR) AS _bundle_id, 'Note' AS untyped_resourceType, 'n' || CAST(o_orderkey AS VARCHAR) AS untyped_id
FROM orders
""",
)
def q_bundles_to_tables(spark, sf_dir):
    """Two loads appended to the tables per type, finished orders first: bundle
    files → split by type → flatten → Parquet per type; every table, also that
    of the entries without a type, read back."""
    entries, _ = landed_entries(spark, sf_dir)
    notes = entries.groupBy("bundle_id", "status").agg(F.lit(None).cast("string").alias("res_name"))
    note = F.to_json(F.struct(F.lit("Note").alias("resourceType"), F.concat(F.lit("n"), "bundle_id").alias("id")))
    both = entries.select("bundle_id", "status", "res_name", "res_data").unionByName(notes.withColumn("res_data", note))
    out, paths = scratch_path(spark, "tables"), {}
    done = F.col("status").eqNullSafe(F.lit("F"))
    for load in (both.where(done), both.where(~done)):
        paths.update(write_by_type(load, out, mode="append"))
    return union_drift([spark.read.parquet(p) for _, p in sorted(paths.items())])


PACKED_BYTES = 4 << 20


@register(
    "q_write_by_source",
    _ENTRIES + "SELECT res_name, bundle_id, count(*) AS n_rows, count(*) AS n_found FROM e GROUP BY res_name, bundle_id",
)
def q_write_by_source(spark, sf_dir):
    """Entries → one table per record type, rows of a bundle side by side, many
    bundles to a file: what the manifests say each bundle has, and the rows of
    that bundle found in the ranges they name."""
    entries, _ = landed_entries(spark, sf_dir)
    paths = write_by_type(entries, scratch_path(spark, "by-source"), packed_bytes=PACKED_BYTES)
    found = []
    for t, path in sorted(paths.items()):
        at = F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
        rows = spark.read.parquet(path).select("_bundle_id", *at)
        ranges = read_manifest(spark, path)
        in_range = rows.join(ranges, ["_bundle_id", "file"]).where("row >= first_row AND row < first_row + n_rows")
        n_found = in_range.groupBy("_bundle_id").agg(F.count("*").alias("n_found"))
        n_rows = ranges.groupBy("_bundle_id").agg(F.sum("n_rows").alias("n_rows"))
        found.append(n_rows.join(n_found, "_bundle_id", "left").select(F.lit(t).alias("res_name"), F.col("_bundle_id").alias("bundle_id"), "n_rows", "n_found"))
    return union_drift(found)


@register("q_route_by_type", _ENTRIES + "SELECT bundle_id, coalesce(res_name, 'Note') AS res_name, res_id FROM valid")
def q_route_by_type(spark, sf_dir):
    """Damaged feed routed by each record's own type: an entry without a request
    has one too."""
    bundles = read_bundles(spark, land_bundles(spark, sf_dir, faults=True), layout="lines")
    entries = explode_entries(bundles, route_by="type")
    return entries.select("bundle_id", "res_name", _res_id().alias("res_id"))


FILE_ENTRIES = 500


@register(
    "q_bundle_files",
    """
SELECT 'Order' AS res_name, CAST(o_orderkey AS VARCHAR) AS res_id, o_orderstatus AS status, o_totalprice AS totalprice FROM orders
""",
)
def q_bundle_files(spark, sf_dir):
    """One bundle per file, over several lines each: about ``FILE_ENTRIES``
    orders a bundle, and beside them a file that breaks off and one that is no
    bundle. Every file is read whole and its entries routed by their own type."""

    def write(path):
        orders = table(spark, sf_dir, "orders")
        n = max(1, orders.count() // FILE_ENTRIES)
        entry = F.to_json(F.struct(F.struct(F.lit("Order").alias("resourceType"), F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("totalprice")).alias("resource")))
        pages = orders.select(F.pmod(F.xxhash64("o_orderkey"), F.lit(n)).alias("page"), entry.alias("e"))
        text = F.concat(F.lit('{"resourceType": "Bundle",\n"id": "'), F.col("page").cast("string"), F.lit('",\n"entry": [\n'), F.concat_ws(",\n", "e"), F.lit("\n]}"))
        good = pages.groupBy("page").agg(F.collect_list("e").alias("e")).select(F.col("page").cast("string"), text.alias("value"))
        bad = spark.createDataFrame([("-1", '{"resourceType": "Bundle",\n"entry": ['), ("-2", '{"resourceType": "List",\n"entry": [{"resource": {"id": "x"}}]}')], "page string, value string")
        write_tree(good.unionByName(bad), path, F.concat(F.lit("bundle_"), "page", F.lit(".json")), "value")

    root = landed(spark, "bundle-files", (sf_dir,), write)
    entries = explode_entries(read_bundles(spark, root, layout="file"), route_by="type")
    field = lambda f: F.get_json_object("res_data", f"$.{f}")
    return entries.select("res_name", _res_id().alias("res_id"), field("status").alias("status"), field("totalprice").cast("double").alias("totalprice"))


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


@register(
    "q_ndjson_roundtrip",
    """
SELECT 'Order' AS resourceType, CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS custkey, o_orderstatus AS status,
       o_totalprice AS totalprice, strftime(o_orderdate, '%Y-%m-%d') AS orderdate, o_orderpriority AS priority
FROM orders
""",
)
def q_ndjson_roundtrip(spark, sf_dir):
    """Entries written as JSON lines partitioned by type; the Order folder read
    back with its declared schema."""
    entries, _ = landed_entries(spark, sf_dir)
    out = write_ndjson(entries, scratch_path(spark, "ndjson"), json_col="res_data", partition_by=["res_name"])
    return read_ndjson(spark, f"{out}/res_name=Order", schema=ORDER_JSON)


@register("q_ndjson_types", _TABLES)
def q_ndjson_types(spark, sf_dir):
    """Entries written as JSON lines, a folder per type; every type's folder read
    back by the schema of its records, all found in one scan."""
    entries, _ = landed_entries(spark, sf_dir)
    out = scratch_path(spark, "ndjson-types")
    head = F.regexp_replace(F.to_json(F.struct(F.col("bundle_id").alias("_bundle_id"))), r"\}$", "")
    line = F.concat(head, F.lit(',"resource":'), F.col("res_data"), F.lit("}"))
    write_ndjson(entries.select("res_name", line.alias("line")), out, json_col="line", partition_by=["res_name"], compression=STAGED_CODEC)
    schemas = infer_schemas(spark.read.schema("value string, res_name string").text(out), "value", "res_name")
    flats = []
    for t, schema in sorted(schemas.items()):
        rows = read_ndjson(spark, f"{out}/res_name={t}", schema=schema).select("_bundle_id", F.col("resource").alias(t))
        flats.append(flatten(rows))
    return union_drift(flats)


@register(
    "q_source_files",
    "SELECT o_orderstatus AS folder, count(*) AS n_bundles FROM orders GROUP BY o_orderstatus",
)
def q_source_files(spark, sf_dir):
    """Bundles landed in one folder per order status; the source file of every
    bundle row found by reading the landing root, rows counted per folder."""

    def write(path):
        # re-file the landed bundles by the status they name; no shuffle
        texts = spark.read.text(land_bundles(spark, sf_dir))
        status = F.get_json_object("value", "$.status").alias("status")
        texts.select(status, "value").write.partitionBy("status").option("compression", LANDING_CODEC).text(path)

    root = landed(spark, "bundles-by-status", (sf_dir,), write)
    # a bundle is counted by its first page
    files = source_files(read_bundles(spark, root, layout="lines").where("page = 0"))
    folder = F.regexp_extract("source_file", r"/status=([^/]+)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg(F.sum("n_rows").alias("n_bundles"))


@register(
    "q_file_listing",
    """
SELECT o_orderstatus AS folder, (SELECT count(DISTINCT o_orderstatus) FROM orders) AS n_folders
FROM orders GROUP BY o_orderstatus ORDER BY 1 LIMIT 2
""",
)
def q_file_listing(spark, sf_dir):
    """The first two folders by name that hold files, and how many there are in
    all (a paged listing and its count); file contents are never read."""
    q_source_files(spark, sf_dir)  # lands the folders
    root = landed(spark, "bundles-by-status", (sf_dir,), None)
    folder = F.regexp_extract("path", r"/status=([^/]+)/[^/]*$", 1)
    names = list_files(spark, root).select(folder.alias("folder")).distinct()
    return names.orderBy("folder").limit(2).withColumn("n_folders", F.lit(names.count()))
