"""Queries on flat tables: round trips through JSON lines, CSV and JSON
text, drifting Parquet sets, id history, dedupe, profiles, conformance."""

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

from nestfold.functions.scalars import null_render, stringify
from nestfold.operators.flatten import flatten
from nestfold.functions.variants import path_catalogue
from nestfold.operators import increments
from nestfold.operators.counted import write_counted
from nestfold.operators.history import dedupe_first, new_ids, read_history, update_history, write_history
from nestfold.operators.positions import long_positions, spread_positions, usual_width
from nestfold.operators.profile import json_bytes, leaf_paths, profile, record_counts
from nestfold.operators.union import conform, read_drifting_parquet, schema_diff, union_drift
from nestfold.plans.declared import ENCOUNTER_COLUMNS, PATIENT_COLUMNS
from nestfold.plans.declared_records import ENCOUNTER, PATIENT, explode_name, flat_sql, indexed_name, record_columns, widths
from nestfold.plans.flatten_queries import _CROSS_COLS, _LINES_LEFT, INDEXED_WIDTH, _cross_records
from nestfold.plans.records import landed_orders, order_records, ordered_records
from nestfold.plans.registry import register
from nestfold.session import landed, scratch_path
from nestfold.sinks.writers import read_csv, read_ndjson, to_json_documents, to_json_text, write_csv, write_ndjson
from nestfold.sources.tables import table

_FANOUT_SQL = """
SELECT o.o_orderkey AS id,
       CAST(greatest(coalesce(lc.n, 0), 1) * greatest(coalesce(fc.n, 0), 1) AS BIGINT) AS n_rows
FROM orders o
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) lc ON lc.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY l_orderkey) fc
       ON fc.l_orderkey = o.o_orderkey
"""


@register("q_ndjson_counts", _FANOUT_SQL)
def q_ndjson_counts(spark, sf_dir):
    """Nested records written as JSON lines, read back (schema inferred from
    every line) and counted: rows each record gives when flattened."""
    recs = landed_orders(spark, sf_dir, line_fields=["linenumber", "quantity"]).select("id", "lines", "flags")
    path = write_ndjson(recs, scratch_path(spark, "orders-ndjson"))
    back = read_ndjson(spark, path)
    return record_counts(back, "id")


_DOC_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


def _documents_csv(spark, sf_dir):
    return landed(spark, "documents-csv", (sf_dir,), lambda p: write_csv(table(spark, sf_dir, "documents"), p))


@register("q_csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_roundtrip(spark, sf_dir):
    """Whole documents (multi-line text with quotes) written as header CSV and
    read back with their schema."""
    return read_csv(spark, _documents_csv(spark, sf_dir), schema=_DOC_SCHEMA)


@register(
    "q_infer_schema",
    """
SELECT * FROM (VALUES ('doc_id', 'int'), ('text', 'string'), ('lang', 'string'),
                      ('source', 'string'), ('n_chars', 'int')) AS t(column_name, data_type)
""",
)
def q_infer_schema(spark, sf_dir):
    """CSV types inferred from a scan of every row."""
    df = read_csv(spark, _documents_csv(spark, sf_dir), infer=True)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column_name string, data_type string")


@register(
    "q_json_document",
    "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders",
)
def q_json_document(spark, sf_dir):
    """Rows wrapped in JSON documents ``{"Orders": [...]}`` of bounded size,
    then parsed back and unwrapped: every row once."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    docs = to_json_documents(orders, "Orders", rows_per_doc=5000)
    parsed = F.from_json("document", "Orders array<struct<id: bigint, status: string>>")
    return docs.select(F.explode(parsed.getField("Orders")).alias("r")).select("r.*")


_ORDERS_SCHEMA = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderdate", TimestampNTZType()),
        StructField("o_orderpriority", StringType()),
    ]
)


@register("q_json_roundtrip", "SELECT * FROM orders")
def q_json_roundtrip(spark, sf_dir):
    """Rows serialised to JSON text and parsed back."""
    orders = table(spark, sf_dir, "orders")
    js = orders.select(to_json_text(F.struct(*orders.columns)).alias("j"))
    return js.select(F.from_json("j", _ORDERS_SCHEMA).alias("r")).select("r.*")


@register(
    "q_json_bytes",
    "SELECT event_type, count(props) AS n_values, CAST(sum(strlen(props)) AS BIGINT) AS n_bytes FROM events GROUP BY event_type",
)
def q_json_bytes(spark, sf_dir):
    """UTF-8 byte length of serialised JSON values per event type."""
    return json_bytes(table(spark, sf_dir, "events"), "props", by=["event_type"])


@register(
    "q_stringify",
    """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(value AS VARCHAR) AS value,
       event_type, CASE WHEN value > 100 THEN 'True' ELSE 'False' END AS high
FROM events
""",
)
def q_stringify(spark, sf_dir):
    """Scalars as text; booleans in Python spelling."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type", (F.col("value") > 100).alias("high"))
    return stringify(ev, bool_style="python")


@register(
    "q_null_render",
    """
SELECT CAST(o.o_orderkey AS VARCHAR) AS Order_id,
       coalesce(CAST(l.l_linenumber AS VARCHAR), 'NULL') AS Order_lines_linenumber,
       coalesce(CAST(l.l_partkey AS VARCHAR), 'NULL') AS Order_lines_partkey
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""",
)
def q_null_render(spark, sf_dir):
    """Flattened rows printed with NULLs spelled ``NULL``."""
    recs = landed_orders(spark, sf_dir, flags=False, line_fields=["linenumber", "partkey"]).select("id", "lines")
    return null_render(flatten(recs, prefix="Order"))


@register(
    "q_drop_null_cols",
    """
SELECT o_orderkey AS Order_id, 'Order' AS Order_resourceType, o_custkey AS Order_custkey,
       o_orderstatus AS Order_status, o_orderpriority AS Order_priority
FROM orders
""",
)
def q_drop_null_cols(spark, sf_dir):
    """Columns null in every row (here ``note``) are dropped from the flat."""
    recs = order_records(spark, sf_dir, lines=False, flags=False, extra_null_field=True)
    recs = recs.select("id", "resourceType", "custkey", "status", "priority", "note")
    return flatten(recs, prefix="Order", drop_null_columns=True)


@register("q_vstack", "SELECT * FROM orders")
def q_vstack(spark, sf_dir):
    """Frames with equal schemas stacked."""
    orders = table(spark, sf_dir, "orders")
    parts = [orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    rest = orders.where(F.col("o_orderstatus").isNull() | ~F.col("o_orderstatus").isin("F", "O", "P"))
    return union_drift(parts + [rest])


# three landed parts of ``orders`` whose columns drift
_DRIFT = {
    "F": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"],
    "O": ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    "P": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
}


def _land_drift(spark, sf_dir):
    """Three Parquet parts of ``orders`` with drifting columns (once per session)."""

    def write(root):
        orders = table(spark, sf_dir, "orders")
        for status, cols in _DRIFT.items():
            other = F.coalesce(~F.col("o_orderstatus").isin("F", "O"), F.lit(True))  # the last part takes all that is left
            orders.where(other if status == "P" else F.col("o_orderstatus") == status).select(*cols).write.parquet(f"{root}/part_{status}")

    return landed(spark, "drift", (sf_dir,), write)


@register(
    "q_union_drift",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
UNION ALL BY NAME
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderstatus IS NULL
""",
)
def q_union_drift(spark, sf_dir):
    """Parquet files with drifting columns read as one frame; missing columns
    are null. Every file is read exactly once."""
    return read_drifting_parquet(spark, _land_drift(spark, sf_dir))


# per priority: the type each column of ``orders`` has in that part's files;
# a column that is not named is missing there
_DRIFT_TYPES = {
    "1-URGENT": {"o_orderkey": "bigint", "o_custkey": "int", "o_totalprice": "double", "o_orderdate": "date"},
    "2-HIGH": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "bigint", "o_orderpriority": "string"},
    "3-MEDIUM": {"o_orderkey": "int", "o_custkey": "string", "o_orderstatus": "string", "o_orderdate": "timestamp_ntz"},
    "4-NOT SPECIFIED": {"o_orderkey": "int", "o_totalprice": "int", "O_ORDERSTATUS": "string"},
    "5-LOW": {"o_orderkey": "bigint", "o_custkey": "smallint", "o_totalprice": "decimal(12,2)", "o_orderdate": "date"},
}
_SQL_TYPES = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR"}
_DRIFT_TARGET = {"o_orderkey": "BIGINT", "o_custkey": "VARCHAR", "o_totalprice": "DOUBLE", "o_orderdate": "TIMESTAMP", "o_orderpriority": "VARCHAR", "o_orderstatus": "VARCHAR"}


def _drift_sql():
    parts = []
    for priority, types in _DRIFT_TYPES.items():
        have = {c.lower(): t for c, t in types.items()}
        columns = []
        for c, target in _DRIFT_TARGET.items():
            value = "NULL" if c not in have else c
            if c in have and have[c] in ("bigint", "int", "smallint") and c != "o_orderkey":
                value = f"{'trunc(' + c + ')' if c == 'o_totalprice' else c + (' % 30000' if have[c] == 'smallint' else '')}"
            columns.append(f"CAST(CAST({value} AS {_SQL_TYPES.get(have.get(c), have.get(c, target))}) AS {target}) AS {c}")
        parts.append(f"SELECT {', '.join(columns)} FROM orders WHERE o_orderpriority = '{priority}'")
    return " UNION ALL ".join(parts)


@register("q_drift_types", _drift_sql())
def q_drift_types(spark, sf_dir):
    """Parquet files that give one column as int, long, small int, text, decimal,
    date or timestamp, or not at all, or in another case, read as one frame."""

    def write(root):
        orders = table(spark, sf_dir, "orders")
        for i, (priority, types) in enumerate(_DRIFT_TYPES.items()):
            columns = []
            for c, t in types.items():
                value = F.col(c) % 30000 if t == "smallint" else F.col(c)
                columns.append(value.cast(t).alias(c))
            orders.where(F.col("o_orderpriority") == priority).select(*columns).repartition(3).write.parquet(f"{root}/part_{i}")

    return read_drifting_parquet(spark, landed(spark, "drift-types", (sf_dir,), write))


@register(
    "q_schema_diff",
    """
SELECT * FROM (VALUES
  ('o_orderkey', 'bigint', 'bigint', 'same'),
  ('o_custkey', 'bigint', NULL, 'only_a'),
  ('o_orderstatus', 'string', 'string', 'same'),
  ('o_totalprice', 'double', NULL, 'only_a'),
  ('o_orderdate', NULL, 'timestamp_ntz', 'only_b'),
  ('o_orderpriority', NULL, 'string', 'only_b')) AS t(column_name, type_a, type_b, status)
""",
)
def q_schema_diff(spark, sf_dir):
    """Schemas of two landed parts compared column by column."""
    root = _land_drift(spark, sf_dir)
    a = spark.read.parquet(f"{root}/part_F")
    b = spark.read.parquet(f"{root}/part_O")
    return schema_diff(spark, a, b)


@register(
    "q_profile",
    "WITH f AS ("
    + _CROSS_COLS
    + _LINES_LEFT
    + """)
SELECT 'Order_id' AS column_name, 'bigint' AS data_type, count(*) AS n_rows, count(Order_id) AS n_non_null FROM f
UNION ALL SELECT 'Order_resourceType', 'string', count(*), count(Order_resourceType) FROM f
UNION ALL SELECT 'Order_status', 'string', count(*), count(Order_status) FROM f
UNION ALL SELECT 'Order_totalprice', 'double', count(*), count(Order_totalprice) FROM f
UNION ALL SELECT 'Order_lines_linenumber', 'int', count(*), count(Order_lines_linenumber) FROM f
UNION ALL SELECT 'Order_lines_quantity', 'double', count(*), count(Order_lines_quantity) FROM f
UNION ALL SELECT 'Order_lines_partkey', 'bigint', count(*), count(Order_lines_partkey) FROM f
UNION ALL SELECT 'Order_lines_returnflag', 'string', count(*), count(Order_lines_returnflag) FROM f
UNION ALL SELECT 'Order_flags', 'string', count(*), count(Order_flags) FROM f
""",
)
def q_profile(spark, sf_dir):
    """Schema, row count and non-null count per column of a flattened table,
    in one aggregation."""
    return profile(flatten(_cross_records(spark, sf_dir), prefix="Order"))


@register(
    "q_path_types",
    """
SELECT * FROM (VALUES
  ('flags', 'array', 'array<string>'), ('flags[]', 'scalar', 'string'),
  ('id', 'scalar', 'bigint'),
  ('lines', 'array', 'array<struct<linenumber:bigint,quantity:double>>'),
  ('lines[]', 'struct', 'struct'),
  ('lines[].linenumber', 'scalar', 'bigint'), ('lines[].quantity', 'scalar', 'double'),
  ('status', 'scalar', 'string')) AS t(path, kind, data_type)
""",
)
def q_path_types(spark, sf_dir):
    """Every path of the records' schema, inferred from all JSON lines, with
    its kind (struct, array, scalar) and type."""
    recs = landed_orders(spark, sf_dir, line_fields=["linenumber", "quantity"]).select("id", "status", "lines", "flags")
    back = read_ndjson(spark, write_ndjson(recs, scratch_path(spark, "orders-ndjson")))
    return spark.createDataFrame(leaf_paths(back.schema), "path string, kind string, data_type string")


# Declared target columns for the Order flat: two are not produced by the data.
ORDER_DECLARED = ["Order_id", "Order_status", "Order_priority", "Order_note", "Order_lines_linenumber", "Order_channel"]


# records in which ``v`` is a number, a text, a list or an object, or is missing
_MIXED = """
SELECT o_orderkey AS id, o_orderstatus AS st, o_custkey AS c, coalesce(o_orderpriority, '') AS p, o_totalprice AS t FROM orders
"""


@register(
    "q_path_catalogue",
    f"""
WITH o AS ({_MIXED})
SELECT '' AS path, 'object' AS kind, count(*) AS n FROM o
UNION ALL SELECT 'id', 'bigint', count(*) FROM o
UNION ALL SELECT 'v', CASE st WHEN 'F' THEN 'bigint' WHEN 'O' THEN 'string' WHEN 'P' THEN 'array' ELSE 'object' END, count(*) FROM o WHERE c % 5 > 0 GROUP BY 2
UNION ALL SELECT 'v[]', 'bigint', count(*) FROM o WHERE c % 5 > 0 AND st = 'P' HAVING count(*) > 0
UNION ALL SELECT 'v[]', 'object', count(*) FROM o WHERE c % 5 > 0 AND st = 'P' HAVING count(*) > 0
UNION ALL SELECT 'v[].k', 'string', count(*) FROM o WHERE c % 5 > 0 AND st = 'P' HAVING count(*) > 0
UNION ALL SELECT 'v', 'null', count(*) FROM o WHERE c % 5 = 0 HAVING count(*) > 0
""",
)
def q_path_catalogue(spark, sf_dir):
    """Paths of JSON records with the kinds of values found at each, from the
    records: one path is a number, a text, a list or null."""
    o = table(spark, sf_dir, "orders")
    other = F.lit("{}")
    pair = F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit(',{"k":"'), F.coalesce("o_orderpriority", F.lit("")), F.lit('"}]'))
    st = F.col("o_orderstatus")
    v = F.when(F.col("o_custkey") % 5 == 0, "null").when(st == "F", F.col("o_custkey").cast("string"))
    v = v.when(st == "O", F.concat(F.lit('"'), F.coalesce("o_orderpriority", F.lit("")), F.lit('"'))).when(st == "P", pair).otherwise(other)
    text = F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"), F.lit(',"v":'), v, F.lit("}"))
    return path_catalogue(o.select(text.alias("text")), "text")


@register(
    "q_load_counts",
    """
SELECT 'good' AS kind, count(*) AS n_rows, (SELECT count(*) FROM events) AS n_seen, (SELECT count(*) FROM events WHERE user_id % 3 > 0) AS n_good,
       CAST(sum(event_id) AS BIGINT) AS ids, (SELECT CAST(max(event_id) AS BIGINT) FROM events WHERE user_id % 3 > 0) AS newest
FROM events WHERE user_id % 3 > 0
UNION ALL SELECT 'rejected', count(*), (SELECT count(*) FROM events), (SELECT count(*) FROM events WHERE user_id % 3 > 0), NULL,
       (SELECT CAST(max(event_id) AS BIGINT) FROM events WHERE user_id % 3 > 0)
FROM events WHERE user_id % 3 = 0
""",
)
def q_load_counts(spark, sf_dir):
    """A load of JSON lines of which every third user's break off: good and
    rejected records told apart by one parse, written in one pass and counted
    by it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")

    def write(path):
        text = F.to_json(F.struct("event_id", "user_id"))
        cut = F.when(F.col("user_id") % 3 == 0, F.expr("substring(text, 1, length(text) - 3)")).otherwise(F.col("text"))
        events.withColumn("text", text).select(cut.alias("value")).write.text(path)

    landing = landed(spark, "events-damaged", (sf_dir,), write)
    rows = spark.read.schema("event_id bigint, user_id bigint, _broken string").option("columnNameOfCorruptRecord", "_broken").json(landing)
    whole = F.col("_broken").isNull()
    good, bad, n = write_counted(rows, scratch_path(spark, "counted"), whole, {"newest": F.max(F.when(whole, F.col("event_id")))})
    both = good.agg(F.lit("good").alias("kind"), F.count("*").alias("n_rows"), F.sum("event_id").alias("ids")).unionByName(
        bad.agg(F.lit("rejected").alias("kind"), F.count("*").alias("n_rows"), F.lit(None).cast("bigint").alias("ids"))
    )
    return both.withColumns({"n_seen": F.lit(n["n_rows"]), "n_good": F.lit(n["n_good"]), "newest": F.lit(n["newest"])})


@register(
    "q_conform_schema",
    """
SELECT CAST(o.o_orderkey AS VARCHAR) AS Order_id, o.o_orderstatus AS Order_status,
       o.o_orderpriority AS Order_priority, CAST(NULL AS VARCHAR) AS Order_note,
       CAST(l.l_linenumber AS VARCHAR) AS Order_lines_linenumber, CAST(NULL AS VARCHAR) AS Order_channel
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""",
)
def q_conform_schema(spark, sf_dir):
    """A flat conformed to a declared all-text column list: declared order,
    missing columns null, undeclared columns left out."""
    recs = landed_orders(spark, sf_dir, flags=False, line_fields=["linenumber", "partkey"])
    flat = flatten(recs.select("id", "status", "priority", "lines"), prefix="Order")
    return conform(flat, ORDER_DECLARED)


# ----------------------------------------------------------- incremental load

_HIST_SQL = "SELECT o_orderkey AS Order_id FROM orders WHERE o_orderstatus = 'F'"
_NEW_SQL = (
    "SELECT o_orderkey AS Order_id FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' "
    "OR (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')"
)


def _history_case(spark, sf_dir):
    """The first load has every finished order, the second all others and some
    of the first again."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Order_id"), "o_orderstatus", "o_orderpriority")
    root = scratch_path(spark, "history")
    done = F.col("o_orderstatus").eqNullSafe(F.lit("F"))
    v1 = write_history(update_history(read_history(spark, None, "Order_id"), orders.where(done), "Order_id"), root, 1)
    return root, v1, orders.where(~done | (F.col("o_orderpriority") == "2-HIGH"))


@register(
    "q_incremental_load",
    """
SELECT o_orderkey AS Order_id, o_orderstatus AS status,
       CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END AS load
FROM orders
""",
)
def q_incremental_load(spark, sf_dir):
    """Three loads as one flow: finished orders, then open ones with some of
    the first again, then all orders; the rows each load brought, with its
    version."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )
    root = scratch_path(spark, "increments")
    for rows in (orders.where("status = 'F'"), orders.where("status = 'O' OR (status = 'F' AND priority = '2-HIGH')"), orders):
        increments.load_increment(rows, root, "Order_id")
    return increments.loaded_rows(spark, root).select("Order_id", "status", F.col("_load").alias("load"))


# The priorities, in the order they are loaded.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register(
    "q_load_recovery",
    f"""
WITH o AS (
  SELECT *, coalesce(list_position({list(PRIORITIES)}, o_orderpriority), {len(PRIORITIES)}) AS load FROM orders),
v AS (SELECT unnest(range(1, {len(PRIORITIES) + 1})) AS version)
SELECT CAST(version AS INTEGER) AS version,
       count(*) FILTER (load = version AND o_orderstatus IS DISTINCT FROM 'P') AS n_rows,
       count(*) FILTER (load = version AND o_orderstatus IS DISTINCT FROM 'P') AS n_read,
       count(*) FILTER (load <= version AND o_orderstatus = 'P') AS n_rejected,
       CAST((version - 1) % 4 + 1 - CASE WHEN version % 4 = 0 THEN 3 ELSE 0 END + CASE WHEN version > 4 THEN 1 ELSE 0 END AS INTEGER) AS n_id_folders
FROM o, v GROUP BY version
""",
)
def q_load_recovery(spark, sf_dir):
    """Five loads, each with all rows of the loads before it again and with rows
    that have no id; before each, a load of everything breaks off before its
    commit. The log of the loads, beside the rows a reader finds for each.
    The fourth load merges the ids of four into one folder."""
    orders = table(spark, sf_dir, "orders")
    load = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in PRIORITIES]), F.col("o_orderpriority")), F.lit(0)), F.lit(len(PRIORITIES)))
    rows = orders.select(F.when(~F.col("o_orderstatus").eqNullSafe(F.lit("P")), F.col("o_orderkey")).alias("Order_id"), "o_orderstatus", load.alias("n"))
    root = scratch_path(spark, "recovery")
    for n in range(1, len(PRIORITIES) + 1):
        rows.write.parquet(f"{root}/attempts/{n:08d}-broken/rows")
        increments.load_increment(rows.where(F.col("n") <= n), root, "Order_id")
    read = increments.loaded_rows(spark, root).groupBy(F.col("_load").alias("version")).agg(F.count("*").alias("n_read"))
    return increments.load_log(spark, root).join(read, "version", "left")


@register("q_id_history", f"{_HIST_SQL} UNION {_NEW_SQL}")
def q_id_history(spark, sf_dir):
    """The id history after a load: previous ids plus the batch's, each once;
    written as a new version and read back."""
    root, v1, batch = _history_case(spark, sf_dir)
    v2 = write_history(update_history(read_history(spark, v1, "Order_id"), batch, "Order_id"), root, 2)
    return spark.read.parquet(v2)


@register("q_new_ids", f"{_NEW_SQL} EXCEPT {_HIST_SQL}")
def q_new_ids(spark, sf_dir):
    """Ids of a batch not yet in the history (left anti join)."""
    _, v1, batch = _history_case(spark, sf_dir)
    return new_ids(batch.select("Order_id"), read_history(spark, v1, "Order_id"), "Order_id")


@register(
    "q_dedupe_first",
    """
SELECT doc_id, lang, n_chars FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)
""",
)
def q_dedupe_first(spark, sf_dir):
    """First document (lowest id) of every distinct whole text."""
    docs = table(spark, sf_dir, "documents")
    return dedupe_first(docs, ["text"], "doc_id", columns=["doc_id", "lang", "n_chars"])


@register(
    "q_bundles_to_csv",
    "SELECT CAST(id AS VARCHAR) AS id"
    + "".join(
        f', CAST("lines.{i}.{f}" AS VARCHAR) AS "lines.{i}.{f}"' for i in range(INDEXED_WIDTH) for f in ("linenumber", "partkey")
    )
    + """ FROM (
SELECT o.o_orderkey AS id"""
    + "".join(
        f', max(CASE WHEN l.rn = {i + 1} THEN l.{src} END) AS "lines.{i}.{f}"'
        for i in range(INDEXED_WIDTH)
        for f, src in (("linenumber", "l_linenumber"), ("partkey", "l_partkey"))
    )
    + """
FROM orders o LEFT JOIN (
  SELECT l_orderkey, l_linenumber, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS rn
  FROM lineitem) l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey)""",
)
def q_bundles_to_csv(spark, sf_dir):
    """Nested records → JSON lines → read back with every value as text →
    indexed flatten to the stated width → header CSV → read back."""
    recs = ordered_records(spark, sf_dir, ["linenumber", "partkey", "suppkey", "quantity"], ["linenumber", "partkey"])
    nd = write_ndjson(recs, scratch_path(spark, "orders-ndjson"))
    back = read_ndjson(spark, nd, schema="id string, first bigint, lines array<struct<linenumber: string, partkey: string>>")
    wide, _ = spread_positions(back, "lines", INDEXED_WIDTH, first="first")
    out = write_csv(wide, scratch_path(spark, "orders-csv"))
    return read_csv(spark, out)


@register(
    "q_sql_target_rows",
    """
SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
       coalesce(CAST(l.l_linenumber AS VARCHAR), 'NULL') AS "lines.0.linenumber",
       coalesce(CAST(l.l_partkey AS VARCHAR), 'NULL') AS "lines.0.partkey"
FROM orders o LEFT JOIN (
  SELECT l_orderkey, l_linenumber, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS rn
  FROM lineitem) l ON l.l_orderkey = o.o_orderkey AND l.rn = 1
""",
)
def q_sql_target_rows(spark, sf_dir):
    """The three-column load of a SQL target: three dotted columns of an
    indexed flat, conformed to the target's column list and printed with
    NULLs spelled out (what a fetch loop prints). The target has position 0
    only: each order's first line is a minimum, which combines map-side."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.min(line).alias("first"))
    lines = F.array(F.struct(F.col("first.l_linenumber").alias("linenumber"), F.col("first.l_partkey").alias("partkey")))
    recs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).join(first, "id", "left")
    recs = recs.select("id", F.when(F.col("first").isNotNull(), lines).alias("lines"))
    return null_render(conform(flatten(recs, mode="indexed", widths={"lines": 1}), SQL_TARGET_ROWS))


# Target columns of the three-column load for the order flat.
SQL_TARGET_ROWS = ["id", "lines.0.linenumber", "lines.0.partkey"]


_CUSTOMERS = "customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"
_ORDERS = "orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"


@register("q_patient_conform", flat_sql(PATIENT, PATIENT_COLUMNS, explode_name, _CUSTOMERS))
def q_patient_conform(spark, sf_dir):
    """Patient-shaped nested records that fill all 50 declared columns, two
    identifiers each, derived from customers, flattened with the ``Patient``
    prefix and conformed to the declared all-text patient schema."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return conform(flatten(rows.selectExpr(*record_columns(PATIENT)), prefix="Patient"), PATIENT_COLUMNS)


@register("q_encounter_conform", flat_sql(ENCOUNTER, ENCOUNTER_COLUMNS, indexed_name, _ORDERS))
def q_encounter_conform(spark, sf_dir):
    """Encounter-shaped nested records that fill all 29 declared columns, derived
    from orders, flattened to positional columns (``participant.0.period.end``)
    and conformed to the declared all-text encounter schema."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    records = rows.selectExpr(*record_columns(ENCOUNTER))
    return conform(flatten(records, mode="indexed", widths=widths(ENCOUNTER)), ENCOUNTER_COLUMNS)


_POSITION_FIELDS = ("linenumber", "partkey", "returnflag")


@register(
    "q_indexed_overflow",
    """
WITH l AS (
  SELECT l_orderkey AS id, l_linenumber, l_partkey, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) - 1 AS i
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))
"""
    + " UNION ALL ".join(
        f"SELECT id, 'lines.{f}' AS path, CAST(i AS BIGINT) AS index, CAST(l_{f} AS VARCHAR) AS value FROM l WHERE l_{f} IS NOT NULL" for f in _POSITION_FIELDS
    ),
)
def q_indexed_overflow(spark, sf_dir):
    """The indexed layout in two tables: positional columns for the width that
    99 % of the orders need, an overflow table for all positions beyond; both
    written, read back and put together, every value with its place."""
    recs = ordered_records(spark, sf_dir, ["linenumber", "partkey", "suppkey", "quantity"], list(_POSITION_FIELDS))
    recs = land(recs, "ordered-records")
    wide, overflow = spread_positions(recs, "lines", usual_width(recs, "lines"), first="first")
    return long_positions(land(wide, "positions-wide"), land(overflow, "positions-overflow"), "lines")


def land(df, name):
    """``df`` written below the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
