"""Nested records and record bundles derived from the driver's tables.

The engine's input is nested JSON: record bundles (an ``entry`` array of
``{request: {url}, resource: {...}}``) and nested records with struct and
array fields. These builders derive both from ``orders`` / ``lineitem`` /
``customer`` / ``nation`` / ``region`` so every query's work grows with the
tables.

Skew: an order may own an arbitrary share of ``lineitem``. Its lines are never
collected into one unbounded array: orders with more than ``max_lines`` lines
are split into pages of about ``max_lines`` (page = hash of the line's place in
its file, so equal lines spread too). Every page keeps the order's id and
carries its ``page`` number; the order's own row is repeated once per page and
joined on (order, page), so no group, record, join key or task holds an
order's full line set, however many such orders there are. Orders at or below
``max_lines`` get exactly one record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from nestfold.operators.numbering import numbered
from nestfold.session import landed, scratch_path
from nestfold.sources.tables import table

MAX_LINES = 1000

# line fields in sort order: ``array_sort`` on the struct orders lines by
# (linenumber, quantity, partkey, suppkey, shipdate), which is unique per order
LINE_STRUCT = [
    ("linenumber", "l_linenumber"),
    ("quantity", "l_quantity"),
    ("partkey", "l_partkey"),
    ("suppkey", "l_suppkey"),
    ("shipdate", None),
    ("extendedprice", "l_extendedprice"),
    ("discount", "l_discount"),
    ("tax", "l_tax"),
    ("returnflag", "l_returnflag"),
    ("linestatus", "l_linestatus"),
]


def _day(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd")


def _line_struct(fields=None):
    keep = [f for f, _ in LINE_STRUCT] if fields is None else fields
    cols = []
    for name, src in LINE_STRUCT:
        if name in keep:
            cols.append((_day("l_shipdate") if src is None else F.col(src)).alias(name))
    return F.struct(*cols)


def order_stats(lineitem: DataFrame) -> DataFrame:
    """One row per order that has lines: line count and its sorted distinct
    return flags. Both aggregate partially before the shuffle, so a hot order
    costs one partial row per task."""
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.array_sort(F.collect_set("l_returnflag")).alias("flags"),
    )


def line_counts(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))


# The hot orders (16 bytes each: key and page count) are counted; up to this
# many bytes they are broadcast to the lines, beyond it joined by a shuffle in
# which AQE splits a hot order's lines.
HOT_ROW_BYTES, HOT_BROADCAST_BYTES = 16, 32 << 20


def page_count(n_lines, max_lines: int):
    """Pages of an order: one, or more above ``max_lines``."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(n_lines, F.lit(0)) / F.lit(max_lines)).cast("int"))


def hot_orders(counts: DataFrame, max_lines: int) -> DataFrame | None:
    """``(l_orderkey, n_pages)`` of the orders with more than ``max_lines`` lines,
    or None without any. Found once and written down, so that lines and orders
    read the few hot ones instead of counting all lines again."""
    path = scratch_path(counts.sparkSession, "hot-orders")
    hot = counts.where(F.col("n_lines") > max_lines).select("l_orderkey", page_count(F.col("n_lines"), max_lines).alias("n_pages"))
    hot.write.parquet(path)
    hot = counts.sparkSession.read.schema(hot.schema).parquet(path)
    n_hot = hot.count()
    if n_hot == 0:
        return None
    return F.broadcast(hot) if n_hot * HOT_ROW_BYTES <= HOT_BROADCAST_BYTES else hot


def with_pages(head: DataFrame, hot: DataFrame | None, key: str) -> DataFrame:
    """One row per order → one per (order, ``page``), with ``n_pages`` of a hot
    order and null of any other. Without a hot order no join is planned."""
    if hot is None:
        return head.withColumn("n_pages", F.lit(None).cast("int")).withColumn("page", F.lit(0))
    head = head.join(hot.withColumnRenamed("l_orderkey", key), key, "left")
    return head.withColumn("page", F.explode(F.sequence(F.lit(0), F.coalesce("n_pages", F.lit(1)) - 1)))


def page_keys(hot: DataFrame | None, key: str) -> list[str]:
    """What tells records apart: the order, and its page once an order has several."""
    return [key] if hot is None else [key, "page"]


def grouped_lines(lineitem: DataFrame, hot: DataFrame | None, value, flags: bool = False) -> DataFrame:
    """``(l_orderkey, [page], items, [flags])``: ``value`` (a per-line column)
    grouped into arrays of about ``max_lines`` elements, by ``page_keys``.

    The raw line columns are shuffled once, by the keys, and sorted there; the
    values are built and listed behind the sort, one order at a time, so a task
    sorts narrow rows only and a join on the same keys neither shuffles nor
    sorts the lists."""
    keys = page_keys(hot, "l_orderkey")
    if hot is not None:
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        lineitem = lineitem.select("*", place.alias("_place")).join(hot, "l_orderkey", "left")
        lineitem = lineitem.withColumn("page", F.when(F.col("n_pages").isNull(), 0).otherwise(F.pmod("_place", "n_pages")).cast("int"))
    rows = lineitem.repartition(*keys).sortWithinPartitions(*keys).select(*keys, value.alias("v"), F.col("l_returnflag").alias("flag"))
    lists = [F.collect_list("v").alias("items")]
    return rows.groupBy(*keys).agg(*lists, *([F.array_sort(F.collect_set("flag")).alias("flags")] if flags else []))


def paged_lines(lineitem: DataFrame, stats: DataFrame, max_lines: int, value) -> DataFrame:
    """``(l_orderkey, page, items)`` of all lines, whatever the largest order
    (``stats``: each order's ``n_lines``)."""
    hot = hot_orders(stats, max_lines)
    out = grouped_lines(lineitem, hot, value)
    return out if hot is not None else out.select("l_orderkey", F.lit(0).alias("page"), "items")


def order_records(
    spark: SparkSession,
    sf_dir: str,
    lines: bool = True,
    flags: bool = True,
    customer: bool = False,
    line_fields=None,
    sort_lines: bool = False,
    extra_null_field: bool = False,
    max_lines: int = MAX_LINES,
) -> DataFrame:
    """Nested order records::

        id, page, resourceType, custkey, status, totalprice, orderdate, priority,
        [customer: {id, name, acctbal, segment, nation: {key, name, region: {key, name}}}],
        [lines: array<struct<linenumber, quantity, partkey, suppkey, shipdate, ...>>],
        [flags: array<string>]   -- the order's distinct return flags

    An order without lines has ``lines = []`` and ``flags = []``.
    """
    orders = table(spark, sf_dir, "orders")
    base = orders.select(
        F.col("o_orderkey").alias("id"),
        F.lit("Order").alias("resourceType"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalprice"),
        _day("o_orderdate").alias("orderdate"),
        F.col("o_orderpriority").alias("priority"),
    )
    if extra_null_field:
        base = base.withColumn("note", F.lit(None).cast("string"))
    if customer:
        cust = customer_records(spark, sf_dir).select(F.col("id").alias("custkey"), F.struct("*").alias("customer"))
        base = base.join(cust, "custkey", "left")
    if not (lines or flags):
        return base.withColumn("page", F.lit(0))
    li = table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL")  # of no order
    empty = F.array().cast("array<string>")
    if not lines:
        stats = order_stats(li).withColumnRenamed("l_orderkey", "id")
        out = base.join(stats, "id", "left").withColumn("page", F.lit(0))
        return out.withColumn("flags", F.coalesce("flags", empty)).drop("n_lines")
    hot = hot_orders(line_counts(li), max_lines)
    keys = page_keys(hot, "id")
    pages = grouped_lines(li, hot, _line_struct(line_fields), flags and hot is None)
    pages = pages.withColumnsRenamed({"l_orderkey": "id", "items": "lines"})
    out = with_pages(base, hot, "id")
    if flags and hot is not None:  # a page has only some of its order's flags
        out = out.join(order_stats(li).select(F.col("l_orderkey").alias("id"), "flags"), "id", "left")
    out = out.join(pages, keys, "left")
    # a page that no line fell on is no record; an order without lines is one
    out = out.where(F.col("lines").isNotNull() | F.col("n_pages").isNull())
    out = out.withColumn("lines", F.coalesce("lines", F.array().cast(pages.schema["lines"].dataType)))
    if sort_lines:
        out = out.withColumn("lines", F.array_sort("lines"))
    if flags:
        out = out.withColumn("flags", F.coalesce("flags", empty))
    rest = [c for c in base.columns if c != "id"]
    return out.select("id", "page", *rest, *(["flags"] if flags else []), "lines")


def ordered_records(spark: SparkSession, sf_dir: str, order: list[str], fields: list[str], max_lines: int = MAX_LINES) -> DataFrame:
    """``id``, ``first``, ``lines``: every order with its lines in ``order`` (then
    by ship date). An order of more than ``max_lines`` lines comes in pages that
    are full but for the last; ``first`` is the number of lines before a page.

    The lines of such orders are numbered by a distributed sort, the others
    sorted in their arrays, so no task or row holds a hot order's lines."""
    li = table(spark, sf_dir, "lineitem")
    counts = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_lines)
    hot = counts.select("l_orderkey")
    n_hot = hot.count()
    small = n_hot * HOT_ROW_BYTES <= HOT_BROADCAST_BYTES
    side = F.broadcast(hot) if small else hot
    source = dict(LINE_STRUCT)
    names = list(dict.fromkeys([*order, "shipdate", *fields]))  # arrays of these structs sort by ``order``
    value = F.struct(*[(_day("l_shipdate") if source[f] is None else F.col(source[f])).alias(f) for f in names])
    rest = li.join(side, "l_orderkey", "left_anti") if n_hot else li
    raw = rest.repartition("l_orderkey").select("l_orderkey", value.alias("v"))
    pages = raw.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("v")).alias("lines")).withColumn("first", F.lit(0).cast("bigint"))
    if n_hot:
        lines = li.select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")).join(side, "l_orderkey", "left_semi")
        lines = lines.select("l_orderkey", value.alias("v"), "f", "r")
        keys = ["l_orderkey", *[F.col(f"v.{f}") for f in (*order, "shipdate")], "f", "r"]
        lines = numbered(lines, keys, "n")
        least = lines.groupBy("l_orderkey").agg(F.min("n").alias("least"))  # one row per hot order
        lines = lines.join(F.broadcast(least) if small else least, "l_orderkey").withColumn("n", F.col("n") - F.col("least"))
        page = F.floor(F.col("n") / max_lines).cast("bigint")
        grouped = lines.groupBy("l_orderkey", page.alias("page")).agg(F.array_sort(F.collect_list(F.struct("n", "v"))).alias("nv"))
        split = grouped.select("l_orderkey", F.transform("nv", lambda x: x["v"]).alias("lines"), (F.col("page") * max_lines).alias("first"))
        pages = pages.unionByName(split)
    keep = F.transform("lines", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    pages = pages.select(F.col("l_orderkey").alias("id"), keep.alias("lines"), "first")
    out = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).join(pages, "id", "left")
    return out.select("id", F.coalesce("first", F.lit(0)).alias("first"), F.coalesce("lines", F.array().cast(pages.schema["lines"].dataType)).alias("lines"))


def landed_orders(spark: SparkSession, sf_dir: str, flags: bool = True, line_fields=None) -> DataFrame:
    """The nested order records, landed once per session as Parquet (as a feed
    of them would be) and read with just the line fields asked for."""
    path = landed(spark, "order-records", (sf_dir,), lambda p: order_records(spark, sf_dir).write.parquet(p))
    out = spark.read.parquet(path)
    if line_fields is not None:
        fields = [f for f in out.schema["lines"].dataType.elementType.fields if f.name in line_fields]
        narrow = [StructField("lines", ArrayType(StructType(fields))) if f.name == "lines" else f for f in out.schema.fields]
        out = spark.read.schema(StructType(narrow)).parquet(path)
    return out if flags else out.drop("flags")


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records with the nation and region nested as structs. The
    dimension joins are left to the planner: nation and region are tiny, so the
    size-checked broadcast threshold applies."""
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey"), F.struct(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")).alias("region")
    )
    nation = (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("n_nationkey"),
            F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("region")).alias("nation"),
        )
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.lit("Customer").alias("resourceType"),
            F.col("c_name").alias("name"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("c_mktsegment").alias("segment"),
            F.col("nation"),
        )
    )


# ------------------------------------------------------------------ bundles


def _entry_json(url: str, resource) -> "F.Column":
    return F.to_json(F.struct(F.struct(F.lit(url).alias("url")).alias("request"), resource.alias("resource")))


def bundle_texts(spark: SparkSession, sf_dir: str, faults: bool = False, max_lines: int = MAX_LINES) -> DataFrame:
    """One JSON bundle text per order page: ``(bundle_id, order_id, page, value)``.
    All pages of an order have its id; pages after the first say so (``page``).

    Entries: the Order resource and its Customer resource (page 0 only; the
    Customer comes first for orders with status 'O') and one Line resource per
    line item. With ``faults=True`` some bundles are damaged the way real feeds
    are: priority ``5-LOW`` bundles are truncated (unparsable), status ``P``
    bundles have a root type other than ``Bundle``, every bundle carries one
    entry without a resource, and page 0 one entry without a request.
    """
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    li = table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL")  # of no order

    order_res = F.struct(
        F.lit("Order").alias("resourceType"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalprice"),
        _day("o_orderdate").alias("orderdate"),
        F.col("o_orderpriority").alias("priority"),
    )
    cust_res = F.struct(
        F.lit("Customer").alias("resourceType"),
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    line_res = F.struct(
        F.lit("Line").alias("resourceType"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedprice"),
        F.col("l_returnflag").alias("returnflag"),
        _day("l_shipdate").alias("shipdate"),
    )
    hot = hot_orders(line_counts(li), max_lines)
    pages = grouped_lines(li, hot, _entry_json("Line", line_res)).withColumnRenamed("l_orderkey", "o_orderkey")
    # the tables' own columns are shuffled; texts are made behind the last join
    head = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    b = with_pages(head, hot, "o_orderkey").join(pages, page_keys(hot, "o_orderkey"), "left")
    # an order without lines keeps one bundle with no line entries
    b = b.where((F.col("page") == 0) | F.col("items").isNotNull()).select(
        F.col("o_orderkey").alias("order_id"),
        "page",
        "o_orderstatus",
        "o_orderpriority",
        _entry_json("Order", order_res).alias("order_entry"),
        F.when(F.col("c_custkey").isNotNull(), _entry_json("Customer", cust_res)).alias("cust_entry"),
        F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("line_entries"),
    )
    first = F.col("page") == 0
    lead = F.when(
        first,
        F.when(
            F.col("o_orderstatus") == "O",
            F.array_compact(F.array(F.col("cust_entry"), F.col("order_entry"))),
        ).otherwise(F.array_compact(F.array(F.col("order_entry"), F.col("cust_entry")))),
    ).otherwise(F.array().cast("array<string>"))
    entries = F.concat(lead, F.array_sort(F.col("line_entries")))
    root_type = F.lit("Bundle")
    if faults:
        no_request = F.concat(
            F.lit('{"resource":{"resourceType":"Note","id":"n'), F.col("order_id").cast("string"), F.lit('"}}')
        )
        entries = F.concat(
            entries,
            F.array(F.lit('{"request":{"url":"Note"}}')),
            F.when(first, F.array(no_request)).otherwise(F.array().cast("array<string>")),
        )
        root_type = F.when(F.col("o_orderstatus") == "P", F.lit("Collection")).otherwise(F.lit("Bundle"))
    bundle_id = F.col("order_id").cast("string")
    text = F.concat(
        F.lit('{"resourceType":"'),
        root_type,
        F.lit('","id":"'),
        bundle_id,
        F.lit('","type":"collection",'),
        F.when(first, F.lit("")).otherwise(F.concat(F.lit('"page":'), F.col("page").cast("string"), F.lit(","))),
        F.lit('"status":"'),
        F.col("o_orderstatus"),
        F.lit('","entry":['),
        F.array_join(entries, ","),
        F.lit("]}"),
    )
    b = b.select(bundle_id.alias("bundle_id"), "order_id", "page", text.alias("value"), "o_orderpriority")
    if faults:
        half = F.substring("value", 1, F.floor(F.length("value") / 2).cast("int"))
        b = b.withColumn("value", F.when(F.col("o_orderpriority") == "5-LOW", half).otherwise(F.col("value")))
    return b.drop("o_orderpriority")
