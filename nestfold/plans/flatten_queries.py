"""Queries over nested records: explode and indexed flattening, fan-out,
array widths, union of flats."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestfold.operators.flatten import array_widths, fanout, flatten
from nestfold.operators.positions import spread_positions
from nestfold.plans.records import customer_records, landed_orders, order_records, ordered_records
from nestfold.plans.registry import register

_LINES_LEFT = """
FROM orders o
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT DISTINCT l_orderkey, l_returnflag AS flag FROM lineitem) f ON f.l_orderkey = o.o_orderkey
"""

_CROSS_COLS = """
SELECT o.o_orderkey AS Order_id, 'Order' AS Order_resourceType, o.o_orderstatus AS Order_status,
       o.o_totalprice AS Order_totalprice,
       l.l_linenumber AS Order_lines_linenumber, l.l_quantity AS Order_lines_quantity,
       l.l_partkey AS Order_lines_partkey, l.l_returnflag AS Order_lines_returnflag,
       f.flag AS Order_flags
"""


def _cross_records(spark, sf_dir):
    recs = landed_orders(spark, sf_dir, line_fields=["linenumber", "quantity", "partkey", "returnflag"])
    return recs.select("id", "resourceType", "status", "totalprice", "lines", "flags")


@register("q_flatten_cross", _CROSS_COLS + _LINES_LEFT)
def q_flatten_cross(spark, sf_dir):
    """Sibling arrays (lines, flags) multiply rows within a record; empty
    arrays keep the record as one row of nulls."""
    return flatten(_cross_records(spark, sf_dir), prefix="Order")


@register(
    "q_const_key_join",
    _CROSS_COLS
    + """
FROM orders o
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN (SELECT DISTINCT l_orderkey, l_returnflag AS flag FROM lineitem) f ON f.l_orderkey = o.o_orderkey
""",
)
def q_const_key_join(spark, sf_dir):
    """The inner form of the per-record sub-table merge: every (line, flag)
    pair of a record; records with an empty side drop out. Expressed as two
    inner generators on the same row, so no join or shuffle is planned."""
    return flatten(_cross_records(spark, sf_dir), prefix="Order", outer=False)


@register(
    "q_flatten_struct",
    """
SELECT c.c_custkey AS Customer_id, 'Customer' AS Customer_resourceType, c.c_name AS Customer_name,
       c.c_acctbal AS Customer_acctbal, c.c_mktsegment AS Customer_segment,
       n.n_nationkey AS Customer_nation_key, n.n_name AS Customer_nation_name,
       r.r_regionkey AS Customer_nation_region_key, r.r_name AS Customer_nation_region_name
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""",
)
def q_flatten_struct(spark, sf_dir):
    """Nested structs become path-prefixed columns (``parent_child``)."""
    return flatten(customer_records(spark, sf_dir), prefix="Customer")


@register(
    "q_flatten_array_struct",
    """
SELECT o.o_orderkey AS Order_id, l.l_linenumber AS Order_lines_linenumber,
       l.l_quantity AS Order_lines_quantity, l.l_partkey AS Order_lines_partkey,
       l.l_suppkey AS Order_lines_suppkey, strftime(l.l_shipdate, '%Y-%m-%d') AS Order_lines_shipdate
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""",
)
def q_flatten_array_struct(spark, sf_dir):
    """Array of objects: one row per element, the element's fields as columns."""
    recs = landed_orders(
        spark, sf_dir, flags=False, line_fields=["linenumber", "quantity", "partkey", "suppkey", "shipdate"]
    )
    return flatten(recs.select("id", "lines"), prefix="Order")


@register(
    "q_flatten_array_scalar",
    """
SELECT o.o_orderkey AS Order_id, f.flag AS Order_flags
FROM orders o
LEFT JOIN (SELECT DISTINCT l_orderkey, l_returnflag AS flag FROM lineitem) f ON f.l_orderkey = o.o_orderkey
""",
)
def q_flatten_array_scalar(spark, sf_dir):
    """Array of scalars: one row per element (a one-element array is one row)."""
    recs = order_records(spark, sf_dir, lines=False, flags=True)
    return flatten(recs.select("id", "flags"), prefix="Order")


# Positions that the SQL of the wide tables names.
INDEXED_WIDTH = 13


def _indexed_sql(width: int) -> str:
    cols = []
    for i in range(width):
        for f, src in (("linenumber", "l_linenumber"), ("quantity", "l_quantity")):
            cols.append(f'max(CASE WHEN l.rn = {i + 1} THEN l.{src} END) AS "lines.{i}.{f}"')
    return (
        "SELECT o.o_orderkey AS id, "
        + ", ".join(cols)
        + """
FROM orders o LEFT JOIN (
  SELECT l_orderkey, l_linenumber, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_quantity, l_partkey, l_suppkey, l_shipdate) AS rn
  FROM lineitem) l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey"""
    )


@register("q_flatten_indexed", _indexed_sql(INDEXED_WIDTH))
def q_flatten_indexed(spark, sf_dir):
    """Arrays spread to positional columns ``lines.<i>.<field>``, one row per
    record, for the first ``INDEXED_WIDTH`` positions. What an order has beyond
    is in the overflow table (``q_indexed_overflow``)."""
    recs = ordered_records(spark, sf_dir, ["linenumber", "quantity", "partkey", "suppkey"], ["linenumber", "quantity"])
    return spread_positions(recs, "lines", INDEXED_WIDTH, first="first")[0]


@register(
    "q_flatten_union",
    """
SELECT o_orderkey AS id, 'Order' AS resourceType, o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS orderdate, o_orderpriority AS priority
FROM orders
UNION ALL BY NAME
SELECT c.c_custkey AS id, 'Customer' AS resourceType, c.c_name AS name, c.c_acctbal AS acctbal, c.c_mktsegment AS segment,
       n.n_nationkey AS nation_key, n.n_name AS nation_name,
       r.r_regionkey AS nation_region_key, r.r_name AS nation_region_name
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""",
)
def q_flatten_union(spark, sf_dir):
    """Flats of two record types stacked by column name; columns a type lacks
    are null."""
    from nestfold.operators.union import union_drift

    o = flatten(order_records(spark, sf_dir, lines=False, flags=False).drop("page"))
    c = flatten(customer_records(spark, sf_dir))
    return union_drift([o, c])


@register(
    "q_array_widths",
    """
SELECT 'lines' AS path, CAST(max(n) AS INTEGER) AS max_width
FROM (SELECT o.o_orderkey, count(l.l_orderkey) AS n FROM orders o
      LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey)
UNION ALL
SELECT 'flags', CAST(max(n) AS INTEGER)
FROM (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY l_orderkey)
""",
)
def q_array_widths(spark, sf_dir):
    """Largest array size per path (the indexed layout's positions)."""
    recs = landed_orders(spark, sf_dir, line_fields=["linenumber"])
    return array_widths(recs.select("id", "lines", "flags"), key="id", paged=("lines",))


@register(
    "q_fanout",
    """
SELECT o.o_orderkey AS id,
       CAST(greatest(coalesce(lc.n, 0), 1) * greatest(coalesce(fc.n, 0), 1) AS BIGINT) AS n_rows
FROM orders o
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) lc ON lc.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY l_orderkey) fc
       ON fc.l_orderkey = o.o_orderkey
""",
)
def q_fanout(spark, sf_dir):
    """Rows each record yields when exploded, computed per record without
    exploding (product over sibling arrays, empty counts as one)."""
    recs = landed_orders(spark, sf_dir, line_fields=["linenumber"])
    per_record = fanout(recs.select("id", "lines", "flags")).select("id", "n_rows")
    # an order split into pages is several records; its total is their sum
    return per_record.groupBy("id").agg(F.sum("n_rows").alias("n_rows"))
