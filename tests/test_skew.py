"""One order owning a third of ``lineitem``: the nested-record builders must
keep every line, keep arrays bounded and spread the hot order's pages."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from nestfold.operators.flatten import flatten
from nestfold.plans.records import order_records


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed-sf"))
    for t in ("orders", "customer", "nation", "region"):
        shutil.copy(f"{SF01}/{t}.parquet", os.path.join(d, f"{t}.parquet"))
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    hot = F.when(F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0, F.lit(7)).otherwise(
        F.col("l_orderkey")
    )
    li.withColumn("l_orderkey", hot.cast("bigint")).coalesce(1).write.parquet(os.path.join(d, "lineitem.parquet"))
    return d


def test_hot_order_is_paged_and_whole(spark, skewed_dir):
    li = spark.read.parquet(f"{skewed_dir}/lineitem.parquet")
    n_hot = li.where("l_orderkey = 7").count()
    assert n_hot > li.count() / 4  # about a third of all lines
    recs = order_records(spark, skewed_dir, flags=False, line_fields=["linenumber", "partkey"], max_lines=1000)
    sizes = recs.where("id = 7").select(F.size("lines").alias("n")).collect()
    assert len(sizes) >= n_hot // 1000  # split into pages
    assert max(r.n for r in sizes) < 1500  # each page about max_lines
    assert sum(r.n for r in sizes) == n_hot  # nothing dropped
    flat = flatten(recs.select("id", "lines"), prefix="Order")
    assert flat.where("Order_lines_linenumber IS NOT NULL").count() == li.count()


def test_hot_order_pages_are_aggregated_in_many_tasks(spark, skewed_dir):
    from nestfold.plans.records import paged_lines

    li = spark.read.parquet(f"{skewed_dir}/lineitem.parquet")
    counts = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    pages = paged_lines(li, counts, 1000, F.col("l_linenumber"))
    recs = order_records(spark, skewed_dir, flags=False, line_fields=["linenumber"])
    # at this size AQE would merge all reduce partitions into one; look at the
    # shuffle's own partitioning instead
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = pages.where("l_orderkey = 7").select(F.spark_partition_id().alias("p")).distinct().count()
        # the hot order's records keep that spread after the order fields are attached
        final = recs.where("id = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spread > 1 and final > 1


def test_hot_order_bundles_are_paged_and_whole(spark, skewed_dir):
    from nestfold.operators.entries import explode_entries
    from nestfold.plans.records import bundle_texts
    from nestfold.sources.bundles import parse_bundles

    b = bundle_texts(spark, skewed_dir)
    hot = b.where("order_id = 7")
    n_hot = spark.read.parquet(f"{skewed_dir}/lineitem.parquet").where("l_orderkey = 7").count()
    assert hot.count() >= n_hot // 1000
    e = explode_entries(parse_bundles(b.select("value")))
    per_bundle = e.where("res_name = 'Line'").groupBy("bundle_id", "page").count()
    assert per_bundle.agg(F.max("count")).first()[0] < 1500
    assert e.where("res_name = 'Line'").count() == spark.read.parquet(f"{skewed_dir}/lineitem.parquet").count()
    assert e.where("res_name = 'Order'").count() == spark.read.parquet(f"{skewed_dir}/orders.parquet").count()


@pytest.fixture(scope="module", params=["third", "equal"])
def hot_dir(request, spark, tmp_path_factory):
    """sf0.001 with one order owning a third of the lines, or 2,500 equal lines."""
    from conftest import SF001
    from nestfold.sources.tables import TABLES

    d = str(tmp_path_factory.mktemp(f"hot-{request.param}"))
    for t in TABLES:
        if t != "lineitem":
            shutil.copy(f"{SF001}/{t}.parquet", os.path.join(d, f"{t}.parquet"))
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    if request.param == "third":
        key = F.when(F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("l_orderkey"))
        li = li.withColumn("l_orderkey", key.cast("bigint"))
    else:
        one = li.where("l_orderkey = 7").limit(1)
        li = li.unionByName(one.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(2500)))).drop("_n"))
    import pyarrow.parquet as pq

    pq.write_table(li.toArrow(), os.path.join(d, "lineitem.parquet"))
    return d


def _oracles():
    from nestfold.plans import ORACLES

    return sorted(ORACLES)


@pytest.mark.parametrize("name", _oracles())
def test_every_oracle_holds_under_skew(spark, hot_dir, name):
    from nestfold.plans import ORACLES, QUERIES
    from nestfold.testing import compare, duckdb_conn

    if "lineitem" not in ORACLES[name]:
        pytest.skip("does not read the skewed table")
    ok, msg = compare(QUERIES[name](spark, hot_dir), duckdb_conn(hot_dir), ORACLES[name])
    assert ok, msg


def test_equal_lines_spread_over_pages(spark, hot_dir):
    recs = order_records(spark, hot_dir, flags=False, line_fields=["linenumber"])
    assert recs.agg(F.max(F.size("lines"))).first()[0] < 1500


def test_ordered_pages_are_full_and_in_order(spark, hot_dir):
    from nestfold.plans.records import ordered_records

    li = spark.read.parquet(f"{hot_dir}/lineitem.parquet")
    recs = ordered_records(spark, hot_dir, ["linenumber", "partkey"], ["linenumber", "partkey"], max_lines=100)
    assert recs.agg(F.sum(F.size("lines"))).first()[0] == li.count()
    hot = recs.where("id = 7").orderBy("first").collect()
    n = li.where("l_orderkey = 7").count()
    assert [r["first"] for r in hot] == list(range(0, n, 100)) and all(len(r["lines"]) == 100 for r in hot[:-1])
    lines = [(x["linenumber"], x["partkey"]) for r in hot for x in r["lines"]]
    assert lines == sorted(lines)
