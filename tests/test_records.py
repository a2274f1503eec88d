from collections import Counter

from pyspark.sql import functions as F

from conftest import SF001
from nestfold.operators.flatten import flatten
from nestfold.plans.records import order_records


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_paging_splits_hot_orders_without_losing_lines(spark):
    fields = ["linenumber", "quantity", "partkey", "suppkey", "shipdate"]
    whole = order_records(spark, SF001, flags=False, line_fields=fields)
    paged = order_records(spark, SF001, flags=False, line_fields=fields, max_lines=2)
    biggest = whole.agg(F.max(F.size("lines"))).first()[0]
    assert paged.agg(F.max(F.size("lines"))).first()[0] < biggest  # hot orders were split
    assert paged.count() > whole.count()  # hot orders became several records
    a = flatten(whole.select("id", "lines"), prefix="Order")
    b = flatten(paged.select("id", "lines"), prefix="Order")
    assert _rows(a) == _rows(b)


def test_paging_keeps_cross_product_per_order(spark):
    whole = order_records(spark, SF001, line_fields=["linenumber", "partkey"])
    paged = order_records(spark, SF001, line_fields=["linenumber", "partkey"], max_lines=3)
    cols = ["id", "lines", "flags"]
    assert _rows(flatten(whole.select(*cols))) == _rows(flatten(paged.select(*cols)))


def test_customer_nesting(spark):
    from nestfold.plans.records import customer_records

    c = customer_records(spark, SF001)
    assert [f.name for f in c.schema["nation"].dataType.fields] == ["key", "name", "region"]
    assert c.where(F.col("nation").isNull()).count() == 0


def test_order_records_plan_has_no_static_broadcast(spark):
    from nestfold.session import tuned

    plan = order_records(tuned(spark), SF001)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastExchange" not in plan


def test_large_hot_set_takes_the_shuffle_path(spark, monkeypatch):
    import nestfold.plans.records as records

    fields = ["linenumber", "quantity", "partkey", "suppkey", "shipdate"]
    whole = order_records(spark, SF001, flags=False, line_fields=fields)
    monkeypatch.setattr(records, "HOT_BROADCAST_BYTES", 0)
    paged = order_records(spark, SF001, flags=False, line_fields=fields, max_lines=2)
    plan = paged._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastExchange" not in plan
    a = flatten(whole.select("id", "lines"), prefix="Order")
    b = flatten(paged.select("id", "lines"), prefix="Order")
    assert _rows(a) == _rows(b)


def test_lines_are_shuffled_and_sorted_once(spark):
    from nestfold.plans.records import bundle_texts
    from nestfold.session import tuned

    for build in (order_records, bundle_texts):
        plan = build(tuned(spark), SF001)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
        assert "ObjectHashAggregate" not in plan  # lists are built behind the sort


def test_shuffle_partitions_follow_the_input(spark, monkeypatch):
    import nestfold.session as session

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert int(session.tuned(spark, SF001).conf.get(session.INITIAL_PARTITIONS)) == least
    monkeypatch.setattr(session, "PARTITION_INPUT_BYTES", 1000)
    assert int(session.tuned(spark, SF001).conf.get(session.INITIAL_PARTITIONS)) > least


def test_lines_of_no_order_form_no_group(spark, localdir):
    """Lines without an order key belong to no record, however many there are."""
    import os

    from nestfold.plans.records import bundle_texts

    for t in ("orders", "customer", "lineitem"):
        os.symlink(f"{SF001}/{t}.parquet", f"{localdir}/{t}.parquet") if t != "lineitem" else None
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    none = li.limit(1500).withColumn("l_orderkey", F.lit(None).cast("bigint"))
    li.unionByName(none).write.parquet(f"{localdir}/lineitem.parquet")
    for build in (order_records, bundle_texts):
        assert build(spark, localdir).count() == build(spark, SF001).count()
