"""Plan guards over every registered query: no cross products or nested-loop
joins, no Python evaluation, and the aggregations that must combine map-side
do."""

import pytest

from conftest import SF001
from nestfold.plans import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_product_or_python_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_dedupe_shuffles_digests_and_combines_map_side(spark):
    plan = _plan(QUERIES["q_dedupe_first"](spark, SF001))
    assert "sha2" in plan and "partial_min_by" in plan


def test_flatten_adds_no_shuffle(spark):
    from nestfold.operators.flatten import flatten
    from nestfold.plans.records import order_records

    recs = order_records(spark, SF001, line_fields=["linenumber"]).select("id", "lines", "flags")
    before = _plan(recs).count("Exchange")
    after = _plan(flatten(recs, prefix="Order")).count("Exchange")
    assert after == before


def test_bundle_texts_are_parsed_once(spark):
    for name in ("q_split_by_type", "q_bundle_typed", "q_bundle_files"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert "from_json" not in plan and plan.count("FileScan json") == 1, name


def test_sql_target_needs_no_measuring_pass(spark):
    from nestfold.operators import flatten as module

    calls = []
    real = module._agg_first
    module._agg_first = lambda df, exprs: calls.append(exprs) or real(df, exprs)
    try:
        for name in ("q_sql_target_rows", "q_encounter_conform"):
            QUERIES[name](spark, SF001)
    finally:
        module._agg_first = real
    assert not calls


def test_settings_of_the_caller_stay(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12345")
    try:
        df = QUERIES["q_flatten_struct"](spark, SF001)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
        assert df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_flatten_queries_read_landed_records(spark):
    for name in ("q_flatten_cross", "q_flatten_array_struct", "q_fanout", "q_null_render"):
        assert "lineitem" not in _plan(QUERIES[name](spark, SF001)), name
