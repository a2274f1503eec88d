"""Type widening and files whose columns drift."""

import datetime as dt
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from nestfold.operators.drift import merged, read_drifting, wider

SCALARS = st.sampled_from(
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(),
     T.TimestampType(), T.TimestampNTZType(), T.DecimalType(10, 2), T.DecimalType(38, 0), T.DecimalType(38, 30), T.DecimalType(5, 5), T.NullType(), T.BinaryType()]
)
TYPES = st.recursive(
    SCALARS,
    lambda t: st.one_of(
        t.map(T.ArrayType),
        st.dictionaries(st.sampled_from("ab"), t, min_size=1, max_size=2).map(lambda d: T.StructType([T.StructField(k, d[k]) for k in sorted(d)])),
    ),
    max_leaves=4,
)


def _sorted(t):
    """Field order is not part of a type's meaning here."""
    if isinstance(t, T.StructType):
        return ("struct", tuple(sorted((f.name, _sorted(f.dataType)) for f in t.fields)))
    if isinstance(t, T.ArrayType):
        return ("array", _sorted(t.elementType))
    return t.simpleString()


@settings(max_examples=400, deadline=None)
@given(TYPES, TYPES, TYPES)
def test_wider_is_a_least_upper_bound(a, b, c):
    assert _sorted(wider(a, a)) == _sorted(a)
    assert _sorted(wider(a, b)) == _sorted(wider(b, a))
    assert _sorted(wider(wider(a, b), c)) == _sorted(wider(a, wider(b, c)))
    assert _sorted(wider(wider(a, b), b)) == _sorted(wider(a, b))


def test_merged_names_meet_by_lower_case():
    a, b = T.StructType().add("Id", "integer").add("x", "string"), T.StructType().add("id", "long").add("y", "date")
    assert merged([a, b]).simpleString() == "struct<Id:bigint,x:string,y:date>"


def test_files_of_all_types_read_as_one(spark, workdir):
    frames = [
        spark.createDataFrame([(1, 5), (2, None)], "id int, v int"),
        spark.createDataFrame([(3, 1 << 40)], "id bigint, V bigint"),
        spark.createDataFrame([(4, "x")], "id int, v string"),
        spark.createDataFrame([(5,)], "id int"),
        spark.createDataFrame([(6, (7, "s"))], "id int, v struct<a: int, b: string>"),
    ]
    for i, f in enumerate(frames):
        f.write.parquet(f"{workdir}/p{i}")
    df = read_drifting(spark, workdir)
    assert df.dtypes == [("id", "bigint"), ("v", "string")]
    assert sorted(tuple(r) for r in df.collect()) == [(1, "5"), (2, None), (3, str(1 << 40)), (4, "x"), (5, None), (6, '{"a":7,"b":"s"}')]


def test_structs_and_arrays_widen_inside(spark, workdir):
    spark.createDataFrame([(1, [(1,)])], "id int, a array<struct<x: int>>").write.parquet(f"{workdir}/p0")
    spark.createDataFrame([(2, [(2.5, "k")]), (3, None)], "id int, a array<struct<x: double, y: string>>").write.parquet(f"{workdir}/p1")
    rows = {r.id: r.a for r in read_drifting(spark, workdir).collect()}
    assert [tuple(x) for x in rows[1]] == [(1.0, None)] and [tuple(x) for x in rows[2]] == [(2.5, "k")] and rows[3] is None


def test_dates_and_times(spark, workdir):
    spark.createDataFrame([(dt.date(2020, 1, 2),)], "d date").write.parquet(f"{workdir}/p0")
    spark.createDataFrame([(dt.datetime(2020, 1, 2, 3),)], "d timestamp_ntz").write.parquet(f"{workdir}/p1")
    assert sorted(r.d for r in read_drifting(spark, workdir).collect()) == [dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 2, 3)]


def test_one_scan_per_schema_not_per_file_and_pruning(spark, workdir):
    for i in range(6):
        kind = "int" if i % 2 else "bigint"
        spark.createDataFrame([(i, i, "t")], f"id {kind}, w int, t string").write.parquet(f"{workdir}/p{i}")
    df = read_drifting(spark, workdir).where("w > 2").select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "GreaterThan(w,2)" in plan
    assert "ReadSchema: struct<id:bigint,w:int>" in plan and "t:string" not in plan
    assert sorted(r.id for r in df.collect()) == [3, 4, 5]


def test_files_of_another_writer(spark, workdir):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    path = workdir.removeprefix("file:")
    os.makedirs(path)
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "v": ["a"]}), f"{path}/one.parquet")
    pq.write_table(pa.table({"id": pa.array([2], pa.int64())}), f"{path}/two.parquet")
    assert sorted(tuple(r) for r in read_drifting(spark, workdir).collect()) == [(1, "a"), (2, None)]


def test_nothing_to_read(spark, workdir):
    from nestfold.session import mark_done

    mark_done(spark, workdir)
    with pytest.raises(ValueError):
        read_drifting(spark, workdir)


def test_order_of_files_makes_no_difference():
    kinds = [T.StructType().add("a", t) for t in ("integer", "decimal(10,2)", "double")]
    assert {merged(list(p)).simpleString() for p in permutations(kinds)} == {"struct<a:double>"}
