import pytest

from conftest import SF001
from nestfold.operators.history import dedupe_first, new_ids, read_history, update_history, write_history
from nestfold.operators.profile import leaf_paths, profile
from nestfold.operators.union import conform, extra_columns, schema_diff, schema_equal, union_drift
from nestfold.plans.declared import ENCOUNTER_COLUMNS, PATIENT_COLUMNS, SQL_TARGET_COLUMNS


def _set(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_union_drift_is_order_independent_and_fills_nulls(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.5)], "id int, b double")
    c = spark.createDataFrame([(3, "y", 1.0)], "id int, a string, b double")
    u1, u2 = union_drift([a, b, c]), union_drift([c, b, a])
    assert sorted(u1.columns) == ["a", "b", "id"]
    want = sorted([("x", None, 1), (None, 3.5, 2), ("y", 1.0, 3)], key=repr)
    assert _set(u1) == _set(u2) == want


def test_union_drift_type_conflict_casts_to_text(spark):
    a = spark.createDataFrame([(1, 7)], "id int, v int")
    b = spark.createDataFrame([(2, "z")], "id int, v string")
    assert _set(union_drift([a, b]), ["id", "v"]) == [(1, "7"), (2, "z")]


def test_schema_diff_and_equal(spark):
    a = spark.createDataFrame([], "k bigint, x int, y string")
    b = spark.createDataFrame([], "k bigint, x string, z string")
    rows = {r.column_name: (r.type_a, r.type_b, r.status) for r in schema_diff(spark, a, b).collect()}
    assert rows == {
        "k": ("bigint", "bigint", "same"),
        "x": ("int", "string", "type"),
        "y": ("string", None, "only_a"),
        "z": (None, "string", "only_b"),
    }
    assert schema_equal(a, a) and not schema_equal(a, b)


def test_conform_to_declared_columns(spark):
    df = spark.createDataFrame([(1, "in", "extra")], "`class.code` int, id string, other string")
    out = conform(df, SQL_TARGET_COLUMNS)
    assert out.columns == SQL_TARGET_COLUMNS
    assert tuple(out.first()) == ("1", None, "in")
    assert extra_columns(df, SQL_TARGET_COLUMNS) == ["other"]
    assert len(PATIENT_COLUMNS) == 50 and len(set(PATIENT_COLUMNS)) == 50
    assert len(ENCOUNTER_COLUMNS) == 29 and ENCOUNTER_COLUMNS[-1] == "type.0.text"


def test_history_update_is_idempotent(spark, workdir):
    hist = read_history(spark, None, "Order_id")
    batch = spark.createDataFrame([(1,), (2,), (2,)], "Order_id bigint")
    v1 = write_history(update_history(hist, batch, "Order_id"), workdir, 1)
    again = update_history(spark.read.parquet(v1), batch, "Order_id")
    assert _set(again) == [(1,), (2,)]
    more = spark.createDataFrame([(2,), (3,)], "Order_id bigint")
    assert _set(new_ids(more, spark.read.parquet(v1), "Order_id")) == [(3,)]
    with pytest.raises(Exception):
        write_history(again, workdir, 1)  # a version is never overwritten


def test_dedupe_first_digest_equals_exact(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    a = dedupe_first(docs, ["text"], "doc_id", columns=["doc_id"])
    b = dedupe_first(docs, ["text"], "doc_id", columns=["doc_id"], digest=False)
    assert _set(a) == _set(b)
    assert a.count() == docs.select("text").distinct().count()


def test_profile_and_paths(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, s string")
    rows = {r.column_name: (r.data_type, r.n_rows, r.n_non_null) for r in profile(df).collect()}
    assert rows == {"id": ("int", 2, 2), "s": ("string", 2, 1)}
    nested = spark.createDataFrame([], "a array<struct<b: int, c: array<string>>>, m struct<n: double>")
    assert leaf_paths(nested.schema) == [
        ("a", "array", "array<struct<b:int,c:array<string>>>"),
        ("a[]", "struct", "struct"),
        ("a[].b", "scalar", "int"),
        ("a[].c", "array", "array<string>"),
        ("a[].c[]", "scalar", "string"),
        ("m", "struct", "struct"),
        ("m.n", "scalar", "double"),
    ]
