import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import bf_explode, bf_indexed, ndjson, patients
from nestfold.operators.flatten import array_widths, fanout, flatten
from nestfold.plans.declared import PATIENT_COLUMNS


def _read(spark, localdir, records, name="p.json", **opts):
    path = os.path.join(localdir, name)
    with open(path, "w") as f:
        f.write(ndjson(records))
    r = spark.read
    for k, v in opts.items():
        r = r.option(k, v)
    return r.json(path)


def _multiset(rows, cols):
    return Counter(tuple(r.get(c) for c in cols) for r in rows)


def test_explode_patient_columns_are_the_declared_fifty(spark, localdir):
    df = _read(spark, localdir, patients(), primitivesAsString=True)
    flat = flatten(df, prefix="Patient")
    assert sorted(flat.columns) == sorted(PATIENT_COLUMNS)
    assert len(flat.columns) == 50


def test_explode_matches_brute_force_rows(spark, localdir):
    recs = patients()
    df = _read(spark, localdir, recs, primitivesAsString=True)
    flat = flatten(df, prefix="Patient")
    got = [r.asDict() for r in flat.collect()]
    want = [row for rec in recs for row in bf_explode("Patient", rec)]
    assert len(got) == len(want)
    assert _multiset(got, flat.columns) == _multiset(want, flat.columns)


def test_fanout_equals_exploded_rows_per_record(spark, localdir):
    recs = patients()
    df = _read(spark, localdir, recs, primitivesAsString=True)
    per = {r["id"]: r["n_rows"] for r in fanout(df).select("id", "n_rows").collect()}
    for rec in recs:
        assert per[rec["id"]] == len(bf_explode("Patient", rec))


def test_indexed_matches_brute_force_union_header(spark, localdir):
    recs = patients()
    df = _read(spark, localdir, recs, primitivesAsString=True)
    flat = flatten(df, mode="indexed")
    want_rows = [dict(bf_indexed(r)) for r in recs]
    union = {k for r in want_rows for k in r}
    assert set(flat.columns) == union
    got = {r["id"]: r.asDict() for r in flat.collect()}
    for w in want_rows:
        g = got[w["id"]]
        for c in flat.columns:
            assert g[c] == w.get(c), c


def test_indexed_first_record_header_and_order(spark, localdir):
    recs = patients()
    df = _read(spark, localdir, recs, primitivesAsString=True)
    flat = flatten(df, mode="indexed", header="first")
    first = [k for k, _ in bf_indexed(recs[0])]
    assert flat.columns == first  # record order: element 0's fields, then element 1's …
    assert flat.count() == 3
    # keys that only later records have are not in a first-record header
    later = {k for r in recs[1:] for k, _ in bf_indexed(r)} - set(first)
    assert later and not later & set(flat.columns)


def test_empty_and_null_arrays_keep_one_row(spark):
    df = spark.createDataFrame(
        [(1, [], ["a", "b"]), (2, None, ["c"]), (3, [10, 20, 30], [])],
        "id int, xs array<int>, ys array<string>",
    )
    out = flatten(df, prefix="R").orderBy("R_id", "R_xs", "R_ys").collect()
    assert [(r.R_id, r.R_xs, r.R_ys) for r in out] == [
        (1, None, "a"),
        (1, None, "b"),
        (2, None, "c"),
        (3, 10, None),
        (3, 20, None),
        (3, 30, None),
    ]
    inner = flatten(df, prefix="R", outer=False)
    assert inner.count() == 0 + 0 + 0  # every record has an empty side


def test_sibling_arrays_multiply(spark):
    df = spark.createDataFrame([(1, list(range(5)), list(range(9)))], "id int, a array<int>, b array<int>")
    assert flatten(df).count() == 45
    assert fanout(df).first()["n_rows"] == 45


def test_array_of_arrays_and_nested_structs(spark):
    df = spark.createDataFrame(
        [(1, [[1, 2], [3]], {"s": {"t": "x"}})], "id int, aa array<array<int>>, st struct<s: struct<t: string>>"
    )
    flat = flatten(df, prefix="T")
    assert sorted(flat.columns) == ["T_aa", "T_id", "T_st_s_t"]
    assert sorted(r.T_aa for r in flat.collect()) == [1, 2, 3]


def test_name_collision_is_reported_or_suffixed(spark):
    df = spark.createDataFrame([(1, "x", {"b": "y"})], "id int, a_b string, a struct<b: string>")
    with pytest.raises(ValueError):
        flatten(df)
    out = flatten(df, on_collision="suffix")
    assert sorted(out.columns) == ["a_b", "a_b_1", "id"]


def test_dotted_names_survive(spark):
    df = spark.createDataFrame([(1, {"c.d": "v"})], "id int, `a.b` struct<`c.d`: string>")
    out = flatten(df, sep="_")
    assert out.columns == ["id", "a.b_c.d"]
    assert out.first()["a.b_c.d"] == "v"


def test_string_leaves_and_python_booleans(spark):
    df = spark.createDataFrame([(1, True, 2.5), (2, False, None)], "id int, flag boolean, x double")
    out = {r.id: r for r in flatten(df, leaf_type="string", bool_style="python").collect()}
    assert out["1"].flag == "True" and out["2"].flag == "False" and out["1"].x == "2.5" and out["2"].x is None
    js = {r.id: r.flag for r in flatten(df, leaf_type="string").collect()}
    assert js == {"1": "true", "2": "false"}


def test_array_widths_nested(spark, localdir):
    recs = patients()
    df = _read(spark, localdir, recs, primitivesAsString=True)
    widths = {r.path: r.max_width for r in array_widths(df).collect()}
    assert widths["extension"] == max(len(r["extension"]) for r in recs)
    assert widths["extension[].extension"] == max(len(x["extension"]) for r in recs for x in r["extension"])
    assert widths["name"] == max(len(r["name"]) for r in recs)
    assert widths["name[].given"] == max(len(n["given"]) for r in recs for n in r["name"] if "given" in n)
    assert widths["telecom"] == max(len(r["telecom"]) for r in recs)
    assert max(widths.values()) > 1


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "id int, gone string, kept string")
    assert flatten(df, drop_null_columns=True).columns == ["id", "kept"]


def test_indexed_values_keep_json_spelling(spark, localdir):
    df = _read(spark, localdir, [{"id": "x", "v": [1.50, 2, True]}], name="v.json", primitivesAsString=True)
    out = flatten(df, mode="indexed").first().asDict()
    assert out == {"id": "x", "v.0": json.dumps(1.5), "v.1": "2", "v.2": "true"}


def test_flatten_plan_has_no_exchange(spark, localdir):
    df = _read(spark, localdir, patients(), primitivesAsString=True)
    plan = flatten(df, prefix="Patient")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert "Generate" in plan


def test_max_fanout_guard_raises_instead_of_dropping(spark):
    df = spark.createDataFrame([(1, list(range(5)), list(range(9)))], "id int, a array<int>, b array<int>")
    assert flatten(df, max_fanout=45).count() == 45
    with pytest.raises(ValueError, match="45 rows"):
        flatten(df, max_fanout=44)


def test_fanout_of_records_without_arrays_is_not_measured(spark):
    flat, nested = spark.range(10).selectExpr("id", "struct(id AS a) AS s"), spark.range(10).selectExpr("id", "array(id, id) AS s")
    sc = spark.sparkContext
    try:
        sc.setJobGroup("no-arrays", "")
        assert flatten(flat, max_fanout=1).columns == ["id", "s_a"]
        assert len(sc.statusTracker().getJobIdsForGroup("no-arrays")) == 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ValueError, match="explodes to 2 rows"):
        flatten(nested, max_fanout=1)
