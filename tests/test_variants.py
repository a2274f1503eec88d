"""Schemas and paths found from JSON records, counted writes, streams whose
schemas grow."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestfold.functions.variants import infer_schemas, path_catalogue, struct_of
from nestfold.operators.counted import write_counted
from nestfold.session import scratch_path
from nestfold.streaming.evolving import read_type, register_types, registry, stream_evolving


def _texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "t string")


def test_catalogue_shows_every_kind_of_a_path(spark):
    rows = ['{"a":1,"b":[1,"x",null,{"c":true}]}', '{"a":"s","b":[]}', '{"a":{"d":1.5}}', '{"a":null}', "[1,[2]]", "oops{", None, '"top"']
    got = {(r.path, r.kind): r.n for r in path_catalogue(_texts(spark, rows), "t").collect()}
    assert got == {
        ("", "object"): 4, ("", "array"): 1, ("", "string"): 1, ("", "invalid"): 1,
        ("a", "bigint"): 1, ("a", "string"): 1, ("a", "object"): 1, ("a", "null"): 1, ("a.d", "decimal"): 1,
        ("b", "array"): 2, ("b[]", "bigint"): 1, ("b[]", "string"): 1, ("b[]", "null"): 1, ("b[]", "object"): 1, ("b[].c", "boolean"): 1,
        ("[]", "bigint"): 1, ("[]", "array"): 1, ("[][]", "bigint"): 1,
    }


def test_catalogue_of_nothing_and_of_deep_records(spark):
    assert path_catalogue(_texts(spark, [None]), "t").count() == 0
    with pytest.raises(ValueError, match="deeper"):
        path_catalogue(_texts(spark, ["[" * 9 + "]" * 9]), "t", max_depth=3).count()


@pytest.mark.parametrize(
    "variant,spark_type",
    [
        ("OBJECT<a: BIGINT, `b c`: ARRAY<OBJECT<x: DECIMAL(3,1)>>>", "struct<a:bigint,b c:array<struct<x:double>>>"),
        ("OBJECT<a: OBJECT<>, b: ARRAY<OBJECT<>>>", None),
        ("OBJECT<a: VOID, b: VARIANT, c: BOOLEAN>", "struct<a:string,b:string,c:boolean>"),
    ],
)
def test_variant_schemas_as_types(variant, spark_type):
    got = struct_of(variant)
    assert (got.simpleString() if got else None) == spark_type


def test_schemas_of_all_types_in_one_scan(spark, workdir):
    rows = [("A", '{"x":1,"y":{"z":"q"}}'), ("A", '{"x":2.5,"w":[true]}'), ("B", '{"x":"s"}'), ("B", '{"x":4}'), (None, '{"k":{}}'), ("C", "no json")]
    spark.createDataFrame(rows, "k string, t string").write.parquet(workdir)
    got = infer_schemas(spark.read.parquet(workdir), "t", "k")
    assert {k: sorted((f.name, f.dataType.simpleString()) for f in s.fields) for k, s in got.items()} == {
        "A": [("w", "array<boolean>"), ("x", "double"), ("y", "struct<z:string>")], "B": [("x", "string")], None: [], "C": [],
    }


def test_tables_per_type_need_one_inference_scan(spark, workdir, monkeypatch):
    from nestfold.sinks import writers

    calls = []
    real = writers.infer_schemas
    monkeypatch.setattr(writers, "infer_schemas", lambda *a: calls.append(a) or real(*a))
    e = spark.createDataFrame([(f"b{i}", f"T{i}", json.dumps({"id": str(i), "v": i})) for i in range(6)], "bundle_id string, res_name string, res_data string")
    paths = writers.write_by_type(e, workdir)
    assert len(paths) == 6 and len(calls) == 1
    assert calls[0][0]._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert spark.read.parquet(paths["T3"]).collect()[0].T3_v == 3


def test_counts_are_those_of_the_write_itself(spark, workdir):
    ran = spark.sparkContext.accumulator(0)
    src = scratch_path(spark, "src")
    spark.range(1000).write.parquet(src)
    df = spark.read.parquet(src).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("id")))
    good, bad, n = write_counted(df, workdir, F.col("v") > 4, {"total": F.sum("v")})
    assert n == {"n_rows": 1000, "n_good": 896, "n_rejected": 104, "total": sum(i for i in range(1000) if i % 10)}
    assert good.count() == 896 and bad.count() == 104 and good.columns == ["id", "v"] and ran.value == 0


def _bundle(spark, landing, *resources):
    entries = [{"request": {"url": u} if u else None, "resource": r} for u, r in resources]
    text = json.dumps({"resourceType": "Bundle", "id": f"b{resources[0][1].get('id', 0)}", "entry": entries})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(landing)


def test_stream_learns_types_and_fields_between_restarts(spark):
    landing, root, ckpt = (scratch_path(spark, n) for n in ("ev-in", "ev", "ev-ckpt"))
    run = lambda: stream_evolving(spark, landing, root, ckpt).awaitTermination()
    register_types(spark, root, {"Ghost": T.StructType().add("g", "string")})
    _bundle(spark, landing, ("Patient", {"id": 1, "n": 5}), ("Visit", {"id": 1}))
    run()
    version, types = registry(spark, root)
    assert version == 2 and sorted(types) == ["Ghost", "Patient", "Visit"]
    run()  # nothing new
    assert registry(spark, root)[0] == 2
    _bundle(spark, landing, ("Patient", {"id": 2, "n": "many", "tags": ["a", "b"]}), (None, {"id": 2}))
    _bundle(spark, landing, ("Patient", {"id": 3, "n": 7.5}))
    run()
    rows = read_type(spark, root, "Patient")
    assert sorted((r.Patient_id, r.Patient_n, r.Patient_tags) for r in rows.collect()) == [(1, "5", None), (2, "many", "a"), (2, "many", "b"), (3, "7.5", None)]
    assert read_type(spark, root, "Patient", version=2).columns == ["_bundle_id", "Patient_id", "Patient_n"]
    assert [r.untyped_id for r in read_type(spark, root, None).collect()] == [2]
    ghost = read_type(spark, root, "Ghost")  # a type without rows
    assert ghost.columns == ["_bundle_id", "Ghost_g"] and ghost.count() == 0
    with pytest.raises(KeyError):
        read_type(spark, root, "Nobody")


def test_a_replayed_batch_adds_nothing(spark, workdir):
    landing, root = scratch_path(spark, "ev-in"), workdir
    _bundle(spark, landing, ("P", {"id": 1}))
    for _ in range(2):  # the second run has lost its checkpoint and replays batch 0
        stream_evolving(spark, landing, root, scratch_path(spark, "ckpt")).awaitTermination()
    assert read_type(spark, root, "P").count() == 1 and registry(spark, root)[0] == 1
