import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from fixtures import bf_indexed, ndjson, patients
from nestfold.operators.entries import explode_entries
from nestfold.operators.flatten import flatten
from nestfold.sinks.writers import read_csv, to_json_documents, write_by_type, write_csv
from nestfold.sources.bundles import parse_bundles


def test_json_documents_are_bounded_and_complete(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select(F.col("o_orderkey").alias("id"))
    docs = to_json_documents(orders.repartition(3), "Orders", rows_per_doc=100).collect()
    sizes = [len(json.loads(d.document)["Orders"]) for d in docs]
    assert max(sizes) <= 100
    ids = sorted(r["id"] for d in docs for r in json.loads(d.document)["Orders"])
    assert ids == sorted(r.id for r in orders.collect())


def test_indexed_flat_csv_round_trip_keeps_newlines(spark, localdir, workdir):
    path = os.path.join(localdir, "p.json")
    with open(path, "w") as f:
        f.write(ndjson(patients()))
    flat = flatten(spark.read.option("primitivesAsString", True).json(path), mode="indexed")
    back = read_csv(spark, write_csv(flat, workdir))
    assert back.columns == flat.columns
    got = {r["id"]: r.asDict() for r in back.collect()}
    for rec in patients():
        want = dict(bf_indexed(rec))
        assert {k: v for k, v in got[rec["id"]].items() if v is not None} == want
    assert "\n" in got["p-0001"]["text.div"]


def test_write_by_type_tables(spark, workdir):
    texts = spark.createDataFrame(
        [
            ('{"resourceType":"Bundle","id":"b1","entry":[{"request":{"url":"Patient"},"resource":{"id":"p1","name":[{"given":["A","B"]}]}},'
             '{"request":{"url":"Encounter"},"resource":{"id":"e1","class":{"code":"AMB"}}}]}',),
            ('{"resourceType":"Bundle","id":"b2","entry":[{"request":{"url":"Patient"},"resource":{"id":"p2"}}]}',),
        ],
        "value string",
    )
    paths = write_by_type(explode_entries(parse_bundles(texts)), workdir)
    assert sorted(paths) == ["Encounter", "Patient"]
    pat = spark.read.parquet(paths["Patient"])
    assert sorted(pat.columns) == ["Patient_id", "Patient_name_given", "_bundle_id"]
    assert sorted((r._bundle_id, r.Patient_id, r.Patient_name_given) for r in pat.collect()) == [
        ("b1", "p1", "A"),
        ("b1", "p1", "B"),
        ("b2", "p2", None),
    ]
    enc = spark.read.parquet(paths["Encounter"]).first()
    assert (enc._bundle_id, enc.Encounter_class_code) == ("b1", "AMB")


def test_write_by_type_partitioned_by_bundle(spark, workdir):
    texts = spark.createDataFrame(
        [
            ('{"resourceType":"Bundle","id":"b1","entry":[{"request":{"url":"Patient"},"resource":{"id":"p1"}}]}',),
            ('{"resourceType":"Bundle","id":"b2","entry":[{"request":{"url":"Patient"},"resource":{"id":"p2"}}]}',),
        ],
        "value string",
    )
    paths = write_by_type(explode_entries(parse_bundles(texts)), workdir, partition_by_source=True)
    files = spark.read.parquet(paths["Patient"]).inputFiles()
    assert sorted({f.split("_bundle_id=")[1].split("/")[0] for f in files}) == ["b1", "b2"]
    back = spark.read.parquet(paths["Patient"])
    assert sorted((r._bundle_id, r.Patient_id) for r in back.collect()) == [("b1", "p1"), ("b2", "p2")]


def _entries(spark, rows):
    return spark.createDataFrame(rows, "bundle_id string, res_name string, res_data string")


def test_append_adds_a_load_once_and_keeps_odd_and_missing_types(spark, workdir):
    first = _entries(spark, [("b1", "Patient", '{"id":"p1"}'), ("b1", "urn:x", '{"id":"u1"}'), ("b1", None, '{"id":"n1"}')])
    second = _entries(spark, [("b2", "Patient", '{"id":"p2"}'), ("b2", "a b/c=%", '{"id":"z"}')])
    paths = write_by_type(first, workdir, mode="append")
    paths.update(write_by_type(second, workdir, mode="append"))
    assert sorted(paths) == ["Patient", "a b/c=%", "untyped", "urn:x"]
    read = lambda t: sorted(tuple(r) for r in spark.read.parquet(paths[t]).collect())
    assert read("Patient") == [("b1", "p1"), ("b2", "p2")]
    assert read("urn:x") == [("b1", "u1")] and read("a b/c=%") == [("b2", "z")] and read("untyped") == [("b1", "n1")]


def test_fan_out_guard_of_tables(spark, workdir):
    import pytest

    wide = _entries(spark, [("b", "T", json.dumps({"a": list(range(30)), "b": list(range(40))}))])
    with pytest.raises(ValueError, match="1200 rows"):
        write_by_type(wide, workdir, max_fanout=1000)


def test_csv_keeps_empty_text_and_null_apart(spark, workdir):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "a\nb"), (4, " ")], "id int, t string")
    back = read_csv(spark, write_csv(df, workdir), schema=df.schema)
    assert sorted(tuple(r) for r in back.collect()) == [(1, ""), (2, None), (3, "a\nb"), (4, " ")]


def test_overwrite_removes_tables_of_types_that_are_gone(spark, workdir):
    old = write_by_type(_entries(spark, [("b", "A", '{"id":"1"}'), ("b", "B", '{"id":"2"}')]), workdir)
    new = write_by_type(_entries(spark, [("b", "B", '{"id":"3"}')]), workdir)
    assert [r.B_id for r in spark.read.parquet(new["B"]).collect()] == ["3"]
    from nestfold.session import path_exists

    assert not path_exists(spark, old["A"])


def test_staged_lines_are_compressed_and_counted_as_text(spark, workdir):
    from nestfold.functions.variants import infer_schemas
    from nestfold.sinks.writers import write_types

    rows = [(str(i), "Line" if i % 3 else None, f'{{"id":"{i}","text":"é same words again"}}') for i in range(2000)]
    e = spark.createDataFrame(rows, "bundle_id string, res_name string, res_data string")
    folders = write_types(e, workdir)
    lines = [f'{{"_bundle_id":"{b}","resource":{d}}}' for b, t, d in rows if t]
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{workdir}/{folders['Line']}")
    stored = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    size = sum(len(x.encode()) + 1 for x in lines)
    assert stored < size / 2
    staged = spark.read.schema("value string, res_name string").text(workdir)
    sizes = {}
    infer_schemas(staged, "value", "res_name", sizes)
    assert sizes["Line"] == size
    assert sorted(r["value"] for r in staged.where("res_name = 'Line'").collect()) == sorted(lines)
