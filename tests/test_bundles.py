import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from nestfold.operators.entries import bundle_stats, explode_entries, first_type, out_path, route_key, select_types
from nestfold.plans.records import bundle_texts
from nestfold.sources.bundles import read_bundles


def _bundle(bid, entries, root="Bundle"):
    return {"resourceType": root, "id": bid, "type": "collection", "entry": entries}


def _entry(url, rtype, rid, **fields):
    return {"request": {"url": url}, "resource": {"resourceType": rtype, "id": rid, **fields}}


def _write_tree(localdir):
    """One bundle per file, pretty-printed over many lines; plus a truncated
    file and a non-bundle root."""
    files = {
        "b1.json": _bundle("b1", [_entry("Patient", "Patient", "p1", gender="f"), _entry("Encounter/9", "Encounter", "e1")]),
        "b2.json": _bundle(
            "b2",
            [
                _entry("Encounter", "Encounter", "e2"),
                {"request": {"url": "Note"}},  # no resource
                {"resource": {"resourceType": "Note", "id": "n1"}},  # no request
                _entry("Encounter?x=1", "Encounter", "e3"),
            ],
        ),
        "other.json": _bundle("o1", [_entry("Patient", "Patient", "p9")], root="Parameters"),
    }
    for name, doc in files.items():
        with open(os.path.join(localdir, name), "w") as f:
            json.dump(doc, f, indent=2)
    with open(os.path.join(localdir, "broken.json"), "w") as f:
        f.write('{"resourceType": "Bundle", "entry": [')
    return localdir


def test_read_file_layout_skips_broken_and_foreign_roots(spark, localdir):
    b = read_bundles(spark, _write_tree(localdir), layout="file")
    assert sorted(r.bundle_id for r in b.collect()) == ["b1", "b2"]


def test_entries_route_by_url_and_type(spark, localdir):
    b = read_bundles(spark, _write_tree(localdir), layout="file")
    by_url = explode_entries(b).select("bundle_id", "entry_pos", "res_name").collect()
    assert sorted((r.bundle_id, r.entry_pos, r.res_name) for r in by_url) == [
        ("b1", 0, "Patient"),
        ("b1", 1, "Encounter"),
        ("b2", 0, "Encounter"),
        ("b2", 2, None),
        ("b2", 3, "Encounter"),
    ]
    by_type = explode_entries(b, route_by="type").where("bundle_id = 'b2'").select("res_name").collect()
    assert sorted(r.res_name for r in by_type) == ["Encounter", "Encounter", "Note"]


def test_resource_kept_as_json_text(spark, localdir):
    b = read_bundles(spark, _write_tree(localdir), layout="file")
    e = explode_entries(b).where("bundle_id = 'b1' AND entry_pos = 0").first()
    assert json.loads(e.res_data) == {"resourceType": "Patient", "id": "p1", "gender": "f"}


def test_select_types_keeps_untyped_on_exclude(spark, localdir):
    e = explode_entries(read_bundles(spark, _write_tree(localdir), layout="file"))
    ex = select_types(e, exclude=["Patient", "Encounter"]).collect()
    assert [(r.bundle_id, r.res_name) for r in ex] == [("b2", None)]
    inc = select_types(e, include=["Patient"]).collect()
    assert [r.bundle_id for r in inc] == ["b1"]


def test_bundle_stats_and_first_type(spark, localdir):
    e = explode_entries(read_bundles(spark, _write_tree(localdir), layout="file"))
    s = bundle_stats(e).first()
    assert (s.n_bundles, s.n_type_files, s.n_entries) == (2, 4, 5)  # b1: 2 types; b2: Encounter + NULL
    firsts = {r.bundle_id: r.first_type for r in first_type(e).collect()}
    assert firsts == {"b1": "Patient", "b2": "Encounter"}


def test_route_key_and_out_path(spark):
    df = spark.createDataFrame(
        [("Patient/12", "/in/a.json.json"), ("Encounter?x=1", "x.json")], "url string, source_file string"
    )
    rows = out_path(df.withColumn("res_name", route_key(F.col("url"))), "/out").collect()
    assert [(r.res_name, r.out_path) for r in rows] == [
        ("Patient", "/out/Patient/a_Patient"),
        ("Encounter", "/out/Encounter/x_Encounter"),
    ]
    assert route_key(F.lit("")) is not None  # empty URL → NULL type (checked in SQL below)
    assert spark.range(1).select(route_key(F.lit("")).alias("t")).first().t is None


def test_paged_bundles_hold_every_entry_once(spark):
    small = bundle_texts(spark, SF001, max_lines=2)
    big = bundle_texts(spark, SF001)
    from nestfold.sources.bundles import parse_bundles

    def entries(b):
        e = explode_entries(parse_bundles(b.select("value")))
        return sorted(
            (r.res_name, r.rid) for r in e.select("res_name", F.get_json_object("res_data", "$.id").alias("rid")).collect()
        )

    assert entries(small) == entries(big)
    # every paged order still has page 0 with its order entry
    lines_per_bundle = (
        explode_entries(parse_bundles(small.select("value"))).where("res_name = 'Line'").groupBy("bundle_id", "page").count()
    )
    lines_per_order = spark.read.parquet(f"{SF001}/lineitem.parquet").groupBy("l_orderkey").count()
    assert lines_per_bundle.agg(F.max("count")).first()[0] < lines_per_order.agg(F.max("count")).first()[0]
    ids = {r.bundle_id for r in small.select("bundle_id").distinct().collect()}
    assert ids == {r.bundle_id for r in big.select("bundle_id").collect()}  # pages share their order's id
    orders = small.where("page = 0").select("order_id").distinct().count()
    assert orders == spark.read.parquet(f"{SF001}/orders.parquet").count()


def test_whole_files_are_read_once_and_resources_keep_their_text(spark, localdir):
    resource = '{"resourceType": "A",  "x": 1.10, "y": 1E5, "t": "caf\\u00e9 \u00e9"}'
    text = '{"resourceType": "Bundle",\n"id": "b", "entry": [\n' + ",\n".join(['{"resource": ' + resource + "}"] * 2000) + "]}"
    whole = {"plain": text.encode(), "mark": b"\xef\xbb\xbf" + text.encode(), "list": f"[{text},\n{text}]".encode()}
    broken = {"wide": text.encode("utf-16"), "cut": text[:-1].encode(), "half": f"[{text}, 3]".encode(), "blank": b" \n", "none": b""}
    for name, content in {**whole, **broken}.items():
        with open(os.path.join(localdir, f"{name}.json"), "wb") as f:
            f.write(content)
    read = lambda: spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")
    before = read()
    entries = explode_entries(read_bundles(spark, localdir, layout="file"), route_by="type").collect()
    size = sum(map(len, [*whole.values(), *broken.values()]))
    assert read() - before < 3 * size
    found = {}
    for r in entries:
        found.setdefault(os.path.basename(r.source_file), []).append((r.res_name, r.res_data))
    assert found == {"plain.json": [("A", resource)] * 2000, "mark.json": [("A", resource)] * 2000, "list.json": [("A", resource)] * 4000}
