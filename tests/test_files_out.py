"""Numbering and paging, packed tables, file trees, positions with overflow."""

import os

import pytest
from pyspark.sql import functions as F

from nestfold.functions.text import normalise_text
from nestfold.operators.numbering import next_page, numbered, paged
from nestfold.operators.positions import long_positions, spread_positions, usual_width
from nestfold.session import path_exists
from nestfold.sinks.packed import read_key, read_manifest, write_packed
from nestfold.sinks.tree import write_tree
from nestfold.sinks.writers import read_csv, write_csv
from nestfold.sources.files import read_whole_files, relative_path


def test_numbers_are_those_of_a_sort(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k"), F.col("id").alias("v")).repartition(13)
    got = [r.row_number for r in numbered(df, ["k"]).orderBy("k").collect()]
    assert got == list(range(1, 5001))
    assert numbered(df.limit(0), ["k"]).count() == 0
    assert max(r.page for r in paged(df, ["k"], 100).collect()) == 50


def test_hot_key_is_numbered_over_many_tasks(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = numbered(df, ["k", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = rows.where("k = 7").select(F.col("_metadata.file_name")).distinct().count()
    assert files >= 2 and rows.agg(F.max("row_number"), F.count_distinct("row_number")).first() == (30000, 30000)


def test_pages_by_token(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(25)], "name string")
    token, seen, sizes = None, [], []
    while True:
        page, token = next_page(df, "name", 10, token)
        seen += [r.name for r in page.collect()]
        sizes.append(page.count())
        if token is None:
            break
    assert seen == [f"k{i:03d}" for i in range(25)] and sizes == [10, 10, 5]


def test_files_follow_bytes_not_keys_and_one_key_is_read_alone(spark, workdir):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), (F.col("id") % 5000).cast("string"))).alias("src"), "id")
    rows = rows.repartition(7)
    manifest = write_packed(rows, workdir, "src", n_bytes=40_000 * 30, file_bytes=200_000)
    files = {r.file for r in manifest.collect()}
    assert len(files) == 6  # 5,001 bundles
    assert 2 <= manifest.where("src = 'hot'").count() <= 4  # a third of the rows: spread, in few ranges
    assert manifest.agg(F.sum("n_rows")).first()[0] == 40_000
    one = read_key(spark, workdir, "src", "b4999")
    assert len(one.inputFiles()) <= 2 and one.count() == rows.where("src = 'b4999'").count()
    assert read_key(spark, workdir, "src", "hot").count() == rows.where("src = 'hot'").count()
    assert read_key(spark, workdir, "src", "none").count() == 0
    assert spark.read.parquet(workdir).count() == 40_000  # the manifest is no part of the table


def test_rows_without_a_key_and_appends(spark, workdir):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "src string, v int")
    write_packed(a, workdir, "src", 10)
    write_packed(a, workdir, "src", 10, mode="append")
    assert sorted((r.src or "", r.n_rows) for r in read_manifest(spark, workdir).collect()) == [("", 1), ("", 1), ("x", 1), ("x", 1)]
    assert [r.v for r in read_key(spark, workdir, "src", None).collect()] == [1, 1]


def test_packed_tables_of_types(spark, workdir):
    from nestfold.sinks.writers import write_by_type

    e = spark.createDataFrame([(f"b{i}", t, f'{{"id":"{i}"}}') for i in range(300) for t in ("A", "B")], "bundle_id string, res_name string, res_data string")
    paths = write_by_type(e, workdir, packed_bytes=4000)
    assert 1 < len(spark.read.parquet(paths["A"]).inputFiles()) < 10
    assert [r.A_id for r in read_key(spark, paths["A"], "_bundle_id", "b7").collect()] == ["7"]


def test_tree_keeps_paths_and_bytes(spark, workdir):
    rows = [("a/b c/é.sql", b"\xff\xfea\x00"), ("top.txt", b""), ("a/x.bin", bytes(range(256))), ("n", None)]
    write_tree(spark.createDataFrame(rows, "path string, content binary").repartition(3), workdir)
    back = {r.path: bytes(r.content) for r in read_whole_files(spark, workdir).withColumn("path", relative_path(F.col("path"), workdir)).collect()}
    assert back == {p: c or b"" for p, c in rows}


def _siblings(workdir):
    folder = os.path.dirname(workdir.removeprefix("file:"))
    return [n for n in os.listdir(folder) if n.startswith(os.path.basename(workdir)) and "staging" in n]


@pytest.mark.parametrize("bad", ["../up", "/abs", "a//b", "good/1"])
def test_a_failed_tree_leaves_nothing(spark, workdir, bad):
    rows = [(f"good/{i}", b"x") for i in range(50)] + [(bad, b"y")]
    with pytest.raises(Exception, match="path below|name the file"):
        write_tree(spark.createDataFrame(rows, "path string, content binary").repartition(4), workdir)
    assert not path_exists(spark, workdir) and not _siblings(workdir)


def test_a_tree_is_replaced_only_on_request(spark, workdir):
    one = spark.createDataFrame([("a", b"1")], "path string, content binary")
    two = spark.createDataFrame([("b", b"2")], "path string, content binary")
    write_tree(one, workdir)
    with pytest.raises(Exception, match="there already"):
        write_tree(two, workdir)
    assert [r.length for r in read_whole_files(spark, workdir).collect()] == [1]
    write_tree(two, workdir, mode="overwrite")
    names = [os.path.basename(r.path) for r in read_whole_files(spark, workdir).collect()]
    assert names == ["b"] and not _siblings(workdir)


def test_text_tree_in_mixed_encodings(spark, workdir):
    rows = [("a.sql", "é\r\n".encode("utf-16")), ("b.sql", b"\xef\xbb\xbfx"), ("c.sql", b"")]
    write_tree(spark.createDataFrame(rows, "path string, content binary"), workdir)
    files = normalise_text(read_whole_files(spark, workdir))
    assert {os.path.basename(r.path): r.text for r in files.collect()} == {"a.sql": "é\n", "b.sql": "x\n", "c.sql": ""}


def test_positions_and_overflow_of_paged_records(spark):
    schema = "id int, first bigint, a array<struct<x: int, y: string>>, s string"
    rows = [(1, 0, [(i, f"y{i}") for i in range(4)], "p"), (1, 4, [(4, None), (5, "y5")], "p"), (2, 0, [(0, "z")], "q"), (3, 0, [], "r"), (4, 0, None, "t")]
    records = spark.createDataFrame(rows, schema)
    want = sorted(
        [(1, "a.x", i, str(i)) for i in range(6)] + [(1, "a.y", i, f"y{i}") for i in (0, 1, 2, 3, 5)] + [(2, "a.x", 0, "0"), (2, "a.y", 0, "z")]
    )
    assert usual_width(records, "a", share=0.5) in (0, 1) and usual_width(records, "a", share=1.0) == 6
    for width in (0, 1, 3, 4):
        wide, overflow = spread_positions(records, "a", width, first="first")
        assert wide.count() == 4 and len(wide.columns) == 2 + 2 * width
        assert sorted(tuple(r) for r in long_positions(wide, overflow, "a").collect()) == want


def test_positions_of_scalars(spark):
    records = spark.createDataFrame([(1, ["a", None, "c"]), (2, ["d"])], "id int, t array<string>")
    wide, overflow = spread_positions(records, "t", 2)
    assert wide.columns == ["id", "t.0", "t.1"]
    assert sorted(tuple(r) for r in long_positions(wide, overflow, "t").collect()) == [(1, "t", 0, "a"), (1, "t", 2, "c"), (2, "t", 0, "d")]


def test_csv_texts_that_look_like_null(spark, workdir):
    df = spark.createDataFrame([(1, "\\N"), (2, None), (3, "\\\\N"), (4, ""), (5, "\\"), (6, "a\\N")], "id int, t string")
    back = read_csv(spark, write_csv(df, workdir), schema=df.schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
