import os

from pyspark.sql import functions as F

from nestfold.functions.text import decode_bom, filter_paths, normalise_newlines, read_side_text, wrap_text
from nestfold.sources.files import list_files, read_whole_files


def _norm(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(normalise_newlines(F.col("t"))).collect()]


def test_line_endings(spark):
    assert _norm(spark, ["a\r\nb", "a\n", "", "a\rb", "x\r", "a\r\r\n", "a\n\n"]) == [
        "a\nb\n",
        "a\n",
        "",
        "a\rb\n",
        "x\r\n",
        "a\r\n",
        "a\n\n",
    ]


def test_decode_by_byte_order_mark(spark):
    text = "Grüße\r\nzwei"
    raw = [
        b"\xef\xbb\xbf" + text.encode("utf-8"),
        b"\xff\xfe" + text.encode("utf-16-le"),
        b"\xfe\xff" + text.encode("utf-16-be"),
        text.encode("utf-8"),
    ]
    df = spark.createDataFrame([(bytearray(b),) for b in raw], "c binary")
    got = [r[0] for r in df.select(decode_bom(F.col("c"))).collect()]
    assert got == [text] * 4
    kept = df.select(decode_bom(F.col("c"), strip_bom=False)).first()[0]
    assert kept == "﻿" + text


def test_wrap_and_filter_paths(spark):
    df = spark.createDataFrame(
        [("db/Tables/a.SQL",), ("db/Initialization Data/b.sql",), ("db/readme.md",), ("x.sqlite",)], "path string"
    )
    sel, rest = filter_paths(df)
    assert sorted(r.path for r in sel.collect()) == ["db/Tables/a.SQL", "x.sqlite"]
    assert sorted(r.path for r in rest.collect()) == ["db/Initialization Data/b.sql", "db/readme.md"]
    w = spark.createDataFrame([("body",)], "t string").select(wrap_text(F.col("t"), "H\n", "\nF")).first()[0]
    assert w == "H\nbody\nF"


def test_tree_walk_listing_and_side_text(spark, localdir):
    os.makedirs(os.path.join(localdir, "a", "b"))
    for rel, data in [("a/one.sql", b"select 1;\r\n"), ("a/b/two.sql", b"\xef\xbb\xbfselect 2;"), ("top.txt", b"t")]:
        with open(os.path.join(localdir, rel), "wb") as f:
            f.write(data)
    listing = {os.path.basename(r.path): r.length for r in list_files(spark, localdir).collect()}
    assert listing == {"one.sql": 11, "two.sql": 12, "top.txt": 1}
    assert [os.path.basename(r.path) for r in list_files(spark, localdir, limit=1).collect()] == ["two.sql"]
    files = read_whole_files(spark, localdir)
    sel, _ = filter_paths(files)
    out = {os.path.basename(r.path): r.t for r in sel.select("path", normalise_newlines(decode_bom(F.col("content"))).alias("t")).collect()}
    assert out == {"one.sql": "select 1;\n", "two.sql": "select 2;\n"}
    assert read_side_text(spark, os.path.join(localdir, "top.txt")) == "t"


def test_files_that_a_path_filter_leaves_out_are_not_read(spark, localdir):
    os.mkdir(os.path.join(localdir, "a b"))
    for i in range(200):
        with open(os.path.join(localdir, "a b", f"{i}+%20#é.{'SQL' if i < 20 else 'html'}"), "wb") as f:
            f.write(b"x" * 50_000)
    read = lambda: spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")
    files = read_whole_files(spark, localdir)
    before = read()
    selected, others = filter_paths(files, "path")
    rows = selected.collect()
    assert sorted(os.path.basename(r.path) for r in rows) == sorted(f"{i}+%20#é.SQL" for i in range(20))
    assert read() - before < 200 * 50_000 / 4
    assert others.count() == 180 and files.count() == 200
