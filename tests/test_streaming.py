from conftest import SF001
from nestfold.plans.records import bundle_texts
from nestfold.plans.stream_queries import LINE_JSON
from nestfold.session import scratch_path
from nestfold.streaming.streams import stream_append, stream_bundles


def test_stream_append_batches_and_restart(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    landing = scratch_path(spark, "t-landing")
    events.repartition(8).write.parquet(landing)
    out, ckpt = scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt")

    q = stream_append(spark, landing, out, events.schema, ckpt, files_per_trigger=4)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 2  # 8 files, 4 per micro-batch
    first = spark.read.parquet(out)
    assert first.count() == events.count()
    assert first.exceptAll(events).count() == 0

    # restarting on the same checkpoint appends nothing
    q2 = stream_append(spark, landing, out, events.schema, ckpt, files_per_trigger=4)
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == events.count()


def test_stream_bundles_equals_batch(spark):
    texts = bundle_texts(spark, SF001).select("value")
    landing = scratch_path(spark, "t-bundles")
    texts.repartition(4).write.text(landing)
    out = scratch_path(spark, "t-lines")
    q = stream_bundles(spark, landing, out, "Line", LINE_JSON, scratch_path(spark, "t-ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert "Line_orderkey" in got.columns and "_bundle_id" in got.columns


def test_indexed_flatten_on_a_stream_with_declared_widths(spark, localdir):
    import json
    import os

    from pyspark.sql import functions as F

    from nestfold.operators.flatten import flatten

    src = os.path.join(localdir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"id": "1", "tags": ["x", "y"]}) + "\n" + json.dumps({"id": "2", "tags": []}) + "\n")
    schema = "id string, tags array<string>"
    stream = spark.readStream.text(src).select(F.from_json("value", schema).alias("r")).select("r.*")
    flat = flatten(stream, mode="indexed", widths={"tags": 3})
    assert flat.columns == ["id", "tags.0", "tags.1", "tags.2"]
    out, ckpt = scratch_path(spark, "t-idx"), scratch_path(spark, "t-idx-ckpt")
    flat.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
    rows = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert rows == [("1", "x", "y", None), ("2", None, None, None)]


def test_stream_split_by_type_feeds_one_table_per_type(spark):
    from nestfold.plans.bundle_queries import land_bundles
    from nestfold.plans.stream_queries import ORDER_JSON
    from nestfold.streaming.streams import stream_split_by_type

    out = scratch_path(spark, "t-split")
    q = stream_split_by_type(
        spark, land_bundles(spark, SF001), out, {"Order": ORDER_JSON, "Line": LINE_JSON}, scratch_path(spark, "t-split-ckpt"),
        files_per_trigger=1,
    )
    q.awaitTermination()
    n_orders = spark.read.parquet(f"{SF001}/orders.parquet").count()
    n_lines = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert spark.read.parquet(f"{out}/Order").count() == n_orders
    assert spark.read.parquet(f"{out}/Line").count() == n_lines
