"""Helpers shared by the corpus operators: stored intermediates, lookups that
survive hot keys, word splitting."""

from __future__ import annotations

import math
import uuid
from decimal import Decimal
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from nestfold.session import scratch_path, tuned

#: A table of at most this many rows is broadcast after it has been counted; a
#: larger one is shuffled.
BROADCAST_ROWS = 100_000
#: And of at most this many bytes of values.
BROADCAST_BYTES = 16 << 20

#: A key is hot when it holds at least one row in this many. There can be no
#: more hot keys than that, so a table of hot keys is always small.
HOT_SHARE = 1_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` with the query settings (broadcasts by measured
    size), which also removes shuffle files once their result is written."""
    beside = tuned(spark)
    beside.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return beside


def moved(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` as a table of another session of the same cluster, whose settings
    then hold for what is made of it."""
    if df.sparkSession is spark:
        return df
    name = f"nestfold_{uuid.uuid4().hex}"
    df.createOrReplaceGlobalTempView(name)
    try:
        return spark.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def store(df: DataFrame, name: str, packed: bool = False) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    lineage is cut, and a lost executor costs no recomputation. The files go
    when the session's JVM ends, or earlier with ``discard``. What is ``packed``
    already is not compressed again: the codec would hold buffers of the size
    of whole pages outside the heap."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**({"compression": "uncompressed"} if packed else {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Remove tables made by ``store`` that no pending result reads."""
    for df in stored:
        hadoop_path, fs = _fs(df.sparkSession, df._stored_at)
        fs.delete(hadoop_path, True)


def _fs(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else as it is. ``lower`` does just that to a text
    of one byte per character, at a fraction of the cost."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fits(entries: DataFrame, most_rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to broadcast: its rows and the bytes of
    their values, summed in one aggregation over (a row more than) that many."""
    some = entries.limit(most_rows + 1)
    short = lambda t: isinstance(t, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType))
    long = [f.name for f in entries.schema.fields if not short(f.dataType)]
    each = sum([F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c in long], F.lit(16 * len(entries.columns)))
    rows, size = some.agg(F.count("*"), F.coalesce(F.sum(each.cast("long")), F.lit(0))).first()
    return rows <= most_rows and size <= most_bytes


def lookup(rows: DataFrame, entries: DataFrame, key: str, held: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``entries`` (one row per key) left-joined.

    ``entries[held]`` is the number of rows of the key and ``total`` the number
    of all rows. A table that ``fits`` is broadcast. Beyond that, hot keys (at
    most ``HOT_SHARE`` of them, see above) are broadcast and all other keys are
    joined by a shuffle in which none holds more than a thousandth of the rows.
    Keys must not be null.
    """
    if fits(entries):
        return rows.join(F.broadcast(entries), key, "left")
    least, mark = max(2, math.ceil(total / HOT_SHARE)), spare(rows, "_hot")
    hot = entries.where(F.col(held) >= least).withColumn(mark, F.lit(True))
    cold = entries.where(F.col(held) < least)
    marked = rows.join(F.broadcast(hot), key, "left")
    rest = marked.where(F.col(mark).isNull()).select(*rows.columns).join(cold, key, "left")
    return marked.where(F.col(mark)).drop(mark).unionByName(rest)


def id_shards(rows: DataFrame, id_col: str, size_col: str, target: int, part: Column, buckets: int = 1 << 14) -> tuple[Column, int]:
    """A shard number for each row, ascending with ``id_col``, and how many
    there are: id ranges of about ``target`` summed ``size_col``.

    The cuts come from a histogram of at most ``buckets`` ids ranges, which is all
    that reaches the driver. Ranges that hold more than ``target`` are cut again
    by a histogram of their own, so sparse ids shard as evenly as dense ones.
    A single id, or rows without one, that hold more are cut by ``part``, a
    number from 0 to 1 by which rows of one id are in order. Null ids come
    first. The same rows give the same shards; no id is too far from another."""
    size, wide = F.sum(size_col), "decimal(20,0)"
    low, high, none = rows.agg(F.min(id_col), F.max(id_col), F.sum(F.when(F.col(id_col).isNull(), F.col(size_col)))).first()
    low, high = low or 0, high or 0
    cell = F.col(id_col).cast(wide) - F.lit(Decimal(low)).cast(wide)
    width = -(-(high - low + 1) // buckets)
    index = F.call_function("div", cell, F.lit(Decimal(width)).cast(wide)).cast("int")
    levels, chosen, starts = [], rows.where(F.col(id_col).isNotNull()), [low + i * width for i in range(buckets)]
    while True:
        held = dict(chosen.groupBy(index.alias("b")).agg(size).collect())
        cut = sorted(b for b, w in held.items() if w > target) if width > 1 else []
        levels.append((index, starts, held, cut))
        if not cut:
            break
        number, fewer = _at({b: i for i, b in enumerate(cut)}, index, -1), max(2, buckets // len(cut))
        finer = -(-width // fewer)
        chosen = chosen.where(number >= 0)
        index = let(index, partial(_finer, cut, starts, low, fewer, finer, cell, wide))
        starts, width = [starts[b] + i * finer for b in cut for i in range(fewer)], finer

    shard, sofar, first = 0, 0, [({}, {}) for _ in levels]  # first shard and number of shards of each range

    def place(weight) -> tuple[int, int]:
        nonlocal shard, sofar
        if sofar and sofar + weight > target:
            shard, sofar = shard + 1, 0
        at, parts = shard, max(1, -(-weight // target))
        shard, sofar = (shard, sofar + weight) if parts == 1 else (shard + parts, 0)
        return at, parts

    def walk(level: int, keys) -> None:
        _, _, held, cut = levels[level]
        inner = {b: i for i, b in enumerate(cut)}
        for b in keys:
            if b in inner:
                fewer = len(levels[level + 1][1]) // len(cut)
                below = levels[level + 1][2]
                walk(level + 1, [k for k in range(inner[b] * fewer, (inner[b] + 1) * fewer) if k in below])
            else:
                first[level][0][b], first[level][1][b] = place(held[b])

    null_at, null_parts = place(none) if none else (0, 1)
    walk(0, sorted(levels[0][2]))
    spread = lambda at, parts: at + F.least(F.floor(part * parts), parts - 1).cast("int")
    out = F.lit(None).cast("int")
    for (index, _, _, cut), (at, parts) in reversed(list(zip(levels, first))):
        own = spread(_at(at, index, 0), _at(parts, index, 1))
        out = F.when(_at(dict.fromkeys(cut, 1), index, 0) == 1, out).otherwise(own) if cut else own
    return F.when(F.col(id_col).isNull(), spread(F.lit(null_at), F.lit(null_parts))).otherwise(out), shard + 1


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` written and computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _finer(cut, starts, low, fewer, finer, cell, wide, index):
    begin = _at({b: starts[b] - low for b in cut}, index, 0, wide)
    return (_at({b: i for i, b in enumerate(cut)}, index, 0) * fewer + F.call_function("div", cell - begin, F.lit(Decimal(finer)).cast(wide))).cast("int")


def _at(values: dict, index: Column, default, kind: str = "int") -> Column:
    """``values[index]``, ``default`` for all other indexes."""
    if set(values.values()) <= {default}:
        return F.lit(default).cast(kind)
    listed = [values.get(i, default) for i in range(max(values) + 1)]
    table = F.split(F.lit(",".join(map(str, listed))), ",").cast(f"array<{kind}>")  # folded to one literal
    return F.coalesce(F.get(table, index), F.lit(default).cast(kind))


def file_uri(path: str) -> str:
    return f"file://{path}" if path.startswith("/") else path


def publish(manifest: DataFrame, root: str) -> DataFrame:
    """Give the files of ``manifest`` (columns ``temp``, a path, and ``name``)
    their names below ``root`` and write the manifest there. ``manifest`` is a
    stored table, so it holds the rows of one attempt of each task; a file left
    by any other attempt keeps its temporary name and is removed. Readers go
    by the manifest, which is written last. A repeated attempt changes nothing;
    files of an earlier run that broke off before its manifest are replaced.
    The files stay when the session ends."""
    from nestfold.llm.files import Files

    spark, schema = manifest.sparkSession, manifest.schema

    def commit(batches):
        files = Files(root)
        for batch in batches:
            for r in batch.select(["temp", "name"]).to_pylist():
                files.rename(r["temp"], r["name"])
            yield batch

    manifest.mapInArrow(commit, schema).write.parquet(f"{root}/manifest")
    p, fs = _fs(spark, f"{root}/temp")
    fs.delete(p, True)
    return spark.read.schema(schema).parquet(f"{root}/manifest")


def make_folders(spark: SparkSession, root: str) -> None:
    p, fs = _fs(spark, f"{root}/temp")
    fs.mkdirs(p)
