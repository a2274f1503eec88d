"""Exact de-duplication by progressive refinement: length, prefix hash, full
hash. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestfold.llm.common import BROADCAST_ROWS, lookup, store, table
from nestfold.llm.registry import register

#: The characters [\x20\x09-\x0D], which do not count in a comparison.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")

PREFIX_CHARS = 64


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty. One byte search per
    character class member, which is far cheaper than a regular expression."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256``.

    Two texts are equal when they agree after white space is deleted; of equal
    texts the one with the most code points stays, then the smallest id.

    1. One scan reduces each row to (length, hash of the first 64 characters)
       of its squeezed text. Lengths held once drop out, then pairs held once.
    2. A second scan takes the SHA-256 of the whole content, but only of rows
       whose pair survived (``digest_all=True`` also fills ``text_sha256`` of
       the others, for callers that report it). Content is never shuffled.
    3. Rows are grouped on the full hash. The aggregate combines on the map
       side, and the result is joined back by ``lookup``, so a group holding a
       third of the rows is neither collected nor sent to one task.

    Null text is an empty text; empty texts are equal to each other. A null id
    ranks after all others. Rows repeated with the same id: one of them stays.
    An empty table gives an empty result. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    base = base.select("_id", F.length(F.coalesce("_text", F.lit(""))).alias("_points"), squeezed(F.col("_text")).alias("_norm"))
    keys = [F.length("_norm").alias("_len"), F.xxhash64(F.substring("_norm", 1, PREFIX_CHARS)).alias("_prefix")]

    signs = store(base.select(*keys), "dedup-signs")
    lengths = signs.groupBy("_len").count().where("count > 1").select("_len")
    pairs = signs.groupBy("_len", "_prefix").count().join(lengths, "_len", "left_semi").where("count > 1")
    pairs = store(pairs.select("_len", "_prefix", F.lit(True).alias("_again")), "dedup-pairs")

    rows = base.select("*", *keys)
    if pairs.limit(10 * BROADCAST_ROWS + 1).count() <= 10 * BROADCAST_ROWS:  # 17 bytes a row
        rows = rows.join(F.broadcast(pairs), ["_len", "_prefix"], "left")
        wanted = F.lit(True) if digest_all else F.col("_again")
        rows = rows.select("_id", "_points", "_again", F.when(wanted, F.sha2("_norm", 256)).alias("_full"))
    else:  # the hash travels instead of the content
        rows = rows.select("_id", "_points", "_len", "_prefix", F.sha2("_norm", 256).alias("_full"))
        rows = rows.join(pairs, ["_len", "_prefix"], "left").drop("_len", "_prefix")
    rows = store(rows.withColumn("_row", F.monotonically_increasing_id()), "dedup-rows")

    rank = F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r"))
    groups = rows.where("_again").groupBy("_full").agg(F.count("*").alias("_size"), F.min(rank).alias("_best")).where("_size > 1")
    groups = store(groups.select(F.col("_full").alias("_key"), "_size", F.col("_best.i").alias("_keep"), F.col("_best.r").alias("_keep_row")), "dedup-groups")

    # a row without a full hash has a key of its own, so such rows spread
    keyed = rows.withColumn("_key", F.coalesce("_full", F.col("_row").cast("string")))
    same = lookup(keyed, groups, "_key", "_size", rows.count())
    alone = F.col("_size").isNull()
    return same.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        F.col("_full").alias("text_sha256"),
    )


@register(
    "op2_exact_dedup",
    r"""
    WITH n AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
      FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           first_value(doc_id) OVER w = doc_id AS kept, h AS text_sha256
    FROM n WINDOW w AS (PARTITION BY h ORDER BY points DESC, doc_id)
    """,
)
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)
