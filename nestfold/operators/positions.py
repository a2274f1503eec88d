"""The indexed layout with an overflow table: positional columns for the
usual width, rows for what lies beyond."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestfold.operators.flatten import q

#: Rank of the record whose width the positional columns hold, and the most of them.
SHARE, MOST = 0.99, 64


def usual_width(records: DataFrame, array: str, key: str = "id", share: float = SHARE, most: int = MOST) -> int:
    """Positions that ``share`` of the records need: a quantile sketch of the
    records' widths, over all their pages, and ``most`` at most."""
    widths = records.groupBy(key).agg(F.sum(F.greatest(F.size(q(array)), F.lit(0))).alias("n"))
    return min(int(widths.agg(F.percentile_approx("n", share, 10_000)).first()[0] or 0), most)


def spread_positions(records: DataFrame, array: str, width: int, key: str = "id", first: str | None = None) -> tuple[DataFrame, DataFrame]:
    """An array of structs (or scalars) of ``records`` in two tables.

    * wide, one row per record: the other columns, and ``<array>.<i>.<field>``
      for positions below ``width``;
    * overflow: ``key``, ``path`` (``<array>.<field>``), ``index`` and ``value`` as
      text, for the non-null values at all further positions.

    A record may be split into pages: ``first`` then names the column with the
    number of elements on earlier pages. Its first page must hold ``width``
    elements if there is a second one; so no record is put together again, the
    layout needs no shuffle, and neither table has a row that grows with a
    record."""
    at = F.lit(0) if first is None else q(first)
    kind = records.schema[array].dataType.elementType
    fields = [f.name for f in kind.fields] if hasattr(kind, "fields") else [None]
    others = [c for c in records.columns if c not in (array, first)]

    def column(i: int, f: str | None):
        x = F.get(q(array), F.lit(i))
        return x.alias(f"{array}.{i}") if f is None else x.getField(f).alias(f"{array}.{i}.{f}")

    wide = records if first is None else records.where(at == 0)
    wide = wide.select(*[q(c) for c in others], *[column(i, f) for i in range(width) for f in fields])

    rest = records.where(at + F.size(q(array)) > width)
    begin = F.greatest(F.lit(width) - at, F.lit(0)).cast("int")  # elements of the page that are in the wide table
    items = rest.select(q(key), (at + begin).alias("_begin"), F.posexplode(F.slice(q(array), begin + 1, F.greatest(F.size(q(array)) - begin, F.lit(0)))).alias("_pos", "_item"))
    value = lambda f: F.col("_item") if f is None else F.col("_item").getField(f)
    pairs = F.array(*[F.struct(F.lit(array if f is None else f"{array}.{f}").alias("path"), value(f).cast("string").alias("value")) for f in fields])
    overflow = items.select(q(key), (F.col("_begin") + F.col("_pos")).cast("bigint").alias("index"), F.explode(pairs).alias("_pair"))
    return wide, overflow.select(key, "_pair.path", "index", "_pair.value").where("value IS NOT NULL")


def long_positions(wide: DataFrame, overflow: DataFrame, array: str, key: str = "id") -> DataFrame:
    """Both tables of ``spread_positions`` as one: ``key``, ``path``, ``index``,
    ``value`` for every non-null value."""
    found = []
    for c in wide.columns:
        if c.startswith(f"{array}."):
            index, _, field = c[len(array) + 1 :].partition(".")
            found.append(F.struct(F.lit(f"{array}.{field}" if field else array).alias("path"), F.lit(int(index)).cast("bigint").alias("index"), q(c).cast("string").alias("value")))
    if not found:
        return overflow
    rows = wide.select(q(key), F.explode(F.array(*found)).alias("_x")).select(key, "_x.path", "_x.index", "_x.value")
    return rows.where("value IS NOT NULL").unionByName(overflow)
