"""Bundle entries: explode, route by record type, select types, per-bundle
statistics. All narrow except the statistics, which aggregate partially
before their shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_key(url: Column) -> Column:
    """Record type from a request URL: the text before the first ``/`` or ``?``
    (``Patient/123`` → ``Patient``)."""
    return F.nullif(F.regexp_extract(url, r"^([^/?]*)", 1), F.lit(""))


def explode_entries(bundles: DataFrame, route_by: str = "url", keep_empty: bool = False) -> DataFrame:
    """One row per bundle entry with a resource:
    ``(<bundle columns>, entry_pos, res_name, res_data)``. ``res_data`` is the
    resource as JSON text. ``entry_pos`` ascends through the pages of a paged
    bundle, with gaps between pages. ``route_by="url"`` names the type by
    ``request.url``; ``"type"`` by the resource's own ``resourceType``."""
    others = [c for c in bundles.columns if c not in ("entry",)]
    df = bundles.select(*others, F.posexplode("entry").alias("entry_pos", "e"))
    if "page" in others:  # positions of a paged bundle go on from page to page
        df = df.withColumn("entry_pos", F.shiftleft(F.col("page").cast("long"), 32) + F.col("entry_pos"))
    if not keep_empty:
        df = df.where(F.col("e.resource").isNotNull())
    if route_by == "url":
        name = route_key(F.col("e.request.url"))
    elif route_by == "type":
        name = F.get_json_object(F.col("e.resource"), "$.resourceType")
    else:
        raise ValueError("route_by must be 'url' or 'type'")
    return df.select(*others, "entry_pos", name.alias("res_name"), F.col("e.resource").alias("res_data"))


def select_types(df: DataFrame, include=None, exclude=None, col: str = "res_name") -> DataFrame:
    """Keep rows whose type is in ``include`` and not in ``exclude``. As in a
    plain ``!=`` test, a row with no type is kept by an exclusion."""
    c = F.col(col)
    if include is not None:
        df = df.where(c.isin(list(include)))
    if exclude:
        df = df.where(c.isNull() | ~c.isin(list(exclude)))
    return df


def type_counts(entries: DataFrame, bundle_col: str = "bundle_id") -> DataFrame:
    """Per record type: entries and bundles holding it."""
    return entries.groupBy("res_name").agg(
        F.count(F.lit(1)).alias("n_entries"), F.countDistinct(bundle_col).alias("n_bundles")
    )


def bundle_stats(entries: DataFrame, bundle_col: str = "bundle_id") -> DataFrame:
    """One row: number of bundles, number of per-type outputs (the sum over
    bundles of their distinct types) and number of entries. The per-bundle
    distinct is a two-level aggregation, so a huge bundle is combined
    map-side."""
    per_pair = entries.groupBy(bundle_col, "res_name").agg(F.count(F.lit(1)).alias("n"))
    return per_pair.agg(
        F.countDistinct(bundle_col).alias("n_bundles"),
        F.count(F.lit(1)).alias("n_type_files"),
        F.sum("n").alias("n_entries"),
    )


def first_type(entries: DataFrame, bundle_col: str = "bundle_id") -> DataFrame:
    """The type of each bundle's first entry (arrival order)."""
    return entries.groupBy(bundle_col).agg(F.min_by("res_name", "entry_pos").alias("first_type"))


def out_path(df: DataFrame, root: str, file_col: str = "source_file", type_col: str = "res_name") -> DataFrame:
    """``<root>/<Type>/<file without .json>_<Type>`` per row (every ``.json``
    occurrence is removed, as a plain string replace does)."""
    base = F.regexp_extract(F.col(file_col), r"([^/]*)$", 1)
    stem = F.replace(base, F.lit(".json"), F.lit(""))
    return df.withColumn(
        "out_path", F.concat_ws("/", F.lit(root.rstrip("/")), F.col(type_col), F.concat(stem, F.lit("_"), F.col(type_col)))
    )
