"""Incremental loads that survive a crash at any point.

Layout below a root folder::

    attempts/<version>-<unique>/rows, ids-<tier>, rejected   what a load wrote
    log/<version>.json                                       its commit

A load writes into an attempt folder of its own and then commits by creating
its log entry under a name that must not exist, in one rename. An attempt that
no entry names never happened: readers and later loads do not see it. So a
load that breaks off anywhere is simply run again, on the same input or another.

The entry names the attempt's rows and all id folders that now make up the
history. Id folders are merged by tiers: ``FAN`` folders of a tier become one
of the next, so there are few of them and an id is written again once per
tier. They are range-sorted by id, so a load whose ids lie close together
reads little of the history.
"""

from __future__ import annotations

import time
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestfold import commitlog
from nestfold.operators.flatten import q
from nestfold.session import remove

#: Id folders of one tier that are merged into one of the next.
FAN = 4


class LoadConflict(RuntimeError):
    """Another load committed this version first; run the load again."""


class Load(NamedTuple):
    """A committed load: its rows, its version, and how many rows it brought
    and how many it turned away for want of an id."""

    rows: DataFrame
    version: int
    n_rows: int
    n_rejected: int


def log_versions(spark: SparkSession, root: str) -> list[int]:
    return commitlog.versions(spark, f"{root}/log")


def log_entry(spark: SparkSession, root: str, version: int) -> dict:
    return commitlog.read_entry(spark, f"{root}/log", version)


def _commit(spark: SparkSession, root: str, version: int, entry: dict) -> None:
    try:
        commitlog.write_entry(spark, f"{root}/log", version, entry)
    except commitlog.Taken as e:
        raise LoadConflict(f"version {version} of {root} was committed by another load") from e


def _write_rows(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def _write_ids(ids: DataFrame, path: str, key: str) -> None:
    """Distinct ids, sorted by range, so that their files tell what they hold."""
    ids.dropDuplicates([key]).repartitionByRange(q(key)).sortWithinPartitions(q(key)).write.option("compression", "snappy").parquet(path)


def _merge(spark, folders: list[dict], attempt: str, key: str, fan: int) -> list[dict]:
    """Merge tiers that have ``fan`` folders, smallest first."""
    tier = 0
    while any(f["tier"] >= tier for f in folders):
        same = [f for f in folders if f["tier"] == tier]
        if len(same) >= fan:
            path = f"{attempt}/ids-{tier + 1}"
            _write_ids(spark.read.parquet(*[f["path"] for f in same]), path, key)
            folders = [f for f in folders if f["tier"] != tier] + [{"path": path, "tier": tier + 1}]
        tier += 1
    return folders


def load_history(spark: SparkSession, root: str, key: str, at: int | None = None) -> DataFrame | None:
    """All ids that loads up to version ``at`` (the newest) brought; None
    before the first load."""
    versions = log_versions(spark, root)
    if not versions:
        return None
    folders = log_entry(spark, root, at or versions[-1])["ids"]
    return spark.read.parquet(*[f["path"] for f in folders]).select(q(key)) if folders else None


def load_increment(df: DataFrame, root: str, key: str, reject_null_ids: bool = True, fan: int = FAN) -> Load:
    """Bring the rows of ``df`` whose id no committed load has, and commit them
    with their ids as the next version.

    The rows are written before they count as loaded, and returned as written:
    what a caller reads is what later loads take for loaded. Rows of one new id
    all come. A row with a null id can't be known again: it goes to the
    attempt's ``rejected`` table (``rejected_rows``), or with
    ``reject_null_ids=False`` comes with every load. A load without new rows
    commits an empty version. Of two loads at once one gets ``LoadConflict``.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    versions = log_versions(spark, root)
    version = versions[-1] + 1 if versions else 1
    folders = log_entry(spark, root, versions[-1])["ids"] if versions else []
    attempt = f"{root}/attempts/{version:08d}-{uuid.uuid4().hex[:12]}"

    low, high, n, known = df.agg(F.min(q(key)), F.max(q(key)), F.count(F.lit(1)), F.count(q(key))).first()
    fresh = df.where(q(key).isNotNull()) if reject_null_ids else df
    if folders and known:
        seen = spark.read.parquet(*[f["path"] for f in folders]).select(q(key))
        # ids are range-sorted, so the bounds prune files and row groups
        near = seen.where(q(key).between(F.lit(low), F.lit(high)))
        fresh = fresh.join(near, key, "left_anti").select(*df.columns)
    _write_rows(fresh, f"{attempt}/rows")
    rejected = n - known if reject_null_ids else 0
    if rejected:
        df.where(q(key).isNull()).write.parquet(f"{attempt}/rejected")

    rows = spark.read.schema(df.schema).parquet(f"{attempt}/rows")
    n_rows = rows.count()  # from the footers
    if n_rows:
        ids = rows.select(q(key)).where(q(key).isNotNull())
        _write_ids(ids, f"{attempt}/ids-0", key)
        folders = _merge(spark, [*folders, {"path": f"{attempt}/ids-0", "tier": 0}], attempt, key, fan)
    entry = {"version": version, "attempt": attempt, "rows": f"{attempt}/rows", "n_rows": n_rows, "n_rejected": rejected, "ids": folders}
    _commit(spark, root, version, entry)
    return Load(rows, version, n_rows, rejected)


def _tables(spark: SparkSession, root: str, which) -> list[DataFrame]:
    out = []
    for v in log_versions(spark, root):
        path = which(log_entry(spark, root, v))
        if path:
            out.append(spark.read.parquet(path).withColumn("_load", F.lit(v)))
    return out


def loaded_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all committed loads, each with its version as ``_load``;
    a column that a load did not have is null in its rows."""
    from nestfold.operators.union import union_drift

    return union_drift(_tables(spark, root.rstrip("/"), lambda e: e["rows"]))


def rejected_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows without an id that committed loads turned away, if any."""
    from nestfold.operators.union import union_drift

    found = _tables(spark, root.rstrip("/"), lambda e: f"{e['attempt']}/rejected" if e["n_rejected"] else None)
    return union_drift(found) if found else None


def load_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed load: ``version``, ``n_rows``, ``n_rejected`` and
    ``n_id_folders``, the folders that held all ids after it."""
    entries = [log_entry(spark, root.rstrip("/"), v) for v in log_versions(spark, root.rstrip("/"))]
    rows = [(e["version"], e["n_rows"], e["n_rejected"], len(e["ids"])) for e in entries]
    return spark.createDataFrame(rows, "version int, n_rows bigint, n_rejected bigint, n_id_folders int")


def vacuum(spark: SparkSession, root: str, grace_seconds: float = 86_400) -> list[str]:
    """Remove what no reader needs: attempts that no entry names, and id
    folders that were merged into others. Folders younger than
    ``grace_seconds`` stay, as a load or a reader may still be at them.
    Returns the paths removed."""
    root = root.rstrip("/")
    entries = [log_entry(spark, root, v) for v in log_versions(spark, root)]
    attempts = {e["attempt"].rsplit("/", 1)[-1] for e in entries}
    live = {f["path"] for f in entries[-1]["ids"]} if entries else set()
    before, gone = (time.time() - grace_seconds) * 1000, []
    for st in commitlog.listed(spark, f"{root}/attempts"):
        name = st.getPath().getName()
        inside = commitlog.listed(spark, f"{root}/attempts/{name}")
        if max([st.getModificationTime(), *(s.getModificationTime() for s in inside)]) > before:
            continue
        if name not in attempts:
            gone.append(f"{root}/attempts/{name}")
            continue
        for s in inside:
            path = f"{root}/attempts/{name}/{s.getPath().getName()}"
            if s.getPath().getName().startswith("ids-") and path not in live:
                gone.append(path)
    for path in gone:
        remove(spark, path)
    return gone
