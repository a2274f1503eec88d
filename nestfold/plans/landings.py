"""The inputs that queries land once per session, by name, so that a bench can
time them apart from the queries that read them."""

from __future__ import annotations

from nestfold.plans.bundle_queries import land_bundles
from nestfold.plans.records import landed_orders
from nestfold.plans.table_queries import _documents_csv, _land_drift
from nestfold.plans.text_queries import land_tree
from nestfold.session import tuned

LANDINGS = {
    "land_bundles": land_bundles,
    "land_documents_csv": _documents_csv,
    "land_drift": _land_drift,
    "land_file_tree": land_tree,
    "land_order_records": landed_orders,
}


def land(spark, sf_dir: str, name: str) -> None:
    sf_dir = sf_dir.rstrip("/")
    LANDINGS[name](tuned(spark, sf_dir), sf_dir)
