"""nestfold: nested-record ingestion and flattening on Spark.

The public operators, importable from the package root::

    from nestfold import read_bundles, explode_entries, select_types, flatten
"""

from nestfold.functions.scalars import null_render, stringify
from nestfold.functions.text import (
    decode_bom,
    filter_paths,
    normalise_newlines,
    normalise_text,
    read_side_text,
    wrap_text,
)
from nestfold.operators.entries import (
    bundle_stats,
    explode_entries,
    first_type,
    out_path,
    route_key,
    select_types,
    type_counts,
)
from nestfold.operators.flatten import array_widths, drop_null_cols, fanout, flatten
from nestfold.operators.history import dedupe_first, new_ids, read_history, update_history, write_history
from nestfold.operators.profile import json_bytes, leaf_paths, profile, record_counts
from nestfold.operators.union import conform, extra_columns, read_drifting_parquet, schema_diff, union_drift
from nestfold.session import builder, checkpoint_root, scratch_path, tuned
from nestfold.sinks.writers import (
    read_csv,
    read_jdbc,
    read_ndjson,
    to_json_documents,
    write_by_type,
    write_csv,
    write_jdbc,
    write_ndjson,
)
from nestfold.sources.bundles import parse_bundles, read_bundle_text, read_bundles
from nestfold.sources.files import list_files, read_whole_files, source_files
from nestfold.streaming.streams import stream_append, stream_bundles, stream_flatten, stream_split_by_type

__all__ = [n for n in dir() if not n.startswith("_")]
