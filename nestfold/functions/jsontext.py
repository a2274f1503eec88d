"""JSON text with full timestamp precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON timestamp text keeps microseconds (Spark's default writer
# format stops at milliseconds).
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_json_text(col: Column) -> Column:
    """``to_json`` with microsecond timestamps."""
    return F.to_json(col, JSON_WRITE_OPTIONS)
