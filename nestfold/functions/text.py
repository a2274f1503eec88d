"""Text functions: byte-order-mark aware decoding, line-ending
normalisation, header/footer wrapping, path selection. All are built-in
expressions (no UDF), so they run inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Byte-order marks (hex) and the charset each one selects.
BOMS = [
    ("EFBBBF", "UTF-8"),
    ("FFFE", "UTF-16LE"),
    ("FEFF", "UTF-16BE"),
]

# Default path selection — paths containing ".sql", except those
# containing "initialization data" (both compared in lower case).
DEFAULT_INCLUDE = ".sql"
DEFAULT_EXCLUDE = ("initialization data",)


def _tail(content: Column, skip: int) -> Column:
    return F.substr(content, F.lit(skip + 1), F.length(content) - F.lit(skip))


def decode_bom(content: Column, default: str = "UTF-8", strip_bom: bool = True) -> Column:
    """Bytes → text. A leading byte-order mark picks the charset (UTF-8,
    UTF-16LE, UTF-16BE); otherwise ``default``. The mark itself is dropped
    unless ``strip_bom=False`` (then a UTF-8 mark passes through as U+FEFF)."""
    out = F.decode(content, default)
    for bom, cs in reversed(BOMS):
        n = len(bom) // 2
        head = F.hex(F.substr(content, F.lit(1), F.lit(n)))
        body = _tail(content, n) if (strip_bom or cs != "UTF-8") else content
        out = F.when(head == bom, F.decode(body, cs)).otherwise(out)
    return out


def normalise_newlines(text: Column) -> Column:
    """Line endings as ``\\n``: every ``\\r\\n`` becomes ``\\n`` and non-empty
    text always ends with ``\\n``. A lone ``\\r`` is kept; empty text stays
    empty."""
    t = F.regexp_replace(text, "\r\n", "\n")
    return F.when((t == "") | t.endswith("\n"), t).otherwise(F.concat(t, F.lit("\n")))


def wrap_text(text: Column, header: str = "", footer: str = "") -> Column:
    """``header + text + footer``; header and footer are small literals read
    once on the driver (``read_side_text``)."""
    return F.concat(F.lit(header), text, F.lit(footer))


SIDE_TEXT_BYTES = 1 << 20


def read_side_text(spark, path: str) -> str:
    """A small side input (header or footer file) as one string. It becomes a
    literal of the plan, so a file of over ``SIDE_TEXT_BYTES`` raises, and so
    does a folder of several files; an empty or missing one is empty text."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    found = files.limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"{path} is more than one file")
    if found and found[0][1] > SIDE_TEXT_BYTES:
        raise ValueError(f"{path} has {found[0][1]} bytes, more than {SIDE_TEXT_BYTES}")
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0] if rows else ""


def path_selected(path: Column, include: str = DEFAULT_INCLUDE, exclude=DEFAULT_EXCLUDE) -> Column:
    """Lower-cased path contains ``include`` and none of ``exclude``."""
    p = F.lower(path)
    cond = p.contains(include.lower())
    for e in exclude or ():
        cond = cond & ~p.contains(e.lower())
    return cond


def filter_paths(df: DataFrame, path_col: str = "path", include: str = DEFAULT_INCLUDE, exclude=DEFAULT_EXCLUDE):
    """Split rows by path: ``(selected, others)``."""
    cond = path_selected(F.col(path_col), include, exclude)
    return df.where(cond), df.where(~cond | F.col(path_col).isNull())


def normalise_text(df: DataFrame, content_col: str = "content", out_col: str = "text", strip_bom: bool = True):
    """Decode raw bytes (BOM aware) and normalise line endings."""
    return df.withColumn(out_col, normalise_newlines(decode_bom(F.col(content_col), strip_bom=strip_bom)))
