"""Flattening of nested records.

Two layouts, both planned from ``df.schema`` on the driver and executed as
plain projections and generators on the executors (no UDF, no shuffle):

* ``mode="explode"`` — every struct is spread into ``parent<sep>child``
  columns; every array is exploded with ``LATERAL VIEW OUTER explode``, so
  sibling arrays multiply rows (a record with arrays of 5 and 9 elements gives
  45 rows) and an empty or null array still gives one row of nulls.
* ``mode="indexed"`` — arrays are spread into positional columns
  ``a.0.b``, ``a.1.b`` …, one output row per input row. The number of
  positions is data dependent, so one aggregation computes every array's
  maximum width (nested widths via ``transform``), and a second one finds the
  candidate columns that are null everywhere so they can be dropped.

The plan is emitted as one SQL statement over the input frame
(``spark.sql(..., df=df)``) rather than as hundreds of Column objects: that
keeps planning a wide schema to a few driver-to-JVM calls.

``fanout`` computes, per row and without exploding, how many rows the
explode layout yields — used to check fan-out and to count rows per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StringType, StructType

from nestfold.functions.jsontext import JSON_WRITE_OPTIONS


def q(name: str) -> Column:
    """Column reference that is safe for names with dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def ident(name: str) -> str:
    """SQL identifier for any column name."""
    return "`" + name.replace("`", "``") + "`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _join(prefix: str | None, name: str, sep: str) -> str:
    return f"{prefix}{sep}{name}" if prefix else name


def _dedupe(names: list[str], on_collision: str) -> list[str]:
    """Names that differ by more than case: columns and Parquet fields that
    differ by case alone can't stand beside each other."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = n.lower()
        if k in seen:
            if on_collision == "error":
                raise ValueError(
                    f"flattened column name {n!r} is produced twice; "
                    "pass on_collision='suffix' or another separator"
                )
            seen[k] += 1
            while f"{k}_{seen[k]}" in seen:
                seen[k] += 1
            n = f"{n}_{seen[k]}"
        seen[n.lower()] = 0
        out.append(n)
    return out


def _is_empty_struct(dt: DataType) -> bool:
    return isinstance(dt, StructType) and len(dt.fields) == 0


_JSON_OPTS = "map(" + ", ".join(f"{_lit(k)}, {_lit(v)}" for k, v in JSON_WRITE_OPTIONS.items()) + ")"


def _leaf_sql(expr: str, dt: DataType, leaf_type: str, bool_style: str) -> str:
    if leaf_type == "native":
        return expr
    if leaf_type != "string":
        raise ValueError("leaf_type must be 'native' or 'string'")
    if isinstance(dt, StringType):
        return expr
    if isinstance(dt, BooleanType) and bool_style == "python":
        return f"CASE WHEN {expr} THEN 'True' WHEN NOT {expr} THEN 'False' END"
    if isinstance(dt, (StructType, ArrayType, MapType)):
        return f"to_json({expr}, {_JSON_OPTS})"
    return f"CAST({expr} AS STRING)"


def _run_sql(df: DataFrame, select: list[tuple[str, str]], tail: str = "") -> DataFrame:
    """``SELECT <expr AS name, ...> FROM df AS __src <tail>`` in one call."""
    cols = ",\n  ".join(f"{e} AS {ident(n)}" for e, n in select)
    sql = f"SELECT\n  {cols}\nFROM __SRC__ AS __src\n{tail}"
    # braces are format fields for spark.sql(..., df=df): escape the text's own
    sql = sql.replace("{", "{{").replace("}", "}}").replace("__SRC__", "{df}")
    return df.sparkSession.sql(sql, df=df)


# ---------------------------------------------------------------- explode mode


def _explode_flatten(df, prefix, sep, on_collision, outer, leaf_type, bool_style) -> DataFrame:
    leaves: list[tuple[str, str, DataType]] = []
    laterals: list[str] = []

    def walk(dt, expr, name):
        if isinstance(dt, StructType):
            for f in dt.fields:
                if not _is_empty_struct(f.dataType):
                    walk(f.dataType, f"{expr}.{ident(f.name)}", _join(name, f.name, sep))
        elif isinstance(dt, ArrayType):
            k = len(laterals)
            laterals.append(
                f"LATERAL VIEW {'OUTER ' if outer else ''}explode({expr}) __nt{k} AS __nf{k}"
            )
            walk(dt.elementType, f"__nt{k}.__nf{k}", name)
        else:
            leaves.append((expr, name, dt))

    for f in df.schema.fields:
        if not _is_empty_struct(f.dataType):
            walk(f.dataType, f"__src.{ident(f.name)}", _join(prefix, f.name, sep))
    names = _dedupe([n for _, n, _ in leaves], on_collision)
    select = [(_leaf_sql(e, dt, leaf_type, bool_style), n) for (e, _, dt), n in zip(leaves, names)]
    return _run_sql(df, select, "\n".join(laterals))


# ---------------------------------------------------------------- indexed mode


def _arrays(schema: StructType):
    """Every array of the schema in pre-order: (id, path steps). Steps are
    ("f", name) for a field and ("e",) for "each element of the array"."""
    out = []

    def rec(dt, steps):
        if isinstance(dt, StructType):
            for f in dt.fields:
                rec(f.dataType, steps + (("f", f.name),))
        elif isinstance(dt, ArrayType):
            out.append((len(out), steps))
            rec(dt.elementType, steps + (("e",),))

    for f in schema.fields:
        rec(f.dataType, (("f", f.name),))
    return out


def _max_size_sql(expr: str, steps: tuple, depth: int = 0) -> str:
    """Largest size, within one row, of the array reached by ``steps`` over
    every position of the arrays enclosing it."""
    for k, step in enumerate(steps):
        if step[0] == "f":
            expr = f"{expr}.{ident(step[1])}"
        else:
            v = f"__e{depth}"
            inner = _max_size_sql(v, steps[k + 1 :], depth + 1)
            return f"array_max(transform({expr}, {v} -> {inner}))"
    return f"size({expr})"


def _path_label(steps: tuple) -> str:
    parts: list[str] = []
    for step in steps:
        if step[0] == "f":
            parts.append(step[1])
        else:
            parts[-1] = parts[-1] + "[]"
    return ".".join(parts)


def array_width_exprs(schema: StructType) -> list[tuple[str, str]]:
    """(path, per-row max size SQL) for every array; path uses ``[]`` for
    array elements, e.g. ``lines[].tags``."""
    out = []
    for _, steps in _arrays(schema):
        out.append((_path_label(steps), _max_size_sql(ident(steps[0][1]), steps[1:])))
    return out


def _indexed_candidates(schema: StructType, widths: dict[int, int]):
    """(name parts, SQL accessor, type) of every positional column, in record
    order: for each array, all fields of element 0, then of element 1, …"""
    out = []
    counter = [0]

    def skip(dt):
        if isinstance(dt, StructType):
            for f in dt.fields:
                skip(f.dataType)
        elif isinstance(dt, ArrayType):
            counter[0] += 1
            skip(dt.elementType)

    def rec(dt, parts, expr):
        if isinstance(dt, StructType):
            for f in dt.fields:
                rec(f.dataType, parts + (f.name,), f"{expr}.{ident(f.name)}")
        elif isinstance(dt, ArrayType):
            aid = counter[0]
            counter[0] += 1
            start = counter[0]
            for i in range(widths.get(aid, 0)):
                counter[0] = start  # nested arrays keep their pre-order ids
                rec(dt.elementType, parts + (str(i),), f"get({expr}, {i})")
            counter[0] = start
            skip(dt.elementType)
        else:
            out.append((parts, expr, dt))

    for f in schema.fields:
        rec(f.dataType, (f.name,), ident(f.name))
    return out


def _agg_first(df: DataFrame, exprs: list[str]):
    """One global aggregation; the result row has columns a0, a1, …"""
    return _run_sql(df, [(e, f"a{i}") for i, e in enumerate(exprs)]).first()


def _indexed_flatten(df, prefix, sep, drop_null_columns, header, on_collision, leaf_type, bool_style, widths=None):
    arrays = _arrays(df.schema)
    if widths is None:
        widths = {}
        if arrays:
            spec = array_width_exprs(df.schema)
            row = _agg_first(df, [f"max({e})" for _, e in spec])
            widths = {i: int(row[f"a{i}"] or 0) for i in range(len(spec))}
    else:
        labels = {_path_label(steps): aid for aid, steps in arrays}
        widths = {labels[p]: w for p, w in widths.items()}
    cands = _indexed_candidates(df.schema, widths)
    names = _dedupe([_join(prefix, sep.join(p), sep) for p, _, _ in cands], on_collision)
    cols = [(e, n, dt) for (_, e, dt), n in zip(cands, names)]
    if cols and (drop_null_columns or header == "first"):
        # limit() alone keeps the first record only before any shuffle
        probe = df.orderBy(F.monotonically_increasing_id()).limit(1) if header == "first" else df
        row = _agg_first(probe, [f"count({e})" for e, _, _ in cols])
        cols = [t for i, t in enumerate(cols) if row[f"a{i}"] > 0]
    select = [(_leaf_sql(e, dt, leaf_type, bool_style), n) for e, n, dt in cols]
    return _run_sql(df, select)


# ---------------------------------------------------------------- public API


def flatten(
    df: DataFrame,
    prefix: str | None = None,
    mode: str = "explode",
    sep: str | None = None,
    leaf_type: str = "native",
    bool_style: str = "json",
    on_collision: str = "error",
    drop_null_columns: bool | None = None,
    header: str = "union",
    outer: bool = True,
    widths: dict[str, int] | None = None,
    materialize: bool = False,
    max_fanout: int | None = None,
) -> DataFrame:
    """Flatten every nested column of ``df``.

    ``prefix`` names the record type (``Patient`` gives ``Patient_name_given``);
    ``sep`` defaults to ``_`` for explode and ``.`` for indexed.
    ``leaf_type="string"`` casts every leaf to text (booleans as ``true`` /
    ``false``, or ``True`` / ``False`` with ``bool_style="python"``).
    ``header="first"`` keeps only the positional columns the first record has
    (the CSV-tool behaviour). ``outer=False`` explodes with inner semantics: a
    row with an empty or null array yields nothing. ``widths`` (indexed only)
    gives the positions per array path (``{"lines": 13, "lines[].tags": 4}``)
    instead of measuring them — required on a stream, where no aggregation can
    run before the projection. ``materialize=True`` (indexed only) first writes
    the input as a reliable checkpoint below ``spark.checkpoint.dir``, so an
    expensive input is computed once instead of once per pass (widths,
    non-null columns, projection). ``max_fanout`` (explode only) measures the
    largest number of rows one record yields (one aggregation) and raises
    instead of exploding when it is exceeded — rows are never dropped.
    """
    if mode == "explode":
        sep = "_" if sep is None else sep
        # without an array each record is one row: nothing to measure
        if max_fanout is not None and (max_fanout < 1 or "array<" in df.schema.simpleString()):
            worst = df.agg(F.max(fanout_expr(df)).alias("m")).first()["m"] or 0
            if worst > max_fanout:
                raise ValueError(
                    f"a record explodes to {worst} rows, more than max_fanout={max_fanout}; "
                    "use mode='indexed' or raise the limit"
                )
        out = _explode_flatten(df, prefix, sep, on_collision, outer, leaf_type, bool_style)
        if drop_null_columns:
            out = drop_null_cols(out)
        return out
    if mode == "indexed":
        sep = "." if sep is None else sep
        if materialize and widths is None:
            from nestfold.session import checkpoint_root

            checkpoint_root(df.sparkSession)  # make sure a checkpoint folder is set
            df = df.checkpoint(eager=True)
        drop = (widths is None) if drop_null_columns is None else drop_null_columns
        return _indexed_flatten(df, prefix, sep, drop, header, on_collision, leaf_type, bool_style, widths)
    raise ValueError("mode must be 'explode' or 'indexed'")


def drop_null_cols(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row (one aggregation pass)."""
    fields = df.schema.fields
    if not fields:
        return df
    row = _agg_first(df, [f"count({ident(f.name)})" for f in fields])
    keep = [f.name for i, f in enumerate(fields) if row[f"a{i}"] > 0]
    return df.selectExpr(*[ident(n) for n in keep])


def _has_array(dt: DataType) -> bool:
    if isinstance(dt, ArrayType):
        return True
    if isinstance(dt, StructType):
        return any(_has_array(f.dataType) for f in dt.fields)
    return False


def _rows_sql(expr: str, dt: DataType, depth: int = 0) -> str:
    """SQL for the rows the explode layout produces from value ``expr``."""
    if isinstance(dt, StructType):
        parts = [
            _rows_sql(f"{expr}.{ident(f.name)}", f.dataType, depth) for f in dt.fields if _has_array(f.dataType)
        ]
        return " * ".join(f"({p})" for p in parts) if parts else "1L"
    if isinstance(dt, ArrayType):
        et = dt.elementType
        if _has_array(et):
            v = f"__r{depth}"
            total = f"aggregate(transform({expr}, {v} -> {_rows_sql(v, et, depth + 1)}), 0L, (__a, __b) -> __a + __b)"
        else:
            total = f"CAST(size({expr}) AS BIGINT)"
        return f"greatest(coalesce({total}, 0L), 1L)"
    return "1L"


def fanout_expr(df: DataFrame) -> Column:
    """Per-row number of rows ``flatten(df, mode="explode")`` yields."""
    parts = [_rows_sql(ident(f.name), f.dataType) for f in df.schema.fields if _has_array(f.dataType)]
    return F.expr(" * ".join(f"({p})" for p in parts) if parts else "1L")


def fanout(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.withColumn(name, fanout_expr(df))


def array_widths(df: DataFrame, key: str | None = None, paged: tuple = ()) -> DataFrame:
    """(path, max_width): the largest size of each array path over all rows —
    the number of positions the indexed layout gives it. One aggregation. Rows
    with the same ``key`` are pages of one record: the sizes of its ``paged``
    arrays add up."""
    spec = [(p, e) for p, e in array_width_exprs(df.schema)]
    if key is not None and spec:
        per = df.groupBy(key).agg(*[F.expr(f"{'sum' if p in paged else 'max'}({e})").alias(f"s{i}") for i, (p, e) in enumerate(spec)])
        df, spec = per, [(p, f"s{i}") for i, (p, _) in enumerate(spec)]
    if not spec:
        return df.sparkSession.createDataFrame([], "path string, max_width int")
    agg = df.agg(*[F.expr(f"CAST(coalesce(max({e}), 0) AS INT)").alias(f"w{i}") for i, (_, e) in enumerate(spec)])
    stacked = "explode(array(" + ", ".join(
        f"named_struct('path', {_lit(p)}, 'max_width', w{i})" for i, (p, _) in enumerate(spec)
    ) + ")) AS s"
    return agg.selectExpr(stacked).selectExpr("s.path", "s.max_width")
