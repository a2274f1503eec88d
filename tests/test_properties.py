"""Property tests on generated nested JSON: both flatten layouts equal the
brute-force flatteners, the fan-out equals the exploded row count, stacking
is order independent."""

import json
import os
import tempfile
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import bf_explode, bf_indexed
from nestfold.operators.flatten import fanout, flatten
from nestfold.operators.union import union_drift

KEYS = st.sampled_from(["a", "b", "c", "d"])


def schemas(depth=0):
    leaf = st.sampled_from([("int",), ("str",)])
    if depth >= 3:
        return leaf
    sub = st.deferred(lambda: schemas(depth + 1))
    return st.one_of(
        leaf,
        st.dictionaries(KEYS, sub, min_size=1, max_size=3).map(lambda d: ("obj", d)),
        sub.map(lambda s: ("arr", s)),
    )


def value(schema):
    kind = schema[0]
    if kind == "int":
        return st.one_of(st.none(), st.integers(-50, 50))
    if kind == "str":
        return st.one_of(st.none(), st.text("xyz", max_size=3))
    if kind == "arr":
        return st.lists(value(schema[1]), max_size=3)
    fields = schema[1]
    return st.fixed_dictionaries({}, optional={k: value(v) for k, v in fields.items()})


@st.composite
def record_sets(draw):
    top = draw(st.dictionaries(KEYS, schemas(), min_size=1, max_size=3))
    recs = draw(st.lists(st.fixed_dictionaries({}, optional={k: value(v) for k, v in top.items()}), min_size=1, max_size=4))
    return [dict(r, id=f"r{i}") for i, r in enumerate(recs)]


def _load(spark, recs):
    d = tempfile.mkdtemp(prefix="nestfold-prop-")
    p = os.path.join(d, "r.json")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n")
    return spark.read.option("primitivesAsString", True).json(p)


def prune(obj, dt):
    """The record as the reader sees it: fields the inferred schema lacks are
    gone (JSON inference drops fields that only ever hold empty objects)."""
    from pyspark.sql.types import ArrayType, StructType

    if isinstance(obj, dict) and isinstance(dt, StructType):
        names = {f.name: f.dataType for f in dt.fields}
        return {k: prune(v, names[k]) for k, v in obj.items() if k in names}
    if isinstance(obj, list) and isinstance(dt, ArrayType):
        return [prune(e, dt.elementType) for e in obj]
    return obj


SETTINGS = settings(max_examples=int(os.environ.get("PROP_EXAMPLES", "12")), deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(recs=record_sets())
def test_explode_equals_brute_force(spark, recs):
    df = _load(spark, recs)
    recs = [prune(r, df.schema) for r in recs]
    flat = flatten(df, prefix="R", on_collision="suffix")
    cols = flat.columns
    got = Counter(tuple(r[c] for c in cols) for r in flat.collect())
    want = Counter(tuple(row.get(c) for c in cols) for rec in recs for row in bf_explode("R", rec))
    assert got == want
    per = {r["id"]: r["n_rows"] for r in fanout(df).select("id", "n_rows").collect()}
    assert per == {rec["id"]: len(bf_explode("R", rec)) for rec in recs}


@SETTINGS
@given(recs=record_sets())
def test_indexed_equals_brute_force(spark, recs):
    df = _load(spark, recs)
    recs = [prune(r, df.schema) for r in recs]
    flat = flatten(df, mode="indexed", on_collision="suffix")
    want = {rec["id"]: dict(bf_indexed(rec)) for rec in recs}
    assert set(flat.columns) == {k for w in want.values() for k in w}
    for r in flat.collect():
        assert {k: v for k, v in r.asDict().items() if v is not None} == want[r["id"]]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(perm=st.permutations([0, 1, 2]))
def test_union_is_order_independent(spark, perm):
    frames = [
        spark.createDataFrame([(1, "x")], "id int, a string"),
        spark.createDataFrame([(2, 2.5)], "id int, b double"),
        spark.createDataFrame([(3, "y", 1.0)], "id int, a string, b double"),
    ]
    u = union_drift([frames[i] for i in perm])
    assert sorted((r.id, r.a, r.b) for r in u.collect()) == [(1, "x", None), (2, None, 2.5), (3, "y", 1.0)]
