"""Nested records built from the declared patient columns, and brute-force
flatteners used as oracles.

A record is the tree of the declared column names; ``LISTS`` says which nodes
are lists. How many elements a list has, which leaves a record lacks and all
values follow from the record's number.
"""

from __future__ import annotations

import json

from nestfold.plans.declared import PATIENT_COLUMNS

# nodes that are lists, with the most elements each may have
LISTS = {
    "address": 2, "address_extension": 1, "address_extension_extension": 3, "address_line": 2,
    "communication": 1, "communication_language_coding": 2, "extension": 4, "extension_extension": 3,
    "identifier": 2, "identifier_type_coding": 1, "maritalStatus_coding": 1, "meta_profile": 1,
    "name": 2, "name_given": 2, "name_prefix": 1, "telecom": 2,
}
ALWAYS = {"id", "resourceType", "text_div"}


def _tree():
    root: dict = {}
    for column in PATIENT_COLUMNS:
        node, parts = root, column.split("_")[1:]
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = None
    return root


def _value(path, seed, at):
    if path == "id":
        return f"p-{seed:04d}"
    if path == "text_div":
        return f"<div>Patient {seed}\nline two</div>"
    if path.endswith("Boolean"):
        return bool(seed % 2)
    if path.endswith("Decimal"):
        return seed + at / 4
    return f"{path.rsplit('_', 1)[-1]} {seed}.{at}"


def _build(node, path, seed, at):
    if path in LISTS:
        n = 1 + (seed * 3 + len(path)) % LISTS[path]
        return [_node(node, path, seed, 10 * at + k) for k in range(n)]
    return _node(node, path, seed, at)


def _node(node, path, seed, at):
    if node is None:
        return _value(path, seed, at)
    out = {}
    for j, (name, sub) in enumerate(sorted(node.items())):
        p = f"{path}_{name}" if path else name
        if sub is not None or p in ALWAYS or (j + seed + at) % 6:
            out[name] = _build(sub, p, seed, at)
    return out


def patients():
    return [_build(_tree(), "", seed, 0) for seed in (1, 2, 3)]


def ndjson(records) -> str:
    return "\n".join(json.dumps(r, sort_keys=True) for r in records) + "\n"


# ------------------------------------------------------------ brute force


def _text(v):
    return v if isinstance(v, str) else json.dumps(v)


def bf_explode(prefix, obj, sep="_"):
    """Rows of the explode layout for one record, as dicts (missing = null):
    objects join their children's rows by cross product, arrays stack their
    elements' rows, an empty array gives one empty row."""
    if isinstance(obj, dict):
        rows = [{}]
        for k in sorted(obj):
            sub = bf_explode(f"{prefix}{sep}{k}" if prefix else k, obj[k], sep)
            rows = [{**a, **b} for a in rows for b in sub]
        return rows
    if isinstance(obj, list):
        if not obj:
            return [{}]
        out = []
        for e in obj:
            out.extend(bf_explode(prefix, e, sep))
        return out
    if obj is None:
        return [{}]
    return [{prefix: _text(obj)}]


def bf_indexed(obj, prefix=""):
    """Ordered (path, text) pairs of the indexed layout for one record."""
    out = []
    if isinstance(obj, dict):
        for k in sorted(obj):
            out.extend(bf_indexed(obj[k], f"{prefix}.{k}" if prefix else k))
    elif isinstance(obj, list):
        for i, e in enumerate(obj):
            out.extend(bf_indexed(e, f"{prefix}.{i}"))
    elif obj is not None:
        out.append((prefix, _text(obj)))
    return out
