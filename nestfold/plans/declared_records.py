"""Patient- and encounter-shaped records that fill every declared column, as
nested records of customers and orders.

A field is a path and an expression of the tables' columns that Spark and
DuckDB read alike. ``[]`` marks an array of one element, ``[n]`` one of ``n``
elements, in which ``{i}`` stands for the element's number.
"""

from __future__ import annotations

import re

_ID = "CAST(c_custkey AS STRING)"
_ORDER = "CAST(o_orderkey AS STRING)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_NEXT = "CAST(CAST(o_orderdate AS DATE) + 1 AS STRING)"

PATIENT = {
    "resourceType": "'Patient'",
    "id": _ID,
    "birthDate": "CAST(1930 + c_custkey % 70 AS STRING) || '-07-01'",
    "deceasedDateTime": "CASE WHEN c_custkey % 11 = 0 THEN '2020-01-01T00:00:00Z' END",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END",
    "multipleBirthBoolean": "c_custkey % 40 = 0",
    "text.div": "'<div>' || c_name || '</div>'",
    "text.status": "'generated'",
    "meta.profile[]": "'urn:example:profile:' || c_mktsegment",
    "name[].family": "c_name",
    "name[].given[]": "c_mktsegment",
    "name[].prefix[]": "CASE WHEN c_custkey % 2 = 0 THEN 'Ms.' ELSE 'Mr.' END",
    "name[].use": "'official'",
    "address[].city": "n_name",
    "address[].country": "r_name",
    "address[].line[]": "'Street ' || CAST(c_custkey % 100 AS STRING)",
    "address[].postalCode": "CAST(10000 + c_custkey % 90000 AS STRING)",
    "address[].state": "c_mktsegment",
    "address[].extension[].url": "'urn:example:geolocation'",
    "address[].extension[].extension[].url": "'latitude'",
    "address[].extension[].extension[].valueDecimal": "CAST(c_custkey % 90 AS DOUBLE) / 2",
    "communication[].language.coding[].code": "'en-' || CAST(c_nationkey AS STRING)",
    "communication[].language.coding[].display": "'English of ' || n_name",
    "communication[].language.coding[].system": "'urn:ietf:bcp:47'",
    "communication[].language.text": "'English'",
    "maritalStatus.coding[].code": "CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'S' END",
    "maritalStatus.coding[].display": "CASE WHEN c_custkey % 3 = 0 THEN 'Married' ELSE 'Single' END",
    "maritalStatus.coding[].system": "'urn:example:marital'",
    "maritalStatus.text": "CASE WHEN c_custkey % 3 = 0 THEN 'Married' ELSE 'Single' END",
    "telecom[].system": "'phone'",
    "telecom[].use": "'home'",
    "telecom[].value": f"'555-' || {_ID}",
    "identifier[2].system": "'urn:example:id:' || CAST({i} AS STRING)",
    "identifier[2].value": f"{_ID} || '-' || CAST({{i}} AS STRING)",
    "identifier[2].type.coding[].code": "CASE WHEN {i} = 1 THEN 'MR' ELSE 'SS' END",
    "identifier[2].type.coding[].display": "CASE WHEN {i} = 1 THEN 'Medical Record Number' ELSE 'Social Security Number' END",
    "identifier[2].type.coding[].system": "'urn:example:idtype'",
    "identifier[2].type.text": "'type ' || CAST({i} AS STRING)",
    "extension[].url": "'acctbal'",
    "extension[].valueDecimal": "c_acctbal",
    "extension[].valueString": "c_name",
    "extension[].valueCode": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "extension[].valueAddress.city": "n_name",
    "extension[].valueAddress.country": "r_name",
    "extension[].valueAddress.state": "c_mktsegment",
    "extension[].extension[].url": "'ombCategory'",
    "extension[].extension[].valueString": "c_mktsegment",
    "extension[].extension[].valueCoding.code": "CAST(c_nationkey AS STRING)",
    "extension[].extension[].valueCoding.display": "n_name",
    "extension[].extension[].valueCoding.system": "'urn:example:nation'",
}

ENCOUNTER = {
    "resourceType": "'Encounter'",
    "id": _ORDER,
    "status": "o_orderstatus",
    "class.code": "o_orderpriority",
    "class.system": "'urn:example:priority'",
    "identifier[].system": "'urn:example:orders'",
    "identifier[].use": "'official'",
    "identifier[].value": _ORDER,
    "location[].location.display": "n_name",
    "location[].location.reference": "'Location/' || CAST(c_nationkey AS STRING)",
    "meta.profile[]": "'urn:example:profile:' || o_orderstatus",
    "participant[].individual.display": "'Clerk ' || CAST(o_orderkey % 100 AS STRING)",
    "participant[].individual.reference": "'Clerk/' || CAST(o_orderkey % 100 AS STRING)",
    "participant[].period.start": _DAY,
    "participant[].period.end": _NEXT,
    "participant[].type[].coding[].code": "'PPRF'",
    "participant[].type[].coding[].display": "'primary performer'",
    "participant[].type[].coding[].system": "'urn:example:participation'",
    "participant[].type[].text": "'primary performer'",
    "period.start": _DAY,
    "period.end": _NEXT,
    "serviceProvider.display": "c_mktsegment",
    "serviceProvider.reference": "'Organization/' || c_mktsegment",
    "subject.display": "c_name",
    "subject.reference": "'Customer/' || CAST(o_custkey AS STRING)",
    "type[].coding[].code": "o_orderpriority",
    "type[].coding[].display": "'Priority ' || o_orderpriority",
    "type[].coding[].system": "'urn:example:priority'",
    "type[].text": "o_orderpriority",
}


def _tree(fields: dict[str, str]) -> dict:
    root: dict = {}
    for path, expr in fields.items():
        node = root
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = expr
    return root


def _value(key: str, node, i: int | None) -> str:
    n = re.search(r"\[(\d*)\]$", key)
    if n is None:
        return _struct(node, i)
    numbers = [i] if n[1] == "" else range(1, int(n[1]) + 1)
    return f"array({', '.join(_struct(node, k) for k in numbers)})"


def _struct(node, i: int | None) -> str:
    if isinstance(node, str):
        return node.replace("{i}", str(i))
    fields = ", ".join(f"'{k.split('[')[0]}', {_value(k, v, i)}" for k, v in node.items())
    return f"named_struct({fields})"


def record_columns(fields: dict[str, str]) -> list[str]:
    """The record's top-level columns as SQL expressions."""
    return [f"{_value(k, v, None)} AS {k.split('[')[0]}" for k, v in _tree(fields).items()]


def flat_sql(fields: dict[str, str], columns: list[str], name, source: str) -> str:
    """The flat of the records in SQL: ``name(path)`` gives a path's column; every
    declared column has its expression, arrays of several elements multiply rows."""
    exprs = {name(p): e.replace("{i}", "i.i") for p, e in fields.items()}
    several = {m[1] for p in fields for m in [re.search(r"\[(\d+)\]", p)] if m}
    cross = "".join(f" CROSS JOIN (SELECT unnest(range(1, {int(n) + 1})) AS i) AS i" for n in several)
    return f"SELECT {', '.join(f'CAST({exprs[c]} AS VARCHAR) AS {chr(34)}{c}{chr(34)}' for c in columns)} FROM {source}{cross}"


def explode_name(path: str) -> str:
    return "Patient_" + re.sub(r"\[\d*\]", "", path).replace(".", "_")


def indexed_name(path: str) -> str:
    return path.replace("[]", ".0")


def widths(fields: dict[str, str]) -> dict[str, int]:
    """Positions of every array of the records, by its path."""
    out = {}
    for path in fields:
        for m in re.finditer(r"\[(\d*)\]", path):
            out[path[: m.start()]] = int(m[1] or 1)
    return out
