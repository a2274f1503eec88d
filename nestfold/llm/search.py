"""Ranked lexical search by dense blocked matrix products."""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestfold.llm.common import discard, store, table
from nestfold.llm.files import arrow_schema
from nestfold.llm.registry import register
from nestfold.llm.slices import added, cut

#: ASCII letters, digits and everything beyond ASCII form terms; A-Z in lower case.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Different terms, summed over the items, of a block of items. Blocks are searched one after the other.
BLOCK_TERMS = 200_000
#: Rows and columns of a tile's product: documents and items.
TILE_DOCS, TILE_ITEMS = 256, 128
#: Partial sums stay below this, so that doubles hold them exactly.
EXACT = 1 << 53
#: No impact reaches this; a column of a tile stands for so many repeats of a term at most.
IMPACT, REPEATS = 1_000_000, 1 << 16
#: Candidates a task keeps before it cuts them to the best.
HELD = 1 << 20
SEGMENT = 1 << 22

#: Rows of a task's statistics (slice, part) and of its blocks of documents:
#: ids and whether they are null, lengths, ends of the terms, terms, occurrences.
CODED = "slice int, part binary, docs binary, null binary, n binary, ends binary, terms binary, tf binary"


def terms_of(text: bytes):
    """Lists of the terms of ``text``, a segment of it at a time."""
    data, at, seek = text.translate(TABLE), 0, re.compile(rb" ").search
    while len(data) - at > SEGMENT and (end := seek(data, at + SEGMENT)):
        yield data[at : end.start()].split()
        at = end.start()
    yield data[at:].split()


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item`` (its id as a string), ``term`` and ``q``, how often it has it."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                seen: dict[bytes, int] = {}
                for part in terms_of(text.as_py()):
                    for t in part:
                        seen[t] = seen.get(t, 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(seen), pa.string()), pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], schema=arrow_schema("item string, term binary, q long"))

    rows = items.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(item_col).cast("string"), F.col(text_col))
    return rows.mapInArrow(run, "item string, term binary, q long").groupBy("item", "term").agg(F.sum("q").alias("q"))


def code_documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Blocks of documents with the occurrences of the terms of ``vocabulary``,
    and each task's number of documents, of terms, and of documents per term."""
    kinds = len(vocabulary)

    def run(batches):
        totals = np.zeros(2 + kinds, np.int64)
        ids, lengths, codes = [], [], []

        def block():
            n = np.array(lengths, np.int64)
            rows = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
            key, tf = np.unique(rows * max(kinds, 1) + np.concatenate(codes), return_counts=True)
            row, term = key // max(kinds, 1), key % max(kinds, 1)
            totals[0] += (n > 0).sum()
            totals[1] += n.sum()
            totals[2:] += np.bincount(term, minlength=kinds)
            ends = np.cumsum(np.bincount(row, minlength=len(n)))
            known = np.array([0 if i is None else i for i in ids], "<i8")
            null = np.array([i is None for i in ids], np.uint8)
            parts = (known, null, n.astype("<i8"), ends.astype("<i8"), term.astype("<i4"), tf.astype("<i8"))
            one = [[-1], [None], *([x.tobytes()] for x in parts)]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(one, arrow_schema(CODED))], schema=arrow_schema(CODED))

        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                n, found = 0, [np.zeros(0, np.int64)]
                for part in terms_of(text.as_py()):
                    n += len(part)
                    some = np.fromiter(map(vocabulary.get, part, repeat(-1)), np.int64, len(part))
                    found.append(some[some >= 0])
                ids.append(doc), lengths.append(n), codes.append(np.concatenate(found))
                held += len(codes[-1])
                if len(ids) == TILE_DOCS or held > SEGMENT:
                    yield block()
                    ids, lengths, codes, held = [], [], [], 0
        if ids:
            yield block()
        parts = cut(totals)
        columns = [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.binary()), *(pa.nulls(len(parts), pa.binary()) for _ in range(6))]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema(CODED))

    return docs.mapInArrow(run, CODED)


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m), with m = 100 - 75 + (75 n N) div L."""
    if int(n.max(initial=0)) * 75 * documents < 1 << 63:
        m = 25 + (75 * documents * n) // length
    else:
        m = np.array([25 + 75 * documents * int(x) // length for x in n], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class ItemTile:
    """Some items over a compact vocabulary: only the terms that they have, in
    groups of columns whose partial sums doubles hold exactly."""

    def __init__(self, items: np.ndarray, rows: list[tuple[int, int, int]], weights: np.ndarray):
        """``rows``: item (position in ``items``), term and repeats."""
        self.items, self.groups = items, []
        # a term that one item repeats very often takes several columns
        rows = [(i, t, min(REPEATS, q - k), k) for i, t, q in rows for k in range(0, q, REPEATS)]
        columns = sorted({(t, k) for _, t, _, k in rows})
        place = {c: j for j, c in enumerate(columns)}
        whole = np.zeros((len(columns), len(items)))
        for i, t, q, k in rows:
            whole[place[t, k], i] = q * weights[t]
        terms = np.array([t for t, _ in columns], np.int64)
        begin, most = 0, np.zeros(len(items))
        for j in range(len(columns) + 1):
            if j == len(columns) or (most + whole[j] * IMPACT).max() >= EXACT:
                if j > begin:
                    self.groups.append((terms[begin:j], whole[begin:j]))
                begin, most = j, np.zeros(len(items))
            if j < len(columns):
                most += whole[j] * IMPACT

    def scores(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, kinds: int) -> np.ndarray:
        """Scores of ``docs`` documents for the items, from the documents' sparse impacts."""
        out = np.zeros((docs, len(self.items)), np.int64)
        for terms, weights in self.groups:
            column = np.full(kinds, -1)
            column[terms] = np.arange(len(terms))  # a term has one column in a group, or equal ones
            at = column[term]
            met = at >= 0
            tile = np.zeros((docs, len(terms)))
            tile[row[met], at[met]] = impact[met]
            again = np.flatnonzero(terms[1:] == terms[:-1])
            for j in again[::-1]:  # repeats of a term beside each other: the last one was filled
                tile[:, j] = tile[:, j + 1]
            out += (tile @ weights).astype(np.int64)
        return out


class Best:
    """The ``k`` best of each item so far: highest score, then smallest id, null
    after all ids. Ties with the last are kept until ids have decided."""

    def __init__(self, items: int, k: int):
        self.k, self.least, self.parts, self.held = k, np.ones(items, np.int64), [], 0

    def add(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        row, column = np.nonzero(scores >= self.least[items])
        self.parts.append((items[column], scores[row, column], null[row], docs[row]))
        self.held += len(row)
        if self.held > HELD:
            self.trim()

    def trim(self):
        columns = [np.concatenate(x) for x in zip(*self.parts)]
        item, score, null, doc = columns
        order = np.lexsort((doc, null, -score, item))
        ranked = item[order]
        keep = order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < self.k]
        item, score = item[keep], score[keep]
        self.parts, self.held = [tuple(c[keep] for c in columns)], len(keep)
        full = np.flatnonzero(np.bincount(item, minlength=len(self.least)) == self.k)
        self.least[full] = score[np.searchsorted(item, full, "right") - 1]  # items ascend, scores descend
        return self.parts[0]


def _search_block(docs: DataFrame, rows: list, top: int) -> DataFrame:
    """The best documents for the items of ``rows`` (item, term, q): ``item``,
    ``doc``, ``score``."""
    names = sorted({r["item"] for r in rows})
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    place = {n: i for i, n in enumerate(names)}
    kinds = len(vocabulary)
    coded = store(code_documents(docs, vocabulary), "search-coded")
    totals = added(coded.where("slice >= 0"), np.int64, 2 + kinds)
    documents, length = int(totals[0]), int(totals[1])
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in totals[2:].tolist()], np.int64)
    by_item: list[list] = [[] for _ in names]
    for r in rows:
        by_item[place[r["item"]]].append((vocabulary[bytes(r["term"])], r["q"]))
    tiles = []
    for lo in range(0, len(names), TILE_ITEMS):
        items = np.arange(lo, min(lo + TILE_ITEMS, len(names)))
        tiles.append(ItemTile(items, [(j, t, q) for j, i in enumerate(items.tolist()) for t, q in by_item[i]], weights))

    def run(batches):
        best = Best(len(names), top)
        for batch in batches:
            for parts in zip(*(c.to_pylist() for c in batch.columns)):
                ids, null, n, ends, term, tf = (np.frombuffer(p, k) for p, k in zip(parts, ("<i8", "u1", "<i8", "<i8", "<i4", "<i8")))
                row = np.repeat(np.arange(len(n)), np.diff(ends, prepend=0))
                impact = impacts(tf, n[row], documents, length) if len(row) else tf
                for tile in tiles:
                    best.add(tile.items, tile.scores(row, term, impact, len(n), kinds), ids, null)
        if best.held:
            item, score, null, doc = best.trim()
            columns = [pa.array([names[i] for i in item.tolist()], pa.string()), pa.array(doc, mask=null.astype(bool)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema("item string, doc long, score long"))

    found = coded.where("slice < 0").select("docs", "null", "n", "ends", "terms", "tf").mapInArrow(run, "item string, doc long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    found = store(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "search-found")
    discard(coded)
    return found


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", top: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Each item's ``top`` documents: ``item_col``, ``rank`` from 1, ``id_col``
    (as a long) and ``score``, above 0, ties by ascending id.

    1. Items are dealt to blocks of about ``block_terms`` terms, which is what
       the driver holds and tasks get. Blocks are searched one after the other,
       each against all documents.
    2. Tasks turn their documents into counts of a block's terms, and add up
       the number of documents and of terms, and of documents per term.
    3. Tasks multiply tiles of document impacts with tiles of item weights, each
       over the few terms its items have, and keep the best of each item. A
       task gives ``top`` rows per item at most; Spark ranks those.

    Scores are exact: products and partial sums are integers below 2**53, and
    parts are added up as 64-bit integers. Null text has no terms. An item with
    a null id is left out; rows that share an item id are one item. Rows that
    repeat a document id are documents each; a null id comes after all others.
    Empty tables give no rows; extra columns are ignored. ``id_col`` must hold
    integers; item ids may be of any type that a cast to string keeps.
    """
    asked = store(item_terms(items, item_col, item_text), "search-items")
    blocks = max(1, math.ceil(asked.count() / block_terms))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = [_search_block(rows, asked.where(block == b).collect(), top) for b in range(blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    kind = items.schema[item_col].dataType
    return out.select(F.col("item").cast(kind).alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")


@register(
    "op12_lexical_search",
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
      SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    q AS (SELECT item_id, term, count(*) AS q FROM b GROUP BY ALL),
    s AS (SELECT count(*) AS nn, sum(len(w))::BIGINT AS ll FROM d WHERE len(w) > 0),
    t AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
    f AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, s GROUP BY term, nn),
    r AS (
      SELECT item_id, doc_id, sum(q.q * f.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * t.n * nn) // ll))))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN f USING (term), s GROUP BY item_id, doc_id),
    k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM r WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
    """,
)
def op12_lexical_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
