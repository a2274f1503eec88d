"""Removal of long repeated passages by recompression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestfold.llm.common import discard, store, table
from nestfold.llm.files import arrow_schema
from nestfold.llm.registry import register

WINDOW = 50
#: Rounds of naming. Each names runs of equal symbols, then pairs.
ROUNDS = 3
#: Words that are named together; a document is never parted.
BATCH_WORDS = 1 << 19
#: Different words a worker keeps the hashes of.
HELD_WORDS = 1 << 20

#: Fixed odd multipliers of the hashes.
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
B1, B2 = 0x2545F4914F6CDD1D, 0xA0761D6478BD642F

STRETCHES = "doc long, version long, first int, n int, anchor long, h1 long, h2 long"
WINDOWS = "doc long, s1 long, s2 long, step int, h1 long, h2 long"
#: Comes after every id: the place of rows without one.
LAST = (1 << 63) - 1


def mix(a: np.ndarray, b) -> np.ndarray:
    """A 64-bit name of (a, b)."""
    x = a * K1 ^ (np.atleast_1d(b).astype(np.uint64) + K2) * K3
    x = (x ^ (x >> np.uint64(32))) * K2
    x = (x ^ (x >> np.uint64(29))) * K1
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """Numbers words and hashes each new one to 128 bits."""

    def __init__(self):
        super().__init__()
        self.digests = bytearray()

    def __missing__(self, word):
        self[word] = n = len(self)
        self.digests += xxhash.xxh3_128_digest(word)
        return n

    def hashes(self) -> np.ndarray:
        return np.frombuffer(bytes(self.digests), "<u8").reshape(-1, 2)


class Level:
    """Symbols that part a row of words: ``name``, ``at`` (first word), and the
    words ``lo`` to ``hi`` that decide that the symbol is there, its own and
    some beside it. ``end`` marks the ends of documents, each a symbol for ever."""

    def __init__(self, name, at, lo, hi, end):
        self.name, self.at, self.lo, self.hi, self.end = name, at, lo, hi, end

    def runs(self) -> Level:
        """Maximal runs of a symbol become one symbol. A symbol, also one that
        stands alone, is known to be maximal by its neighbours."""
        same = (self.name[1:] == self.name[:-1]) & ~self.end[1:] & ~self.end[:-1]
        head = np.flatnonzero(np.append(True, ~same))
        n = np.diff(head, append=len(self.name))
        end = self.end[head]
        name = np.where(n > 1, mix(self.name[head], n), self.name[head])
        lo = np.where(end, self.lo[head], self.lo[np.maximum(head - 1, 0)])
        hi = np.where(end, self.hi[head], self.hi[np.minimum(head + n, len(self.name) - 1)])
        return Level(name, self.at[head], lo, hi, end)

    def pairs(self, salt: int) -> Level:
        """Names fall into a left and a right half by a bit of their hash; a left
        symbol before a right one becomes one symbol with it. A left symbol that
        stays alone does so because of the next one, a right one because of the
        one before."""
        side = (mix(self.name, salt) & np.uint64(1)).astype(bool)
        left, right = side & ~self.end, ~side & ~self.end
        joined = np.append(left[:-1] & right[1:], False)
        second = np.append(False, joined[:-1])
        head = np.flatnonzero(~second)
        after = np.minimum(head + 1, len(self.name) - 1)
        both, alone_left, alone_right = joined[head], left[head] & ~joined[head], right[head]
        name = np.where(both, mix(self.name[head], self.name[after]), self.name[head])
        lo = np.where(alone_right, self.lo[np.maximum(head - 1, 0)], self.lo[head])
        hi = np.where(both | alone_left, self.hi[after], self.hi[head])
        return Level(name, self.at[head], lo, hi, self.end[head])


def levels(names: np.ndarray, end: np.ndarray, rounds: int) -> list[Level]:
    at = np.arange(len(names))
    out = [Level(names, at, at, at + 1, end)]
    for r in range(rounds):
        out.append(out[-1].runs().pairs(r))
    return out


def _most(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The largest of ``values[first..last]`` for each range, none of them empty."""
    span = (last - first + 1).astype(np.int64)
    step = np.frexp(span.astype(float))[1] - 1  # floor of the logarithm
    out, now, k = np.zeros(len(first), np.uint64), values, 0
    while True:
        at = np.flatnonzero(step == k)
        out[at] = np.maximum(now[first[at]], now[last[at] - (1 << k) + 1])
        if k >= step.max(initial=0):
            return out
        now = np.maximum(now[: len(now) - (1 << k)], now[1 << k :])
        k += 1


def anchors(levels_: list[Level], starts: np.ndarray, window: int) -> np.ndarray:
    """One symbol for each window, chosen by nothing but the window's own words:
    of the symbols that those words decide, at the highest level that has one,
    the longest, ties by hash. So equal windows have equal anchors. A word
    decides itself, so every window has one."""
    out = np.zeros(len(starts), np.uint64)
    todo = np.arange(len(starts))
    for k in reversed(range(len(levels_))):
        v = levels_[k]
        length = np.minimum(np.diff(v.at, append=v.at[-1] + 1), 255).astype(np.uint64)
        value = (length << np.uint64(56)) | (mix(v.name, 1000 + k) >> np.uint64(8))
        s = starts[todo]
        size = v.at[-1] + window + 2
        first = np.cumsum(np.bincount(v.lo + 1, minlength=size))[s]  # symbols with lo < s
        last = np.cumsum(np.bincount(v.hi, minlength=size))[s + window] - 1  # symbols with hi <= s + window
        met = first <= last
        out[todo[met]] = _most(value, first[met], last[met])
        todo = todo[~met]
        if not len(todo):
            break
    return out


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Rolling:
    """128-bit hashes of any stretch of words."""

    def __init__(self, hashes: np.ndarray):
        self.sums = []
        for column, base in zip(hashes.T, (B1, B2)):
            up, down = _powers(base, len(column) + 1)
            self.sums.append((np.append(np.uint64(0), np.cumsum(column * up[:-1])), down))

    def of(self, first: np.ndarray, words) -> list[np.ndarray]:
        return [mix((total[first + words] - total[first]) * down[first], words) for total, down in self.sums]


class _Texts:
    """Documents whose words are hashed together, each followed by an end."""

    def __init__(self):
        self.kinds = _Words()
        self.clear()

    def clear(self):
        self.docs, self.versions, self.codes, self.sizes, self.more, self.held = [], [], [], [], [], 0
        if len(self.kinds) > HELD_WORDS:
            self.kinds = _Words()

    def add(self, doc, version, text: bytes, more=None) -> None:
        words = text.split()
        self.codes.append(np.fromiter(map(self.kinds.__getitem__, words), np.int32, len(words)))
        self.docs.append(doc), self.versions.append(version), self.sizes.append(len(words)), self.more.append(more)
        self.held += len(words)

    def hashed(self):
        """Hashes of all words with an end before, between and after documents,
        where the ends are, and each document's first word."""
        sizes = np.array(self.sizes)
        firsts = np.cumsum(sizes + 1) - sizes
        total = int(sizes.sum()) + len(sizes) + 1
        end = np.zeros(total, bool)
        end[0] = True
        end[firsts + sizes] = True
        hashes = np.empty((total, 2), np.uint64)
        hashes[~end] = self.kinds.hashes()[np.concatenate(self.codes)]
        hashes[end] = np.arange(int(end.sum()), dtype=np.uint64)[:, None]
        return hashes, end, firsts


def _batched(batches, work):
    """Feed rows (doc, version, text, more) to ``work`` by batches of words."""
    texts = _Texts()
    for batch in batches:
        columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())]
        columns.append(batch.column(3).to_pylist() if batch.num_columns > 3 else [None] * batch.num_rows)
        for doc, version, text, more in zip(*columns):
            texts.add(doc, version, text.as_py(), more)
            if texts.held >= BATCH_WORDS:
                yield from work(texts)
                texts.clear()
    if texts.docs:
        yield from work(texts)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def stretches(rows: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``n`` consecutive windows from word ``first`` on that have the same
    anchor, and a hash of all their words: rows of ``STRETCHES``."""

    def work(texts):
        hashes, end, firsts = texts.hashed()
        sizes = np.array(texts.sizes)
        n = np.maximum(sizes - window + 1, 0)
        if not n.any():
            return
        starts = np.repeat(firsts - np.cumsum(n) + n, n) + np.arange(n.sum())
        owner = np.repeat(np.arange(len(n)), n)
        anchor = anchors(levels(hashes[:, 0].copy(), end, rounds), starts, window)
        head = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
        count = np.diff(head, append=len(starts))
        h1, h2 = Rolling(hashes).of(starts[head], count + window - 1)
        own = owner[head]
        docs, versions = np.array(texts.docs, np.int64)[own], np.array(texts.versions, np.int64)[own]
        columns = [pa.array(docs), pa.array(versions), pa.array((starts[head] - firsts[own]).astype(np.int32)), pa.array(count.astype(np.int32)), _signed(anchor[head]), _signed(h1), _signed(h2)]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema(STRETCHES))

    return rows.mapInArrow(lambda batches: _batched(batches, work), STRETCHES)


def windows_of(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every window of the stretches listed in the fourth column of ``rows``
    (``first``, ``n`` and the hash ``h1``, ``h2`` of each), with the stretch's hash,
    its ``step`` in the stretch and its own hash: rows of ``WINDOWS``."""

    def work(texts):
        hashes, _, firsts = texts.hashed()
        rolling = Rolling(hashes)
        for doc, begin, listed in zip(texts.docs, firsts.tolist(), texts.more):
            first, n, s1, s2 = (np.array([x[k] for x in listed], np.int64) for k in ("first", "n", "h1", "h2"))
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            h1, h2 = rolling.of(np.repeat(first, n) + step + begin, window)
            columns = [pa.array(np.full(len(step), doc)), pa.array(np.repeat(s1, n)), pa.array(np.repeat(s2, n)), pa.array(step.astype(np.int32)), _signed(h1), _signed(h2)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema(WINDOWS))

    return rows.mapInArrow(lambda batches: _batched(batches, work), WINDOWS)


def _kept(rows: DataFrame, kind: str, window: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` of rows (id, text, listed
    stretches of windows to remove)."""
    schema = f"doc_id {kind}, n_words long, n_removed long, kept string"

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, listed in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                words = text.as_py().split()
                n_words.append(len(words))
                if listed:
                    change = np.zeros(len(words) + 1, np.int32)
                    np.add.at(change, [x["first"] for x in listed], 1)
                    np.add.at(change, [x["first"] + x["n"] + window - 1 for x in listed], -1)
                    stay = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                    n_removed.append(len(words) - len(stay))
                    words = [words[i] for i in stay.tolist()]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words))
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_removed`` and
    ``kept``, the words that stay, joined by spaces.

    A word goes if a window of ``window`` consecutive words that covers it
    also starts in a row with a smaller id.

    1. Naming: tasks recompress their texts. In each round, runs of equal
       symbols and then pairs get a name, a 64-bit hash of the parts' names, so
       all tasks give equal words equal names and no round needs an exchange of
       names. Each symbol knows which words decide it; a window's anchor is
       a symbol that its own words decide. Neighbouring windows with the same
       anchor form a stretch.
    2. Sharing: stretches are grouped by a 128-bit hash of their words, then by
       anchor. A stretch that a smaller id has goes as a whole, and an anchor
       that one id alone has reveals no repeat.
    3. Verification: where one anchor has different stretches, as at the ends of
       a repeated passage, every window of each different stretch is hashed, in
       one place of the smallest id, and windows are grouped by hash; the
       windows to remove come back to every place of the stretch there.
    4. The stretches and windows to remove meet their texts.

    Groupings combine on the map side and return to their rows by joins, so no
    group is gathered, however often a passage occurs. Words are compared by
    128-bit hashes. Null text has no words. Rows with a null id come after all
    others; rows with the same id take nothing from one another. An empty table
    gives no rows; extra columns are ignored. ``id_col`` must hold integers. A
    text must fit a task.
    """
    kind = docs.schema[id_col].dataType
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    rows = docs.select(place.alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))
    met = store(stretches(rows, window, rounds), "repeats-stretches")

    where = F.struct("doc", "version", "first", "n", "anchor")
    kinds = met.groupBy("h1", "h2").agg(F.min(where).alias("least"), F.max("doc").alias("last"))
    kinds = store(kinds.select("h1", "h2", "least.*", "last"), "repeats-kinds")
    shared = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("doc").alias("low"), F.max("last").alias("high"))
    shared = shared.where("kinds > 1 AND low < high").select("anchor")

    look = kinds.join(shared, "anchor", "left_semi").groupBy("doc", "version").agg(F.collect_list(F.struct("first", "n", "h1", "h2")).alias("listed"))
    hashed = store(windows_of(rows.join(look, ["doc", "version"]).select("doc", "version", "text", "listed"), window), "repeats-windows")
    earlier = hashed.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("last")).where("least < last")
    steps = hashed.join(earlier, ["h1", "h2"]).where("doc > least").groupBy(F.col("s1").alias("h1"), F.col("s2").alias("h2")).agg(F.collect_list("step").alias("steps"))

    # a stretch goes wherever it is not in its smallest id; there, those of its windows that a smaller id has go
    again = kinds.select("h1", "h2", F.col("doc").alias("least"), "last").join(steps, ["h1", "h2"], "left").where("least < last OR steps IS NOT NULL")
    one = F.transform("steps", lambda x: F.struct((F.col("first") + x).alias("first"), F.lit(1).alias("n")))
    part = F.when(F.col("doc") > F.col("least"), F.array(F.struct("first", "n"))).otherwise(one)
    gone = met.join(again, ["h1", "h2"]).select("doc", "version", F.explode(part).alias("part"))
    gone = gone.groupBy("doc", "version").agg(F.collect_set("part").alias("listed"))
    gone = store(gone, "repeats-gone")
    discard(met, kinds, hashed)
    full = docs.select(F.col(id_col).alias("doc_id"), place.alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))
    full = full.join(gone, ["doc", "version"], "left").select("doc_id", "text", "listed")
    return _kept(full, kind.simpleString(), window).withColumnRenamed("doc_id", id_col)


@register(
    "op13_substring_dedup",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (SELECT doc_id, p, array_to_string(w[p + 1 : p + 50], ' ') AS x
      FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 49, 0))) AS p FROM d)),
    m AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY x) AS least FROM g),
    c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM m WHERE least < doc_id),
    r AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
    k AS (
      SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS kept
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d) AS e ANTI JOIN c ON c.doc_id = e.doc_id AND c.i = e.i GROUP BY e.doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
    """,
)
def op13_substring_dedup(spark, sf_dir):
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
