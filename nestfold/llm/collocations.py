"""Phrase collocation mining by direct-address tiling."""

from __future__ import annotations

import math
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestfold.llm.common import discard, store, table
from nestfold.llm.files import arrow_schema, batch_of
from nestfold.llm.registry import register

#: What parts pieces, what parts words inside a piece.
PIECES, SPACE = rb".,;:!?" + bytes(range(0x0A, 0x0E)), b" \t"
#: A-Z in lower case, every piece end a line feed, every word end a space.
TABLE = bytes(10 if c in PIECES else 32 if c in SPACE else c + 32 if 65 <= c <= 90 else c for c in range(256))

#: Words per chunk of text, the unit that is coded and counted at once. A chunk
#: ends with a document, so it may be longer by one.
CHUNK = 1 << 21
#: Entries of all chunks that one bucket holds; a task adds up a bucket at a time.
BUCKET = 1 << 21
#: A tile has TILE x TILE counters. Tiles among the first HEAD x HEAD are counted
#: in them if they hold a pair for every DENSE of their counters; all other
#: pairs are sorted.
TILE, HEAD, DENSE = 512, 64, 8
#: Bytes of one text that are split at a time.
SEGMENT = 1 << 22
#: Parts in which a language's phrases are ranked before they are ranked together.
PARTS = 256

#: A chunk's codes, or the different words of one language in it (numbers, words, counts).
WORDS = "chunk long, size long, tokens long, lang string, nos binary, words binary, n binary, codes binary"
#: A chunk's codes, or its pairs of one bucket: numbered from ``first``, lefts, rights, counts.
PAIRS = "chunk long, size long, bucket long, first long, lefts binary, rights binary, n binary, codes binary"
#: Ids of a chunk's entries (-1 for rare ones), or one frequent symbol.
NAMED = "chunk long, size long, nos binary, ids binary, id long, lang string, word string, left long, right long, total long"
BREAK, EMPTY = -1, -2


def pack(values: np.ndarray, steps: bool = False) -> bytes:
    """Integers, or the steps between them, compressed."""
    values = np.diff(values, prepend=values.dtype.type(0)) if steps else values
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, n: int, kind, steps: bool = False) -> np.ndarray:
    values = np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd"), kind)
    return np.cumsum(values, dtype=kind) if steps else values


def _sized(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _lines(data: bytes) -> list[bytes]:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True).split(b"\n")


class _Numbers(dict):
    """Numbers words, in one chunk, in the order they are first met."""

    def __init__(self, chunk: list):
        super().__init__({b"": EMPTY, b"\n": BREAK})
        self.chunk, self.words, self.nos = chunk, [], []

    def __missing__(self, word):
        self[word] = n = self.chunk[0]
        self.chunk[0] += 1
        self.words.append(word)
        self.nos.append(n)
        return n


def _segments(text: bytes):
    """``text`` in parts that end where a word ends."""
    at, seek = 0, re.compile(rb"[ \n]").search
    while len(text) - at > SEGMENT and (end := seek(text, at + SEGMENT)):
        yield text[at : end.start()]
        at = end.start()
    yield text[at:]


def code_words(docs: DataFrame, lang_col: str, text_col: str, chunk_words: int = CHUNK) -> DataFrame:
    """Chunks of text as word numbers of the chunk (-1 between pieces), and the
    chunk's words with their counts: rows of ``WORDS``."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        met, kinds, codes, size = [0], {}, [], 0

        def flush():
            nonlocal number, met, kinds, codes, size
            if met[0]:
                flat = np.concatenate(codes)
                n = np.bincount(flat[flat >= 0], minlength=met[0])
                rows = [(number, len(flat), 0, None, None, None, None, pack(flat))]
                for lang, k in kinds.items():
                    nos = np.array(k.nos, np.int32)
                    rows.append((number, len(nos), int(n[nos].sum()), lang, pack(nos, True), _sized(b"\n".join(k.words)), pack(n[nos]), None))
                yield batch_of([r for r in rows if r[1]], WORDS)
            number, met, kinds, codes, size = number + 1, [0], {}, [], 0

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                of = kinds.get(lang)
                if of is None:
                    of = kinds[lang] = _Numbers(met)
                for part in _segments(text.as_py().translate(TABLE)):
                    some = np.frombuffer(array("i", map(of.__getitem__, part.replace(b"\n", b" \n ").split(b" "))), np.int32)
                    codes.append(some[some != EMPTY])
                    size += len(codes[-1])
                codes.append(np.full(1, BREAK, np.int32))
                if size >= chunk_words:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.coalesce(F.col(text_col), F.lit("")))
    return rows.mapInArrow(run, WORDS)


def _by_key(batches, key: int):
    """Rows sorted by column ``key`` as lists of all rows of each value."""
    value, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[key] != value:
                if held:
                    yield value, held
                value, held = row[key], []
            held.append(row)
    if held:
        yield value, held


def _ranked(total: np.ndarray, least: int, bucket: int, buckets: int) -> np.ndarray:
    """Ids of a bucket's symbols, -1 for those met fewer than ``least`` times.
    A symbol's rank by frequency in its bucket makes its id, interleaved with
    the ranks of all other buckets, so ids ascend, about, by frequency."""
    frequent = np.flatnonzero(total >= least)
    ids = np.full(len(total), -1, np.int64)
    ids[frequent[np.argsort(-total[frequent], kind="stable")]] = np.arange(len(frequent)) * buckets + bucket
    return ids


def _symbols(ids: np.ndarray, total: np.ndarray, **columns) -> pa.RecordBatch:
    """Rows of ``NAMED`` for the frequent symbols."""
    at = np.flatnonzero(ids >= 0)
    known = {"id": pa.array(ids[at]), "total": pa.array(total[at]), **{k: c.take(pa.array(at)) for k, c in columns.items()}}
    fields = arrow_schema(NAMED)
    return pa.RecordBatch.from_arrays([known.get(f.name, pa.nulls(len(at), f.type)) for f in fields], schema=fields)


def name_words(coded: DataFrame, least: int, buckets: int) -> DataFrame:
    """The words of all chunks by buckets of their hash: each chunk's words get
    their ids, and each frequent word its row (``NAMED``)."""
    deal = "bucket long, chunk long, lang string, size long, nos binary, words binary, n binary"

    def split(batches):
        for batch in batches:
            for chunk, size, lang, nos, words, n in zip(*(c.to_pylist() for c in batch.columns)):
                words = _lines(words)
                nos, n = unpack(nos, size, np.int32, True), unpack(n, size, np.int64)
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, size) % buckets
                order = np.argsort(bucket, kind="stable")
                rows = []
                for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    mine = b"\n".join([words[i] for i in at.tolist()])
                    rows.append((int(bucket[at[0]]), chunk, lang, len(at), pack(nos[at], True), _sized(mine), pack(n[at])))
                yield batch_of(rows, deal)

    def add(batches):
        for bucket, rows in _by_key(batches, 0):
            kinds: dict[tuple, int] = {}
            langs, words, codes, counts = [], [], [], []
            for _, _, lang, size, _, data, n in rows:
                own = []
                for w in _lines(data):
                    k = kinds.setdefault((lang, w), len(kinds))
                    if k == len(words):
                        langs.append(lang), words.append(w)
                    own.append(k)
                codes.append(np.array(own, np.int64)), counts.append(unpack(n, size, np.int64))
            total = np.zeros(len(words), np.int64)
            np.add.at(total, np.concatenate(codes), np.concatenate(counts))
            ids = _ranked(total, least, bucket, buckets)
            yield _symbols(ids, total, lang=pa.array(langs, pa.string()), word=pa.array(words, pa.binary()).cast(pa.string()))
            yield batch_of([(chunk, size, nos, pack(ids[c]), *[None] * 6) for (_, chunk, _, size, nos, _, _), c in zip(rows, codes)], NAMED)

    dealt = coded.where("codes IS NULL").select("chunk", "size", "lang", "nos", "words", "n").mapInArrow(split, deal)
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, NAMED)


def count_pairs(left: np.ndarray, right: np.ndarray, kinds: int):
    """Pairs of frequency ranks below ``kinds`` → number of each pair, and the
    left, right and count of each number.

    The plane of pairs is cut into tiles. Frequent words have low ranks, so the
    tiles near the corner are full: each is counted by its address in one dense
    array. The others are sorted and runs are counted."""
    number = np.empty(len(left), np.int32)
    lefts, rights, counts, base = [], [], [], 0
    edge = TILE * HEAD
    tile = np.where((left < edge) & (right < edge), (left // TILE) * HEAD + right // TILE, HEAD * HEAD).astype(np.uint16)
    order = np.argsort(tile, kind="stable")
    ends = np.cumsum(np.bincount(tile, minlength=HEAD * HEAD + 1))
    sizes = np.diff(ends, prepend=0)
    dense = np.flatnonzero(sizes[:-1] * DENSE >= TILE * TILE)
    rest = np.ones(len(left), bool)
    for t in dense.tolist():
        at = order[ends[t] - sizes[t] : ends[t]]
        rest[at] = False
        row, column = t // HEAD * TILE, t % HEAD * TILE
        address = (left[at] - row) * TILE + (right[at] - column)
        held = np.bincount(address, minlength=TILE * TILE)
        met = np.flatnonzero(held)
        place = np.empty(TILE * TILE, np.int32)
        place[met] = np.arange(base, base + len(met))
        number[at] = place[address]
        lefts.append(met // TILE + row), rights.append(met % TILE + column), counts.append(held[met])
        base += len(met)
    at = np.flatnonzero(rest)
    key = left[at].astype(np.int64) * kinds + right[at]
    key, which, held = np.unique(key, return_inverse=True, return_counts=True)
    number[at] = which + base
    lefts.append(key // max(kinds, 1)), rights.append(key % max(kinds, 1)), counts.append(held)
    return number, np.concatenate(lefts), np.concatenate(rights), np.concatenate(counts)


def pair_up(named: DataFrame, coded: DataFrame, buckets: int, last: bool) -> DataFrame:
    """One level up: the symbols of each chunk are ranked by their frequency,
    neighbours in the chunk's codes become pairs, dealt to ``buckets`` by their
    hash, and, unless this is the ``last`` level, the chunk is coded by its
    pairs: rows of ``PAIRS``.

    Neighbouring pairs overlap in all but the outer symbols, so the pairs of
    the next level are phrases one word longer."""
    none = F.lit(None).cast("binary")
    both = named.where("ids IS NOT NULL").select("chunk", F.lit(1).alias("kind"), "size", "nos", F.col("ids").alias("data"))
    both = both.unionByName(coded.where("codes IS NOT NULL").select("chunk", F.lit(0).alias("kind"), "size", none.alias("nos"), F.col("codes").alias("data")))

    def run(batches):
        for chunk, rows in _by_key(batches, 0):
            codes = unpack(rows[0][4], rows[0][2], np.int32)
            if len(rows) == 1:
                continue
            nos = np.concatenate([unpack(r[3], r[2], np.int32, True) for r in rows[1:]])
            ids = np.concatenate([unpack(r[4], r[2], np.int64) for r in rows[1:]])
            nos, ids = nos[ids >= 0], ids[ids >= 0]
            names, which = np.unique(ids, return_inverse=True)  # ids ascend by frequency
            rank = np.full(max(codes.max(initial=-1), nos.max(initial=-1)) + 2, -1, np.int32)  # the last stands for a break
            rank[nos] = which
            ranks = rank[codes]
            at = np.flatnonzero((ranks[:-1] >= 0) & (ranks[1:] >= 0))
            number, left, right, n = count_pairs(ranks[at], ranks[at + 1], len(names))
            left, right = names[left], names[right]
            bucket = ((left * 0x9E3779B1 + right) * 0x85EBCA6B >> 17) % buckets
            order = np.lexsort((right, left, bucket))
            if not last:
                after = np.full(len(ranks), BREAK, np.int32)
                again = np.empty(len(order), np.int32)
                again[order] = np.arange(len(order))
                after[at] = again[number]
                after = after[(after >= 0) | (np.append(0, after[:-1]) >= 0)]
                if len(after):
                    yield batch_of([(chunk, len(after), None, None, None, None, None, pack(after))], PAIRS)
            bucket = bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            for i in range(0, len(cuts), 1024):
                some = []
                for lo, hi in zip(cuts[i : i + 1024], [*cuts[i + 1 : i + 1024], *(cuts[i + 1024 : i + 1025] or [len(order)])]):
                    x = order[lo:hi]
                    some.append((chunk, hi - lo, int(bucket[lo]), lo, pack(left[x], True), pack(right[x]), pack(n[x].astype(np.int64)), None))
                yield batch_of(some, PAIRS)

    return both.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(run, PAIRS)


def name_pairs(coded: DataFrame, least: int, buckets: int, last: bool) -> DataFrame:
    """The pairs of all chunks by buckets: as ``name_words``."""

    def add(batches):
        for bucket, rows in _by_key(batches, 2):
            sizes = [r[1] for r in rows]
            left = np.concatenate([unpack(r[4], r[1], np.int64, True) for r in rows])
            right = np.concatenate([unpack(r[5], r[1], np.int64) for r in rows])
            n = np.concatenate([unpack(r[6], r[1], np.int64) for r in rows])
            if max(left.max(), right.max()) < 1 << 31:
                key, which = np.unique(left << 32 | right, return_inverse=True)
                kinds = key >> 32, key & 0xFFFFFFFF
            else:
                order = np.lexsort((right, left))
                new = np.append(True, (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0))
                which = np.empty(len(order), np.int64)
                which[order] = np.cumsum(new) - 1
                kinds = left[order][new], right[order][new]
            total = np.zeros(len(kinds[0]), np.int64)
            np.add.at(total, which, n)
            ids = _ranked(total, least, bucket, buckets)
            yield _symbols(ids, total, left=pa.array(kinds[0]), right=pa.array(kinds[1]))
            if not last:
                parts = np.split(ids[which], np.cumsum(sizes)[:-1])
                back = [(r[0], r[1], pack(np.arange(r[3], r[3] + r[1], dtype=np.int32), True), pack(p), *[None] * 6) for r, p in zip(rows, parts) if (p >= 0).any()]
                yield batch_of(back, NAMED)

    dealt = coded.where("codes IS NULL").select("chunk", "size", "bucket", "first", "lefts", "rights", "n")
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, NAMED)


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)) in exact decimal arithmetic."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * wide(a) * wide(a), wide(l) * wide(r))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 3, least: int = 10, top: int = 2000, within: int = 50,
                 chunk_words: int = CHUNK, bucket_entries: int = BUCKET) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase is 2 to ``longest`` words of a piece that occur ``least`` times; it
    is cut where it holds together least, ``a * a / (l * r)`` in millionths. A
    phrase inside a longer one that has ``within`` percent of its occurrences
    is left out.

    1. Tasks code their text by word numbers of a chunk. Each chunk's different
       words are dealt by hash to buckets, added up, and come back with ids that
       rank them by frequency.
    2. Level by level, chunks rank the symbols they hold, count neighbours in
       tiles (``count_pairs``) and recode themselves by the pairs; each chunk's
       different pairs are dealt, added up and come back like words. Words and
       pairs below ``least`` end there, as no longer phrase can hold them.
    3. Phrases and their parts meet by shuffle joins. A language's phrases are
       ranked in parts first.

    Entries travel as compressed blocks, one per chunk and bucket; the number
    of buckets follows the number of entries, and a symbol, however frequent,
    has one entry a chunk. Null text is empty; a null language is ``und``.
    Repeated rows count each. An empty table gives no rows; other columns are
    ignored. A long text is split a segment at a time; its word numbers must
    fit a task.
    """
    coded = store(code_words(docs, lang_col, text_col, chunk_words), "collocations-words", packed=True)
    per_lang = store(coded.where("codes IS NULL").groupBy("lang").agg(F.sum("tokens").alias("n")), "collocations-langs")
    entries, tokens = coded.where("codes IS NULL").agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    level = store(name_words(coded, least, max(1, math.ceil(entries / bucket_entries))), "collocations-named", packed=True)
    own = F.array(F.col("total"))
    # heads, tails: counts of the first and of the last 1, 2, ... words
    known = level.where("word IS NOT NULL").select("id", "lang", F.array("word").alias("words"), "total", own.alias("heads"), own.alias("tails"))
    found, kept, buckets = [], [level], max(1, math.ceil(tokens / (2 * bucket_entries)))
    for length in range(2, longest + 1):
        before, last = coded, length == longest
        coded = store(pair_up(level, before, buckets, last), "collocations-pairs", packed=True)
        discard(before)
        level = store(name_pairs(coded, least, buckets, last), "collocations-named", packed=True)
        if last:
            discard(coded)
        kept.append(level)
        phrases = level.where("left IS NOT NULL").select("id", "left", "right", "total")
        first = known.select(F.col("id").alias("left"), "lang", F.col("words").alias("start"), "heads")
        rest = known.select(F.col("id").alias("right"), F.col("words").alias("end"), "tails")
        phrases = phrases.join(first, "left").join(rest, "right")
        known = store(
            phrases.select("id", "left", "right", "lang", F.concat("start", F.slice("end", -1, 1)).alias("words"), "total",
                           F.concat("heads", F.array("total")).alias("heads"), F.concat("tails", F.array("total")).alias("tails")),
            "collocations-known",
        )
        found.append(known)
    discard(*kept)

    ranked = []
    for phrases, longer in zip(found, [*found[1:], None]):
        if longer is not None:
            holds = longer.select(F.explode(F.array("left", "right")).alias("id"), "total").groupBy("id").agg(F.max("total").alias("longer"))
            phrases = phrases.join(holds, "id", "left").where((100 * F.coalesce("longer", F.lit(0))) < within * F.col("total"))
        m = F.size("words")
        cuts = F.transform(
            F.sequence(F.lit(1), m - 1),
            lambda k: F.struct(_score(F.col("total"), F.get("heads", k - 1), F.get("tails", m - k - 1)).alias("score"), k.alias("k"), F.get("heads", k - 1).alias("l"), F.get("tails", m - k - 1).alias("r")),
        )
        ranked.append(phrases.select("lang", F.array_join("words", " ").alias("phrase"), F.col("total").alias("a"), F.array_min(cuts).alias("cut")))
    every = ranked[0]
    for more in ranked[1:]:
        every = every.unionByName(more)
    every = every.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    best = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(per_lang, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


@register(
    "op11_collocations",
    r"""
    WITH p AS (
      SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    g AS (
      SELECT lang, m, array_to_string(w[i + 1 : i + m], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, m, unnest(range(greatest(len(w) - m + 1, 0))) AS i FROM w, (VALUES (1), (2), (3)) AS t(m)) GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE m = 1 GROUP BY lang),
    c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE m > 1 AND f >= 10),
    k AS (SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM c),
    s AS (
      SELECT k.lang, k.m, k.phrase, k.a, k.k, l.f AS l, r.f AS r, (1000000::HUGEINT * k.a * k.a) // (l.f::HUGEINT * r.f) AS score
      FROM k JOIN g AS l ON l.lang = k.lang AND l.m = k.k AND l.phrase = array_to_string(k.w[1 : k.k], ' ')
      JOIN g AS r ON r.lang = k.lang AND r.m = k.m - k.k AND r.phrase = array_to_string(k.w[k.k + 1 :], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    held AS (
      SELECT DISTINCT lang, part FROM (
        SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS part FROM c WHERE m = 3) t
      JOIN (SELECT lang AS lang2, phrase, a AS own FROM c WHERE m = 2) u ON lang2 = lang AND phrase = part WHERE 100 * a >= 50 * own),
    o AS (SELECT b.* FROM b ANTI JOIN held ON held.lang = b.lang AND held.part = b.phrase),
    q AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM o)
    SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM q JOIN n USING (lang) WHERE rank <= 2000
    """,
)
def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
