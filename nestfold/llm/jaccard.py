"""Exact n-gram Jaccard join of documents by prefix lists with set-relation
skipping, and the components of its links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestfold.llm.common import BROADCAST_ROWS, discard, lookup, store, table
from nestfold.llm.components import connected_components
from nestfold.llm.files import arrow_schema, trimmed
from nestfold.llm.registry import register
from nestfold.llm.slices import added, cut

WORDS = 5
#: Two sets link at PERCENT * union <= 100 * intersection.
PERCENT = 80
#: Counters of the document-frequency sketch: a fixed size, whatever the corpus.
SKETCH_BITS = 20

#: Odd multipliers that combine the word hashes of a shingle.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``k``-word shingles; of its one
    shorter shingle if it has fewer words; none without words. Words are what
    stands between the bytes [\\x20\\x09-\\x0D], with A-Z in lower case, which is
    what ``lower`` and ``split`` do to bytes."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    m = min(k, n)
    total = np.full(n - m + 1, np.uint64(m))
    for i in range(m):
        total = _mixed(total + h[i : n - m + 1 + i] * MIX[i % len(MIX)])
    return np.unique(total)


def set_key(s: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def least_overlap(a, b):
    """Smallest intersection of linked sets of sizes ``a`` and ``b``."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


#: Size bands: a set's linked partners that are no larger lie in its own band or
#: the one below, since each bound is at least 100/PERCENT times the one before.
def _bounds() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(-(-100 * out[-1] // PERCENT))
    return np.array(out, np.int64)


BOUNDS = _bounds()


def band_of(size):
    return np.searchsorted(BOUNDS, size, side="right")


DOCS = "doc_id long, n long, key long, slice int, part binary"


def _signed(docs: DataFrame) -> DataFrame:
    """One pass over all texts: a row per document with its set's size and key,
    and rows with slices of each task's sketch: how many distinct sets of the
    task have a shingle whose hash falls on each counter."""

    def run(batches):
        sketch, seen, met = np.zeros(1 << SKETCH_BITS, np.uint64), set(), []
        for batch in batches:
            ids, sizes, keys = batch.column("doc_id"), [], []
            for text in batch.column("text"):
                s = shingles(text.as_py())
                sizes.append(len(s))
                keys.append(set_key(s))
                if keys[-1] not in seen:
                    seen.add(keys[-1])
                    met.append((s & np.uint64(len(sketch) - 1)).astype(np.int64))
                    if len(met) == 4096:
                        sketch += np.bincount(np.concatenate(met), minlength=len(sketch)).astype(np.uint64)
                        met = []
            none = [None] * len(sizes)
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], schema=arrow_schema(DOCS))
        if met:
            sketch += np.bincount(np.concatenate(met), minlength=len(sketch)).astype(np.uint64)
        parts = cut(sketch)
        none = pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], schema=arrow_schema(DOCS))

    return store(docs.mapInArrow(trimmed(run), DOCS), "jaccard-docs")


ENTRY = "token long, band int, key long, size int, pos int"


def _entries(docs: DataFrame, sketch) -> DataFrame:
    """The prefix lists: for each distinct set, its first tokens in the order
    (sketch count, hash), rarest first, with their positions. Two linked sets
    share a token of these prefixes, whatever the order is."""

    def run(batches):
        counts, seen = sketch.value, set()
        for batch in batches:
            cols = [[], [], [], [], []]
            for text in batch.column("text"):
                s = shingles(text.as_py())
                n = len(s)
                if n == 0 or (key := set_key(s)) in seen:
                    continue
                seen.add(key)
                p = n - -(-PERCENT * n // 100) + 1
                c = counts[(s & np.uint64(len(counts) - 1)).astype(np.int64)]
                first = np.argsort(c, kind="stable")[:p]  # hashes are sorted already
                for col, x in zip(cols, (s[first].view(np.int64), np.full(p, band_of(n)), np.full(p, key), np.full(p, n), np.arange(p))):
                    col.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(cols, arrow_schema(ENTRY))], schema=arrow_schema(ENTRY))

    return docs.mapInArrow(trimmed(run), ENTRY)



def _shared(entries: DataFrame) -> DataFrame:
    """The entries of tokens that two sets or more hold; most tokens are met
    once and go here. Lists are read as sorted streams, a row at a time held
    back, so a list of any length costs no memory."""
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartition(n, "token").sortWithinPartitions("token", "key")

    def run(batches):
        last, met = None, False
        for batch in batches:
            a = [np.asarray(c) for c in batch.columns]
            if last is not None:
                a = [np.concatenate([h, x]) for h, x in zip(last, a)]
            token, key = a[0], a[2]
            keep = np.ones(len(token), bool)  # one set met by two tasks
            keep[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            a = [x[keep] for x in a]
            same = a[0][1:] == a[0][:-1]
            more = np.zeros(len(a[0]), bool)
            more[0] = met
            more[:-1] |= same
            more[1:] |= same
            last, met = [x[-1:] for x in a], bool(more[-1])
            more[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(x[more]) for x in a], schema=arrow_schema(ENTRY))
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in last], schema=arrow_schema(ENTRY))

    return store(dealt.mapInArrow(trimmed(run), ENTRY), "jaccard-shared")


def _least(a: Column, b: Column) -> Column:
    return F.ceil(F.lit(PERCENT) * (a + b) / F.lit(100 + PERCENT))


def _possible(a: str, b: str) -> Column:
    """Whether the first common token of two sets may be here, by its position:
    what is left of the shorter rest must reach the overlap they need."""
    c = lambda t, n: F.col(f"{t}.{n}")
    rest = F.least(c(a, "size") - c(a, "pos"), c(b, "size") - c(b, "pos"))
    return (c(a, "key") != c(b, "key")) & (rest >= _least(c(a, "size"), c(b, "size")))


def _leader_pairs(lists: DataFrame) -> DataFrame:
    """For each set one pair with the leader of its blocks, and one with the
    leader of the blocks one band below. A block is a list's entries of one size
    band; its leader is the set where the token stands foremost, the one with
    least of its own before the shared part. Of several leaders, the one met
    in most lists is taken. A set holds few tokens, so nothing here is hot but
    the leaders, which are grouped minima."""
    lead = lists.groupBy("token", "band").agg(F.min(F.struct("pos", "size", "key")).alias("l")).select("token", "band", "l.*")
    both = lead.withColumn("own", F.lit(1)).unionByName(lead.withColumn("band", F.col("band") + 1).withColumn("own", F.lit(0)))
    met = lists.alias("x").join(both.alias("y"), ["token", "band"]).where(_possible("x", "y"))
    votes = met.groupBy(F.col("x.key").alias("a"), F.col("y.key").alias("b"), "own").agg(F.count("*").alias("n"))
    best = votes.groupBy("a", "own").agg(F.max(F.struct("n", "b")).alias("m"))
    return best.select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")).distinct()


def _cross_pairs(lists: DataFrame, member: DataFrame) -> DataFrame:
    """Every pair of sets in different components that a list allows. Blocks
    are skipped whole where all sets share a component, and entries whose
    position rules out even the smallest set of their blocks."""
    known = lists.join(member.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    known = store(known, "jaccard-known")
    front = known.where(F.col("size") - F.col("pos") >= _least(F.col("size"), F.col("size")))
    front = front.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    blocks = front.groupBy("token", "band").agg(F.min("size").alias("smallest"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    open_ = (F.col("r0") != F.col("root")) | (F.col("r1") != F.col("root"))
    floor = F.greatest(F.col("smallest"), F.ceil(F.col("size") * F.lit(PERCENT) / F.lit(100)))
    probes = known.join(blocks, ["token", "band"]).where(open_ & (F.col("size") - F.col("pos") >= _least(F.col("size"), floor)))
    met = probes.alias("x").join(front.alias("y"), ["token", "band"])
    met = met.where((F.col("x.root") != F.col("y.root")) & (F.col("y.size") <= F.col("x.size")) & _possible("x", "y"))
    pairs = met.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
    out = store(pairs, "jaccard-cross")
    discard(known)
    return out


PAIR = "u long, v long"


def _linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs that link, by the whole sets. Texts travel, which take a
    third of the room of their sets; only those of sets in a pair do."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    wanted = store(reps.join(keys, "key"), "jaccard-wanted")
    ids = wanted.select("doc_id").distinct()
    few = wanted.limit(10 * BROADCAST_ROWS + 1).count() <= 10 * BROADCAST_ROWS  # of 16 bytes
    same = F.expr("d.doc_id <=> i.doc_id")
    some = docs.select("doc_id", "text").alias("d").join((F.broadcast(ids) if few else ids).alias("i"), same, "left_semi")

    def keyed(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = [set_key(shingles(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column("text")], schema=arrow_schema("key long, text string"))

    texts = store(some.mapInArrow(trimmed(keyed), "key long, text string").join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "jaccard-texts")
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def check(batches):
        held: dict[int, np.ndarray] = {}

        def get(key, text):
            if key not in held:
                if len(held) >= 512:
                    held.clear()
                held[key] = shingles(text.as_py())
            return held[key]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            yes = []
            for i, (u, v) in enumerate(zip(a, b)):
                x, y = get(u, batch.column("text_a")[i]), get(v, batch.column("text_b")[i])
                common = len(np.intersect1d(x, y, assume_unique=True))
                yes.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yes = np.array(yes, bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)[yes]) for c in (a, b)], schema=arrow_schema(PAIR))

    out = store(both.mapInArrow(trimmed(check), PAIR), "jaccard-links")
    discard(texts, wanted)
    return out


def _listed(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their sets' keys, the distinct sets, their prefix lists."""
    signed = _signed(docs)
    rows = signed.where("slice IS NULL").select("doc_id", "n", "key")
    sets = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("held"))
    sketch = docs.sparkSession.sparkContext.broadcast(added(signed.where("slice IS NOT NULL"), np.uint64, 1 << SKETCH_BITS))
    return rows, store(sets, "jaccard-sets"), _shared(_entries(docs, sketch))


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every link between two distinct sets once: their keys ``a`` < ``b``, the
    smallest ids ``a_id`` and ``b_id`` that hold them, and ``a_held`` and
    ``b_held``, how many rows do. Each pair that the lists allow is compared,
    also inside a component, so the cost grows with the links there are.
    Equal sets are one; a set without shingles has no link."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    _, sets, lists = _listed(docs)
    pairs = _cross_pairs(lists, docs.sparkSession.createDataFrame([], "node long, root long"))
    links = _linked(pairs, docs, sets.select("key", "doc_id")).toDF("a", "b")
    for side in ("a", "b"):
        links = links.join(sets.toDF(side, f"{side}_id", f"{side}_held"), side)
    return links.select("a", "b", "a_id", "b_id", "a_held", "b_held")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``,
    the smallest id reachable over links of Jaccard similarity ``PERCENT`` / 100
    or more between sets of ``WORDS``-word shingles. Exact: no link is missed.

    1. Equal sets are one set from here on, known by a 64-bit hash.
    2. Prefix lists, rarest token first, are indexed by token, size band and
       position; tokens of one set are dropped.
    3. Each set is compared with the leaders of its blocks only. A linked set
       takes its leader's component over, so a group of near copies
       costs one comparison a copy.
    4. What is left are pairs of sets in different components. Blocks of one
       component, sizes and positions that rule a link out are skipped, the
       others are compared.

    Null and empty texts have no shingle and are their own component. A null id
    is left out of the smallest id. Repeated rows link like any copies. An empty
    table gives an empty result. Extra columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, sets, lists = _listed(docs)
    reps = sets.select("key", "doc_id")
    pairs = store(_leader_pairs(lists), "jaccard-pairs")
    links = _linked(pairs, docs, reps)
    member = connected_components(links)
    cross = _cross_pairs(lists, member)
    more = _linked(cross, docs, reps)
    member = connected_components(links.unionByName(more))

    named = sets.join(member.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.sum("held").alias("in_all"))
    entries = named.join(least.where("in_all > 1"), "root").select("key", "held", "component_id")
    entries = store(entries, "jaccard-named")
    discard(lists, pairs, cross, links, more)
    some = lookup(rows.where("n > 0"), entries, "key", "held", rows.count()).select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = some.unionByName(rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


@register(
    "op5_ngram_jaccard",
    r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^ 	-
]+') AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END) AS x FROM d),
    n AS (SELECT d.doc_id, count(x) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
    r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT doc_id, n AS n_shingles, component_id FROM n JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)
    """,
)
def op5_ngram_jaccard(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))
