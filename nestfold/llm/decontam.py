"""Benchmark decontamination over a positional inverted index. DataFrame
functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestfold.llm.common import ascii_lower, fits, store, table
from nestfold.llm.registry import register

#: Fixed value: what separates words, after A-Z are in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Posting lists intersected before the exact check: those of a window's rarest terms.
ANCHORS = 2
#: Percent of a window's words that a near match holds, and its rarest terms that
#: must meet before its text is looked at.
SHARE, MET = 80, 3
#: Bytes of text that a task compares with the items' rarest terms. A word may stand
#: for places of many items, so a task groups several times the size of its texts.
NEAR_BYTES = 2 << 20
#: Stands behind each document's last word; no word is empty.
STOP = ""


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """Distinct windows of ``n`` consecutive words (all words of a shorter text):
    ``wid``, ``phrase``, ``len`` and ``items``, the ids of texts that hold it."""
    words = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    each = F.when(F.size("w") < n, F.array("w")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0))), lambda i: F.slice("w", i + 1, n)))
    rows = words.select("item", F.explode(each).alias("w")).select("item", F.array_join("w", " ").alias("phrase"), F.size("w").alias("len"))
    return rows.groupBy("phrase", "len").agg(F.collect_set("item").alias("items")).withColumn("wid", F.xxhash64("phrase"))


def terms_of(windows: DataFrame) -> DataFrame:
    """``wid``, ``offset``, ``term`` of each word of each window."""
    return windows.select("wid", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the postings ``doc``, ``version``, ``pos``, ``term`` of ``docs``: one
    row per word, with each document's length as the position of ``STOP``.

    ``vocabulary(term)`` limits the index to terms that will be asked for.
    ``version`` is a hash of the text, so rows that share an id keep apart
    unless their texts agree. Postings stay in the partitions of their
    documents: no list is gathered, however common its term is.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"), words_of(F.col(text_col)).alias("w"))
    posts = rows.select("doc", "version", F.posexplode(F.concat("w", F.array(F.lit(STOP)))).alias("pos", "term"))
    if vocabulary is not None:
        spark = docs.sparkSession
        wanted = vocabulary.select("term").unionByName(spark.range(1).select(F.lit(STOP).alias("term"))).distinct()
        posts = posts.join(few(wanted), "term", "left_semi").select("doc", "version", "pos", "term")
    return store(posts, "decontam-index")


def counts_of(index: DataFrame) -> DataFrame:
    """``term``, ``n``: how often each term of the index occurs."""
    return store(index.where(F.col("term") != STOP).groupBy("term").agg(F.count("*").alias("n")), "decontam-counts")


def _anchors(counts: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """``wid``, ``offset``, ``term`` of the ``k`` rarest terms of each window that
    can occur at all: windows with a term that no document has drop out."""
    terms = terms_of(windows).join(counts, "term", "left")
    order = Window.partitionBy("wid").orderBy("n", "term", "offset")
    ranked = terms.withColumn("rank", F.row_number().over(order)).withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("wid")))
    return ranked.where((F.col("rank") <= k) & (F.col("least") > 0)).select("wid", "offset", "term", "rank")


def _hits(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """Posting lists of the anchors, each moved by the term's offset: ``doc``,
    ``version``, ``wid``, ``start``, ``rank``."""
    met = index.join(few(anchors), "term").where("pos >= offset")
    return met.select("doc", "version", "wid", (F.col("pos") - F.col("offset")).alias("start"), "rank")


def phrase_candidates(index: DataFrame, windows: DataFrame, k: int = ANCHORS, counts: DataFrame | None = None) -> DataFrame:
    """Places where the lists of a window's ``k`` rarest terms intersect after
    adjusting for the offsets: ``doc``, ``version``, ``wid``, ``start``.
    ``counts`` is ``counts_of(index)`` where that is stored already."""
    anchors = store(_anchors(counts_of(index) if counts is None else counts, windows, k), "decontam-anchors")
    need = anchors.groupBy("wid").agg(F.count("*").alias("need"))
    met = _hits(index, anchors).groupBy("doc", "version", "wid", "start").agg(F.count("*").alias("got"))
    return met.join(few(need), "wid").where("got >= need").select("doc", "version", "wid", "start")


def proximity_matches(docs: DataFrame, index: DataFrame, items: DataFrame, n: int = WINDOW, slack: int = 5, share: int = SHARE, k: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """Documents and windows of items where ``share`` percent of all words of the
    window stand within ``slack`` words of their places, on as many words of the
    text: ``doc``, ``version``, ``wid``. A term that no document has counts as
    missing. ``index`` is that of ``docs``, ``counts`` its ``counts_of`` where
    that is stored already.

    If ``len - need`` words of a window may be missing, ``MET`` of its ``len -
    need + MET`` rarest stand there (``k`` looks at more). Neighbouring windows share
    their words, so lists are intersected once an item: places of its windows'
    rarest terms, each moved by the term's place in the item, that fall within
    a stretch of the text. A group of them is five numbers, however many meet;
    a task has the groups of ``NEAR_BYTES`` of text, however large the corpus.
    The words around are then cut out of their texts; if they hold enough of
    the item's words at all, each window is compared with each start between
    the terms met."""
    spread = 2 * slack + 1
    texts = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), words_of(F.col(item_text)).alias("v")).where(F.size("v") > 0)
    texts = store(texts.distinct().withColumn("len", F.least(F.size("v"), F.lit(n))).withColumn("need", F.ceil(F.col("len") * share / 100).cast("int")), "decontam-items")
    counts = counts_of(index) if counts is None else counts
    each = texts.withColumn("j", F.explode(F.sequence(F.lit(0), F.size("v") - F.col("len"))))
    each = each.select("item", "j", "len", "need", F.xxhash64("v").alias("text"), F.posexplode(F.slice("v", F.col("j") + 1, F.col("len"))).alias("offset", "term"))
    rarest = Window.partitionBy("item", "text", "j").orderBy(F.coalesce("n", F.lit(0)), "term", "offset")
    ranked = each.join(counts, "term", "left").withColumn("rank", F.row_number().over(rarest))
    most = F.lit(k) if k else F.col("len") - F.col("need") + MET
    anchors = ranked.where((F.col("rank") <= most) & (F.col("n") > 0)).select("item", "text", (F.col("j") + F.col("offset")).alias("place"), "term", "need").distinct()
    anchors = store(anchors, "decontam-near-anchors")

    # dealt by document as texts: all that follows is grouped where it is made
    own = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"), F.col(text_col).alias("body"))
    posts = own.repartition(near_parts(own), "doc", "version").select("doc", "version", F.posexplode(words_of(F.col("body"))).alias("pos", "term"))
    hits = posts.join(few(anchors), "term").withColumn("start", F.col("pos") - F.col("place"))
    stretch = F.floor(F.col("start") / spread).cast("int")
    met = hits.withColumn("at", F.explode(F.array(stretch - 1, stretch))).groupBy("doc", "version", "item", "text", "need", "at")
    bit = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")  # places of the item, beyond 64 folded
    met = met.agg(F.bit_or(bit).alias("bits"), F.min("place").alias("first"), F.max("place").alias("last"), F.min("start").alias("low"), F.max("start").alias("high"))
    met = met.where(F.bit_count("bits") >= F.least(F.lit(MET), "need"))
    sizes = texts.select("item", F.xxhash64("v").alias("text"), F.size("v").alias("size"), "len")
    met = met.join(few(sizes), ["item", "text"])
    mask = F.expr("shiftleft(1L, len) - 1")
    inside = F.exists(F.sequence(F.lit(0), F.col("size") - F.col("len")), lambda j: F.bit_count(F.call_function("shiftrightunsigned", F.col("bits"), j).bitwiseAND(mask)) >= F.least(F.lit(MET), "need"))
    met = met.where((F.col("size") > 64) | inside).select("doc", "version", "item", "text", "first", "last", "low", "high")
    places = store(met.groupBy("doc", "version").agg(F.collect_set(F.struct("item", "text", "first", "last", "low", "high")).alias("places")), "decontam-places")

    rows = own.alias("t").join(few(places).alias("p"), F.expr("t.doc <=> p.doc AND t.version = p.version")).select("t.doc", "t.version", words_of(F.col("body")).alias("w"), "places")
    found = rows.select("doc", "version", "w", F.explode("places").alias("x")).select("doc", "version", "w", "x.*")
    found = found.join(few(texts.withColumn("text", F.xxhash64("v"))), ["item", "text"])
    # windows that hold a place met, and the stretch of the text where their words may stand
    one, end = F.greatest(F.col("first") - F.col("len") + 1, F.lit(0)), F.least(F.col("last"), F.size("v") - F.col("len"))
    begin = F.greatest(F.col("low") + one - slack, F.lit(0)).cast("int")
    cut = F.slice("w", begin + 1, F.greatest(F.col("high") + end + F.col("len") + slack - begin, F.lit(0)).cast("int"))
    found = found.select("doc", "version", "low", "high", "len", "need", one.alias("one"), end.alias("end"), begin.alias("begin"), cut.alias("w"), "v")
    # windows that have enough of their words anywhere around
    there = F.transform(F.slice("v", F.col("one") + 1, F.col("end") - F.col("one") + F.col("len")), lambda x: F.array_contains("w", x).cast("int"))
    held = lambda t, j: F.aggregate(F.slice(t, j - F.col("one") + 1, F.col("len")), F.lit(0), lambda a, x: a + x)
    js = F.get(F.transform(F.array(there), lambda t: F.filter(F.sequence("one", "end"), lambda j: held(t, j) >= F.col("need"))), F.lit(0))
    # stored, as a filter would have the optimizer write the whole expression again for each use
    found = store(found.where("one <= end").withColumn("js", js), "decontam-near").where(F.size("js") > 0)
    near = lambda s, i: F.filter(F.sequence(s + i - slack, s + i + slack), lambda p: F.get("w", (p - F.col("begin")).cast("int")) == F.get("v", i))
    served = lambda s: F.transform(F.sequence("one", F.col("end") + F.col("len") - 1), lambda i: near(s, i))
    full = lambda lists: F.least(F.size(F.filter(lists, lambda x: F.size(x) > 0)), F.size(F.array_distinct(F.flatten(lists)))) >= F.col("need")
    windows = lambda lists: F.filter("js", lambda j: full(F.slice(lists, j - F.col("one") + 1, F.col("len"))))
    matched = F.flatten(F.transform(F.sequence("low", "high"), lambda s: F.get(F.transform(F.array(served(s)), windows), F.lit(0))))
    found = found.select("doc", "version", "v", "len", F.explode(F.array_distinct(matched)).alias("j"))
    return found.select("doc", "version", F.xxhash64(F.array_join(F.slice("v", F.col("j") + 1, F.col("len")), " ")).alias("wid")).distinct()


def near_parts(texts: DataFrame) -> int:
    """Tasks over ``body``, of ``NEAR_BYTES`` each. A number that is given stays:
    partitions joined by their size as texts would hold groups beyond memory."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("body").cast("long")), F.lit(0))).first()[0]
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / NEAR_BYTES))


def few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df) else df


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, near: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_hit``,
    ``n_items``, ``items`` (ids as strings, sorted) and ``contaminated``; with
    ``near`` also ``n_near``, the number of windows that ``proximity_matches``
    finds in the text, exact ones among them.

    1. Index the positions of every benchmark term in every document.
    2. For each window of the benchmark, intersect the offset-adjusted lists of
       its rarest terms over the corpus.
    3. Compare the words at each place found with the whole window.

    A word is hit when it lies in an occurrence of a window. Null text has no
    words; an item without words has no window; an item with a null id is left
    out. Rows that repeat an id are judged each by its own text; a null id is
    an id like others. Empty ``docs`` give no rows; without items nothing is
    hit. Extra columns are ignored.
    """
    windows = store(windows_of(items, n=n), "decontam-windows")
    index = build_index(docs, terms_of(windows).select("term"), id_col, text_col)
    counts = counts_of(index)
    found = phrase_candidates(index, windows, counts=counts)
    found = found.join(few(windows), "wid")
    found = found.groupBy("doc", "version").agg(F.collect_set(F.struct("start", "len", "phrase", "items")).alias("found"))

    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"), F.col(text_col).alias("text"))
    same = F.expr("t.doc <=> f.doc AND t.version = f.version")
    checked = texts.alias("t").join(found.alias("f"), same).select("t.doc", "t.version", "found", words_of(F.col("text")).alias("w"))
    real = F.filter("found", lambda x: F.array_join(F.slice("w", x["start"] + 1, x["len"]), " ") == x["phrase"])
    checked = checked.select("doc", "version", F.sort_array(real).alias("real")).where(F.size("real") > 0)
    covered = F.aggregate(
        "real",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["start"] + x["len"] - F.greatest(a["end"], x["start"]))).alias("n"),
            F.greatest(a["end"], x["start"] + x["len"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    names = F.array_sort(F.transform(F.array_distinct(F.flatten(F.transform("real", lambda x: x["items"]))), lambda i: i.cast("string")))
    hit = checked.select("doc", "version", covered.cast("long").alias("n_hit"), names.alias("items")).dropDuplicates(["doc", "version"])
    hit = store(hit, "decontam-hit")

    ends = index.where(F.col("term") == STOP).select("doc", "version", F.col("pos").cast("long").alias("n_words"))
    both = ends.alias("e").join(hit.alias("h"), F.expr("e.doc <=> h.doc AND e.version = h.version"), "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_near = []
    if near:
        close = proximity_matches(docs, index, items, n, id_col=id_col, text_col=text_col, counts=counts).groupBy("doc", "version").agg(F.count_distinct("wid").alias("n_near"))
        both = both.join(store(close, "decontam-near").alias("c"), F.expr("e.doc <=> c.doc AND e.version = c.version"), "left")
        n_near = [F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")]
    return both.select(
        F.col("e.doc").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        items_of.alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        *n_near,
    )


@register(
    "op1_decontaminate",
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    v AS (
      SELECT DISTINCT item_id, array_to_string(x, ' ') AS phrase, len(x) AS n FROM (
        SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w] ELSE list_transform(range(len(w) - 9), lambda i: w[i + 1 : i + 10]) END) AS x
        FROM b WHERE len(w) > 0)),
    s AS (SELECT DISTINCT n FROM v),
    g AS (
      SELECT doc_id, s.n, unnest(range(greatest(len(w) - s.n + 1, 0))) AS p, w FROM d, s),
    h AS (SELECT doc_id, p, g.n, item_id FROM g JOIN v ON v.n = g.n AND array_to_string(g.w[p + 1 : p + g.n], ' ') = v.phrase),
    c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
    i AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h) GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
    """,
)
def op1_decontaminate(spark, sf_dir):
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("items", F.sha2(F.array_join("items", ","), 256)).withColumnRenamed("items", "items_sha256")
