"""Phrase mining, ranked search and removal of repeats against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestfold.llm import collocations as co
from nestfold.llm import repeats as rp
from nestfold.llm import search as se

DOCS = "doc_id long, text string, lang string"


def _lower(t):
    return t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# ------------------------------------------------------------------ phrases


def brute_collocations(docs, longest=3, least=10, top=2000, within=50):
    out = []
    for lang in {d[2] if d[2] is not None else "und" for d in docs}:
        f = {}
        for _, text, own in docs:
            if (own if own is not None else "und") == lang:
                for piece in re.split("[.,;:!?\x0a-\x0d]", _lower(text or "")):
                    w = tuple(re.findall("[^\x20\x09]+", piece))
                    for m in range(1, longest + 1):
                        for i in range(len(w) - m + 1):
                            f[w[i : i + m]] = f.get(w[i : i + m], 0) + 1
        n = sum(v for k, v in f.items() if len(k) == 1)
        cand = {k: a for k, a in f.items() if len(k) > 1 and a >= least}
        gone = set()
        for k, a in cand.items():
            for m in range(2, len(k)):
                for i in range(len(k) - m + 1):
                    if 100 * a >= within * f[k[i : i + m]]:
                        gone.add(k[i : i + m])
        rows = []
        for k, a in cand.items():
            if k not in gone:
                score, cut = min((1000000 * a * a // (f[k[:c]] * f[k[c:]]), c) for c in range(1, len(k)))
                rows.append((score, a, " ".join(k), f[k[:cut]], f[k[cut:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(rows[:top])]
    return sorted(out)


def _words(rng, kinds, n):
    return " ".join(rng.choice(kinds) + rng.choice(["", "", "", ".", ",", "\n", "\t"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    kinds = ["The", "the", "of", "a", "ü", "x-y", "\x0b", "naïve", "e", "Of"] + [f"w{i}" for i in range(25)]
    docs = [(i, _words(rng, kinds, rng.choice([1, 5, 80, 300])), rng.choice(["en", "de", None])) for i in range(60)]
    docs += [(60, None, "en"), (61, "", "en"), (62, " \t.,", None), (63, "of the of the of the " * 30, "en"), (63, "of the of the of the " * 30, "en"), (None, "a a a a a a a a a a a a a", "de")]
    return docs


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_against_brute_force(spark, texts, longest):
    df = spark.createDataFrame(texts, DOCS).withColumns({"chunk": F.lit(1), "id": F.lit("x"), "total": F.lit(2)}).repartition(3)
    got = co.collocations(df, longest=longest, top=40, chunk_words=700, bucket_entries=50)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(texts, longest=longest, top=40)


def test_collocations_of_nothing(spark):
    assert co.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert co.collocations(spark.createDataFrame([(1, None, None), (2, " . ", "en")], DOCS)).count() == 0


def test_products_beyond_64_bits_are_exact(spark):
    a, l, r = 10**14, 3 * 10**14 + 1, 7 * 10**14 + 3
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(co._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1000000 * a * a // (l * r)


def test_tiles_and_sorted_pairs_count_alike(monkeypatch):
    rng = np.random.default_rng(3)
    left, right = rng.zipf(1.3, 20000) % 500, rng.zipf(1.3, 20000) % 500
    want = {}
    for p in zip(left.tolist(), right.tolist()):
        want[p] = want.get(p, 0) + 1
    for tile, head in ((512, 64), (16, 4), (16, 64)):
        monkeypatch.setattr(co, "TILE", tile)
        monkeypatch.setattr(co, "HEAD", head)
        number, ls, rs, n = co.count_pairs(left, right, 500)
        assert {(a, b): c for a, b, c in zip(ls.tolist(), rs.tolist(), n.tolist())} == want and len(n) == len(want)
        assert (ls[number] == left).all() and (rs[number] == right).all()


def test_a_long_text_is_split_where_words_end(monkeypatch):
    monkeypatch.setattr(co, "SEGMENT", 7)
    text = b"aa bb\ncc  dddddddddddddd e\n\nf " * 20
    assert b"".join(co._segments(text)) == text
    assert [w for p in co._segments(text) for w in p.split()] == text.split()


# ------------------------------------------------------------------- search


def brute_search(docs, items, top=10):
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    bags = [(d[0], term.findall(_lower(d[1] or ""))) for d in docs]
    nn, ll = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, []).extend(term.findall(_lower(text or "")))
    out = []
    for item, terms in asked.items():
        rows = []
        for doc, b in bags:
            if b:
                m, s = 25 + 75 * len(b) * nn // ll, 0
                for t in terms:
                    tf = b.count(t)
                    s += math.floor(1000 * math.log((2 * nn + 2) / (2 * df.get(t, 0) + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
                if s > 0:
                    rows.append((-s, doc is None, doc or 0, doc, s))
        rows.sort(key=lambda r: r[:3])
        out += [(item, i + 1, r[3], r[4]) for i, r in enumerate(rows[:top])]
    return sorted(out, key=lambda r: (str(r[0]), r[1]))


ITEMS = [("q1", "The of W3 w4 w4"), ("q2", ""), ("q3", None), (None, "the"), ("q4", "nowhere ü"), ("q5", "w7 " * 500 + "e"), ("q1", "w9"), ("q6", "the")]


@pytest.mark.parametrize("block_terms", [1 << 20, 4])
def test_search_against_brute_force(spark, texts, block_terms):
    more = texts + [(100 + i, "the of w3", "en") for i in range(40)]  # many ties
    docs = spark.createDataFrame(more, DOCS).withColumns({"item": F.lit(1), "score": F.lit(2)}).repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id string, text string").withColumn("term", F.lit(0))
    got = se.search(docs, items, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: (str(r[0]), r[1])) == brute_search(more, ITEMS)


def test_search_of_nothing(spark, texts):
    docs, items = spark.createDataFrame(texts, DOCS), spark.createDataFrame(ITEMS, "item_id string, text string")
    assert se.search(docs.limit(0), items).count() == 0
    assert se.search(docs, items.limit(0)).count() == 0


def test_partial_sums_stay_exact(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(se, "EXACT", 10**12)  # as if doubles held less: more groups of columns
    monkeypatch.setattr(se, "REPEATS", 7)
    weights = rng.integers(0, 40_000, 50)
    rows = [(i, t, int(rng.integers(1, 20))) for i in range(6) for t in rng.choice(50, 12, replace=False).tolist()]
    tile = se.ItemTile(np.arange(6), rows, weights)
    assert len(tile.groups) > 3
    row, term = np.repeat(np.arange(9), 20), np.concatenate([rng.choice(50, 20, replace=False) for _ in range(9)])
    impact = rng.integers(1, se.IMPACT, len(row))
    want = np.zeros((9, 6), np.int64)
    for i, t, n in rows:
        for r, k, x in zip(row, term, impact):
            if k == t:
                want[r, i] += n * int(weights[t]) * int(x)
    assert (tile.scores(row, term, impact, 9, 50) == want).all()


def test_best_keeps_ties_until_ids_decide(monkeypatch):
    monkeypatch.setattr(se, "HELD", 5)
    best = se.Best(1, 3)
    for ids in ([50, 40], [30, 20, 60], [10, 70], [5]):
        best.add(np.array([0]), np.full((len(ids), 1), 7), np.array(ids), np.zeros(len(ids), np.uint8))
    assert best.trim()[3].tolist() == [5, 10, 20]


def test_lengths_beyond_64_bits():
    n, docs, length = np.array([10**15, 3]), 10**6, 10**16
    got = se.impacts(np.array([2, 1]), n, docs, length)
    assert got.tolist() == [10**9 * tf // (1000 * tf + 8 * (25 + 75 * x * docs // length)) for tf, x in ((2, 10**15), (1, 3))]


# ------------------------------------------------------------------ repeats


def brute_repeats(docs, window):
    words = [(d[0], re.findall("[^\x20\x09-\x0d]+", d[1] or "")) for d in docs]
    place = lambda d: (d is None, d or 0)
    least = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, place(d)), place(d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < place(d):
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def _passages(rng, kinds, n_docs, long):
    shared = [[rng.choice(kinds) for _ in range(rng.randint(5, long))] for _ in range(8)]
    docs = []
    for i in range(n_docs):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(shared) if rng.random() < 0.5 else [rng.choice(kinds) for _ in range(rng.randint(0, 30))]
            if rng.random() < 0.2:
                w = w[rng.randint(0, len(w)) :]
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(w), "en"))
    return docs


@pytest.mark.parametrize("window,kinds,rounds", [(50, 400, 3), (10, 3, 3), (7, 2, 2), (10, 1, 3), (5, 30, 0), (20, 2, 5)])
def test_repeats_against_brute_force(spark, window, kinds, rounds):
    rng = random.Random(window * 100 + kinds)
    docs = _passages(rng, [f"k{i}" for i in range(kinds)], 40, 4 * window)
    docs += [(100, None, "x"), (101, "", "x"), (102, "one", "x"), (None, docs[3][1], "x"), (None, docs[3][1], "x"), (3, docs[3][1], "x"), (3, docs[5][1], "x")]
    docs += [(200 + i, " ".join(["same"] * n), "x") for i, n in enumerate((3 * window, window, window - 1, 5 * window))]
    df = spark.createDataFrame(docs, DOCS).withColumns({"anchor": F.lit(1), "version": F.lit(2), "listed": F.lit(3)}).repartition(3)
    got = rp.remove_repeats(df, window=window, rounds=rounds)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_repeats(docs, window)


def test_repeats_of_nothing(spark):
    assert rp.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_symbols_are_decided_by_their_words():
    """Whatever stands around the words that decide a symbol, the symbol is there."""
    rng = np.random.default_rng(7)
    words = rng.integers(1, 6, 400).astype(np.uint64)

    def parse(inner):
        names = np.concatenate([[0], inner, [1]]).astype(np.uint64)
        end = np.zeros(len(names), bool)
        end[[0, -1]] = True
        return rp.levels(rp.mix(names, 99), end, 4)

    whole = parse(words)
    for level, v in enumerate(whole):
        stop = np.append(v.at[1:], len(words) + 2)
        for k in rng.choice(np.flatnonzero(~v.end), 40).tolist():
            lo, hi = int(v.lo[k]), int(v.hi[k])
            if lo < 1 or hi > len(words) + 1:
                continue
            before, after = rng.integers(1, 6, 30).astype(np.uint64), rng.integers(1, 6, 30).astype(np.uint64)
            other = parse(np.concatenate([before, words[lo - 1 : hi - 1], after]))[level]
            moved = int(v.at[k]) - lo + 1 + len(before)
            at = np.flatnonzero(other.at == moved)
            assert len(at) == 1 and other.name[at[0]] == v.name[k]
            assert np.append(other.at[1:], 10**6)[at[0]] - moved == stop[k] - v.at[k]


def test_rolling_hashes_depend_on_the_words_alone():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, (300, 2)).astype(np.uint64)
    h[200:260] = h[40:100]
    r = rp.Rolling(h)
    a, b = r.of(np.arange(40, 90), 10), r.of(np.arange(200, 250), 10)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    assert len(set(r.of(np.arange(100), 10)[0].tolist())) == 100


def test_ranges_of_the_largest():
    rng = np.random.default_rng(4)
    v = rng.integers(0, 1000, 100).astype(np.uint64)
    first = rng.integers(0, 100, 500)
    last = np.minimum(first + rng.integers(0, 60, 500), 99)
    assert rp._most(v, first, last).tolist() == [int(v[a : b + 1].max()) for a, b in zip(first, last)]
