"""Files that outlive their session, shards of any ids, link edges of any form,
raking below a bound, broadcasts bounded by bytes."""

import os
import random
import subprocess
import sys
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestfold.llm import common, mixing, urls

BIG = 10**15


# ------------------------------------------------------------- written files


def test_written_files_outlive_the_session(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from nestfold.session import builder, scratch_path
from nestfold.llm import warc, tokens
spark = builder("local[2]").config("spark.checkpoint.dir", "{tmp_path}/ck").getOrCreate()
pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "y")], "page_id long, url string, html string")
warc.write_warc(pages, "file://{tmp_path}/archive")
tokens.write_token_ids(pages.selectExpr("page_id AS doc_id", "html AS text"), "file://{tmp_path}/ids", tokens.default_tokenizer())
print(scratch_path(spark, "gone"))
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    assert any(n.endswith(".warc.gz") for n in os.listdir(tmp_path / "archive")) and "manifest" in os.listdir(tmp_path / "archive")
    assert any(n.endswith(".tok") for n in os.listdir(tmp_path / "ids")) and "temp" not in os.listdir(tmp_path / "ids")
    assert os.listdir(tmp_path / "ck" / "nestfold") == []  # scratch folders go


def test_a_rerun_replaces_what_a_broken_run_left(spark, workdir):
    from nestfold.llm import warc

    root = common.file_uri(workdir)
    path = root.removeprefix("file://")
    os.makedirs(path)
    with open(f"{path}/part-000000-0000.warc.gz", "wb") as f:  # its manifest was never written
        f.write(b"of another input")
    pages = spark.createDataFrame([(1, "http://a/", "new")], "page_id long, url string, html string")
    warc.write_warc(pages, root)
    assert [bytes(r["payload"]) for r in warc.read_warc(spark, root).collect()] == [b"new"]


# -------------------------------------------------------------------- shards


IDS = {
    "dense": list(range(3000)),
    "sparse": list(range(3000)) + [BIG],
    "clusters": [k * 10**12 + i for k in range(5) for i in range(600)] + [-(2**63), 2**63 - 1],
    "extremes": [-(2**63), 2**63 - 1, 0] * 3 + list(range(2000)),
    "nulls": [None] * 1000 + list(range(2000)),
    "one id": [7] * 2500 + list(range(500)),
    "single": [5],
    "only null": [None, None],
}


@pytest.mark.parametrize("name", sorted(IDS))
@pytest.mark.parametrize("buckets", [1 << 14, 256])
def test_shards_are_even_and_in_order(spark, name, buckets):
    rows = [(i, k, 10) for k, i in enumerate(IDS[name])]
    df = spark.createDataFrame(rows, "id long, k long, size long")
    part = F.xxhash64("k").cast("double") / float(1 << 64) + 0.5
    shard, n = common.id_shards(df, "id", "size", 1000, part, buckets)
    got = df.select("id", "k", "size", shard.alias("s"), part.alias("p")).collect()
    assert len(got) == len(rows) and all(0 <= r["s"] < n for r in got)
    mass = np.bincount([r["s"] for r in got], [r["size"] for r in got], minlength=n)
    assert mass.max() <= 1500 and n <= 3 * (len(rows) * 10 // 1000 + 2)
    order = sorted(got, key=lambda r: (r["id"] is not None, r["id"] or 0, r["p"]))
    assert [r["s"] for r in order] == sorted(r["s"] for r in order)
    again = common.id_shards(df.repartition(5), "id", "size", 1000, part, buckets)
    assert again[1] == n and {(r["k"], r["s"]) for r in df.select("k", again[0].alias("s")).collect()} == {(r["k"], r["s"]) for r in got}


def test_shards_of_nothing(spark):
    df = spark.createDataFrame([], "id long, size long")
    shard, n = common.id_shards(df, "id", "size", 10, F.lit(0.5))
    assert n == 1 and df.select(shard).count() == 0


def test_tables_fit_by_rows_and_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 100, ["y" * 50]) for i in range(100)], "i long, t string, a array<string>")
    assert common.fits(df) and common.fits(df, 100, 30_000)
    assert not common.fits(df, 99) and not common.fits(df, 1000, 10_000)
    assert not common.fits(df.select("t"), 1000, 9_000) and common.fits(df.limit(0), 0, 0)


# --------------------------------------------------------------------- edges


BASES = ["http://a.com", "https://a.com/", "http://a.com/x/y", "http://a.com/x/y/?q=1#f", "http://a.com?q", "https://h:8/a/b/../c"]
TARGETS = ["/home", "z", "../z", "./z", "../../../z", "a/./b/../c", "?k=v", "//b.net/p", "http://b.net", "HTTPS://B.net/x", "x/..", ".", "..", "/a/../b/./", "z?x=../y", "z#../y"]


@pytest.mark.parametrize("base", BASES)
def test_targets_are_resolved_as_browsers_do(spark, base):
    df = spark.createDataFrame([(t,) for t in TARGETS], "t string")
    for r in df.select("t", urls.resolve(F.col("t"), F.lit(base)).alias("v")).collect():
        want = urljoin(base, r["t"])
        if "/../" in base and not r["t"].startswith(("/", "h", "H")):
            continue  # the base's own dots stay until a target needs them
        assert r["v"].lower() in (want.lower(), want.lower() + "/" if want.count("/") == 2 else want.lower()), r["t"]


def test_targets_that_name_no_page(spark):
    df = spark.createDataFrame([("mailto:x@y", "http://a/"), ("javascript:void(0)", "http://a/"), ("", "http://a/"), (" ", "http://a/"), (None, "http://a/"), ("/x", "no scheme"), ("/x", None)], "t string, b string")
    assert all(r[0] is None for r in df.select(urls.resolve(F.col("t"), F.col("b"))).collect())


TAGS = [
    ('<link rel="canonical" href="{}">', True),
    ("<link href='{}' rel=canonical>", True),
    ("<LINK\n  HREF={}\n REL='Canonical alternate' />", True),
    ('<link data-x="a>b" href="{}" rel="canonical">', True),
    ('<link rel="stylesheet" href="{}">', False),
    ('<link rel="canonicals" href="{}">', False),
    ('<a rel="canonical" href="{}">', False),
    ('<link title=" rel=canonical " href="{}">', False),
    ('<meta http-equiv="refresh" content="0; url={}">', True),
    ("<meta content='5;URL={}' http-equiv=REFRESH>", True),
    ("<meta http-equiv=refresh content=\"0; url='{}'\">", True),
    ('<meta http-equiv="refresh" content="0, {}">', True),
    ('<meta http-equiv="refresh" content="30">', False),
    ('<meta name="x" content="0; url={}">', False),
]


def test_link_tags_in_any_form(spark):
    rows = [(f"http://p.net/{i}", f"<head>{tag.format('http://t.org/a?x=1&amp;y=2')}</head>") for i, (tag, _) in enumerate(TAGS)]
    edges = {(r["u"], r["v"]) for r in urls.page_edges(spark.createDataFrame(rows, "url string, html string")).collect()}
    for (url, _), (tag, linked) in zip(rows, TAGS):
        assert ((url, "http://t.org/a?x=1&y=2") in edges) == linked, tag
    assert ("http://t.org/a?x=1&y=2", "https://t.org/a?x=1&y=2") in edges  # the target's own canonical form


def test_relative_targets_do_not_join_hosts(spark):
    rows = [(1, "http://a.com/de/x", '<link rel=canonical href="/home">'), (2, "http://b.net/x", '<link rel=canonical href="/home">'), (3, "http://b.net/home", None), (4, "http://a.com/home", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = spark.createDataFrame([("com", "/de/", "block")], "host string, path string, action string")
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, rules, urls.page_edges(pages)).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block"}


def test_canonical_hosts(spark):
    want = {"http://www.a.com/": "https://a.com", "http://m.com/x": "https://m.com/x", "http://www.net/": "https://www.net", "http://m.a.org/?ref=1": "https://a.org", "http://www.m.a.b/": "https://m.a.b"}
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r["u"]: r["c"] for r in df.select("u", urls.canonical(F.col("u")).alias("c")).collect()} == want


# -------------------------------------------------------------------- mixing


def _corpus(spark, sizes, n=600):
    rng, rows = random.Random(1), []
    for lang, tokens in sizes.items():
        left = tokens
        while left > 0:
            k = min(left, rng.randint(5, 40))
            rows.append((len(rows), "w " * k, lang, rng.choice(["a", "b"])))
            left -= k
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def _marginal(rows, dim, what):
    out = {}
    for r in rows:
        out[r[dim]] = out.get(r[dim], 0) + r["mix_tokens"] * r[what]
    return out


@pytest.mark.parametrize("driver_cells", [1000, 0])
def test_shares_are_met_without_repeats(spark, driver_cells):
    docs = _corpus(spark, {"x": 20_000, "y": 20_000, "z": 60_000})
    dims, n = {"lang": F.col("lang"), "source": F.col("source")}, mixing.tokens_in(F.col("text"))
    want = {"lang": {"x": 1, "y": 1, "z": 1}, "source": {"a": 0.5, "b": 0.5}}
    rows = mixing.mix(docs, dims, n, want, size=0.5, repeats=False, driver_cells=driver_cells).collect()
    assert all(0 <= r["mix_weight"] <= 1 and r["mix_copies"] <= 1 for r in rows)
    assert list(_marginal(rows, "lang", "mix_weight").values()) == pytest.approx([50_000 / 3] * 3, rel=1e-6)
    assert list(_marginal(rows, "source", "mix_weight").values()) == pytest.approx([25_000] * 2, rel=1e-6)
    drawn = _marginal(rows, "lang", "mix_copies")
    assert sum(drawn.values()) == pytest.approx(50_000, rel=0.05) and list(drawn.values()) == pytest.approx([50_000 / 3] * 3, rel=0.1)


def test_scarce_categories_give_all_and_the_rest_is_shared(spark):
    docs = _corpus(spark, {"x": 4_000, "y": 30_000, "z": 66_000})
    rows = mixing.mix(docs, {"lang": F.col("lang")}, mixing.tokens_in(F.col("text")), {"lang": {"x": 1, "y": 1, "z": 1}}, size=0.5, repeats=False).collect()
    assert _marginal(rows, "lang", "mix_weight") == pytest.approx({"x": 4_000, "y": 23_000, "z": 23_000})
    assert {r["mix_copies"] for r in rows if r["lang"] == "x"} == {1}
    rows = mixing.mix(docs, {"lang": F.col("lang")}, mixing.tokens_in(F.col("text")), size=1.0, repeats=False).collect()
    assert all(r["mix_copies"] == 1 for r in rows)  # nothing to leave out


def test_odd_categories_and_names(spark):
    rows = [(1, "a b", "x\x1fy", "q"), (2, "a b c", "x", "yq"), (3, "d", None, ""), (4, "e", "", None)]
    docs = spark.createDataFrame(rows, "key long, body string, held string, tokens string")
    got = mixing.mix(docs, {"held": F.col("held"), "tokens": F.col("tokens"), "factor": F.lit("f")}, mixing.tokens_in(F.col("body")), power=1.0, id_col="key", text_col="body").collect()
    assert len(got) == 4 and all(r["mix_weight"] == pytest.approx(1) and r["mix_copies"] in (1, 0, 2) for r in got)


def test_marginals_that_contradict_each_other_are_reported():
    w, codes = np.array([1.0, 1.0]), [np.array([0, 1]), np.array([0, 1])]
    with pytest.warns(UserWarning, match="off"):
        mixing.rake(w, codes, [np.array([1.5, 0.5]), np.array([0.5, 1.5])])


def test_bounded_raking_on_random_tables():
    rng = np.random.default_rng(5)
    for _ in range(20):
        w = rng.random((4, 5)) * 100
        keep = rng.random((4, 5))  # some feasible answer below the bound
        codes = [np.repeat(np.arange(4), 5), np.tile(np.arange(5), 4)]
        goals = [(w * keep).sum(1), (w * keep).sum(0)]
        f = mixing.rake(w.reshape(-1), codes, goals, bound=1.0).reshape(4, 5)
        assert f.max() <= 1 and np.allclose((w * f).sum(1), goals[0], rtol=1e-5) and np.allclose((w * f).sum(0), goals[1], rtol=1e-5)


# --------------------------------------------------------------- near matches


def test_near_matches_against_brute_force(spark):
    from nestfold.llm import decontam

    rng = random.Random(9)
    kinds = [f"k{i}" for i in range(40)]
    items = [(i, [rng.choice(kinds) for _ in range(rng.choice([4, 10, 12]))]) for i in range(6)]
    docs = []
    for i in range(60):
        w = [rng.choice(kinds) for _ in range(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 2)):
            part = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(part))
                part[at : at + rng.randint(0, 1)] = [rng.choice(kinds)] * rng.randint(0, 2)
            w += part + [rng.choice(kinds) for _ in range(rng.randint(0, 15))]
        docs.append((i, w))
    frame = spark.createDataFrame([(i, " ".join(w), "x") for i, w in docs], "doc_id long, text string, wid string")
    got = {r["doc_id"]: r["n_near"] for r in decontam.decontaminate(frame, spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string"), near=True).collect()}
    windows = {tuple(w[j : j + 10]) for _, w in items for j in range(max(1, len(w) - 9))}

    def matched(w, v):  # some start where 80 % of the window's words are within five words of their places
        need = -(-len(v) * 80 // 100)
        for s in range(-15, len(w) + 5):
            lists = [[p for p in range(max(0, s + i - 5), min(len(w), s + i + 6)) if w[p] == x] for i, x in enumerate(v)]
            if min(sum(bool(x) for x in lists), len({p for x in lists for p in x})) >= need:
                return True
        return False

    sure = {i: sum(matched(w, v) for v in windows) for i, w in docs}
    assert all(got[i] <= sure[i] for i in got)  # nothing that is no match
    assert sum(got[i] > 0 for i in got) >= 0.95 * sum(sure[i] > 0 for i in got)  # by a start of a rare term, nearly always


# ------------------------------------------------------------------ toxicity


def _risk(p, u, prior, w, b):
    """The non-negative risk, term by term."""
    soft = lambda z: np.logaddexp(0, z).mean()
    zp, zu = (np.array([b + sum(w[f] for f in x) for x in xs]) for xs in (p, u))
    return prior * soft(-zp) + max(0.0, soft(zu) - prior * soft(zp))


def test_the_fit_lowers_the_non_negative_risk(monkeypatch):
    from nestfold.llm import toxicity

    rng = np.random.default_rng(3)
    make = lambda rate: [i for i in range(6) if rng.random() < (rate if i < 2 else 0.3)]
    p, u = [make(0.9) for _ in range(80)], [make(0.9 if rng.random() < 0.2 else 0.1) for _ in range(300)]
    packed = lambda xs: (np.array([f for x in xs for f in x], np.int64), np.cumsum([0, *map(len, xs)]))
    model = toxicity.fit_nnpu(packed(p), packed(u), 0.2, np.arange(6))
    w = [model.weights[i] for i in range(6)]
    assert w[0] > 0.5 and w[1] > 0.5 and max(map(abs, w[2:])) < min(w[:2])
    start, fitted = _risk(p, u, 0.2, [0.0] * 6, np.log(0.25)), _risk(p, u, 0.2, w, model.bias)
    assert fitted < start
    assert all(_risk(p, u, 0.2, np.array(w) + rng.normal(0, 0.7, 6), model.bias) > fitted - 1e-3 for _ in range(50))


def test_texts_without_a_label_are_read(spark):
    from nestfold.llm import toxicity

    rng = random.Random(8)
    plain = lambda: " ".join(f"p{rng.randrange(40)}" for _ in range(30))
    rows = [(i, plain() + (" vile vile" if i % 5 == 0 else "")) for i in range(600)]
    rows += [(i, "odd " + plain()) for i in range(600, 2000)]  # a word that no labelled text has
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    odd = toxicity.word_features(b"odd")[0]
    assert toxicity.train(docs, labels).weights[odd] < 0
    assert odd not in toxicity.train(docs, labels, unlabelled_rows=0).weights
