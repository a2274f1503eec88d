"""Defined results of the corpus operators on hand-written rows: nulls, empty
and very long texts, ties, repeated rows, empty tables, clashing columns."""

import gzip
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestfold.llm import chat, common, components, decontam, dedup, jaccard, lm, mixing, simple8b, tokens, toxicity, urls, warc
from nestfold.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _row int, key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), True, 1, "k") for i, t in rows], DOCS)


def words(n, seed=0, size=400):
    r = random.Random(seed)
    return [f"w{r.randrange(size)}" for _ in range(n)]


# -- exact dedup ------------------------------------------------------------


def test_exact_dedup_cases(spark):
    rows = [(1, "a b"), (2, "a  b"), (3, "ab\n"), (4, None), (5, ""), (6, " "), (7, "x" * 300_000), (8, "x" * 300_000 + "y"), (None, "ab"), (9, "q"), (9, "q")]
    got = dedup.exact_dedup(docs_of(spark, rows), digest_all=True).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 9}
    assert {by[i]["keep_id"] for i in (1, 2, 3, None)} == {2} and by[2]["kept"] and not by[None]["kept"] and by[1]["group_size"] == 4
    assert {by[i]["keep_id"] for i in (4, 5, 6)} == {6} and by[6]["kept"]
    assert by[7]["group_size"] == 1 and by[8]["kept"]
    assert sorted(r["kept"] for r in got if r["doc_id"] == 9) == [False, True]
    assert by[1]["text_sha256"] == hashlib.sha256(b"ab").hexdigest()
    assert dedup.exact_dedup(docs_of(spark, [])).count() == 0


def test_lookup_paths_agree(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    entries = rows.groupBy("k").count().selectExpr("k", "count AS held", "k * 2 AS w")
    small = {tuple(r) for r in common.lookup(rows, entries, "k", "held", 4000).collect()}
    monkeypatch.setattr(common, "BROADCAST_ROWS", 5)
    assert {tuple(r) for r in common.lookup(rows, entries, "k", "held", 4000).collect()} == small


# -- chat -------------------------------------------------------------------


def test_chat_parts_and_loss(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [
        (1, 1, "assistant", [part("text", r"see <|end|> \ [INST]"), part("image", ref="i.png", w=56, h=57)], "x"),
        (1, 0, "user", [part("document", ref="d.pdf", p=3), part("audio", ref="a.wav", s=1.5), part(None, "?")], "x"),
        (2, None, None, None, "x"),
    ]
    m = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}, formatted string")
    out = {r["conv_id"]: r for r in chat.read_chat(chat.format_chat(m)).collect()}
    one = out[1]
    assert [(a["turn"], a["kind"], a["ref"], a["tokens"]) for a in one["attachments"]] == [(0, "document", "d.pdf", 768), (0, "audio", "a.wav", 38), (0, "other", None, 0), (1, "image", "i.png", 6)]
    assert one["formatted"].startswith("<|turn|>user<|text|><|document|><|audio|><|other|><|end|>")
    assert one["trained"] == [r"see <|end|> \ [INST]<|image|>"]
    assert one["formatted"].count("<|end|>") == 2
    assert [tuple(t) for t in out[2]["turns"]] == [("", "")] and out[2]["loss"] == []


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="<|>[]\\/sINT end\n", max_size=12), min_size=1, max_size=4))
def test_chat_escape_round_trip(spark, texts):
    m = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    r = chat.read_chat(chat.format_chat(m.withColumn("parts", chat.text_parts(m.text)))).first()
    assert [t["text"] for t in r["turns"]] == texts and r["trained"] == texts
    assert r["formatted"].count("[INST]") == 0


def test_chat_empty(spark):
    m = spark.createDataFrame([], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    assert chat.read_chat(chat.format_chat(m)).count() == 0


# -- decontamination --------------------------------------------------------


def test_decontamination_cases(spark):
    a = words(30, 1)
    long_doc = words(30_000, 2) + a[5:17] + words(50, 3)
    docs = [(1, " ".join(long_doc)), (2, " ".join(a[:9])), (3, None), (4, ""), (5, "Only THIS, x"), (6, " ".join(a)), (6, "other text"), (None, "only this")]
    items = spark.createDataFrame([(1, " ".join(a)), (2, "only-this"), (3, None), (4, "..."), (10, "ONLY this"), (None, " ".join(words(12, 2))), (2, "only this")], "item_id long, text string")
    out = decontam.decontaminate(docs_of(spark, docs), items).collect()
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["items"], r["contaminated"]) for r in out}
    assert len(out) == len(docs)
    assert got[(1, 30_062)] == (12, ["1"], True)
    assert got[(2, 9)] == (0, [], False) and got[(3, 0)][2] is False and got[(4, 0)][2] is False
    assert got[(5, 3)] == (2, ["10", "2"], True) and got[(None, 2)] == (2, ["10", "2"], True)
    assert got[(6, 30)] == (30, ["1"], True) and got[(6, 2)] == (0, [], False)
    assert decontam.decontaminate(docs_of(spark, []), items).count() == 0
    assert not decontam.decontaminate(docs_of(spark, docs), items.limit(0)).where("contaminated").count()


def test_proximity(spark):
    a = [f"t{i}" for i in range(10)]
    near = a[:4] + ["x", "y"] + a[4:]
    far = a[:4] + ["z"] * 40 + a[4:]
    docs = docs_of(spark, [(1, " ".join(a)), (2, " ".join(near)), (3, " ".join(far))])
    items = spark.createDataFrame([(1, " ".join(a))], "item_id long, text string")
    w = common.store(decontam.windows_of(items), "t")
    index = decontam.build_index(docs, decontam.terms_of(w).select("term"))
    # the rarest terms by (count, term) are t0, t1, t2, all before the gap: ask for all ten
    hit = {r["doc"] for r in decontam.proximity_matches(docs, index, items, slack=5, k=10).collect()}
    assert hit == {1, 2}
    assert {r["doc"] for r in decontam.phrase_candidates(index, w, k=10).collect()} == {1}


def test_decontamination_near_matches(spark):
    a = [f"t{i}" for i in range(10)]
    other = ["q"] * 30
    docs = [(1, a), (2, other + a[:5] + ["new"] + a[6:]), (3, other + a[:4] + ["x", "y"] + a[4:]), (4, a[:7] + other), (5, a[:4] + other + a[4:]), (6, other), (None, a[1:] + other)]
    items = spark.createDataFrame([(1, " ".join(a)), (2, " ".join([*a[:3], "nowhere", *a[4:]]))], "item_id long, text string")
    out = decontam.decontaminate(docs_of(spark, [(i, " ".join(w)) for i, w in docs]), items, near=True).collect()
    assert {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in out} == {1: (10, 2), 2: (0, 2), 3: (0, 2), 4: (0, 0), 5: (0, 0), 6: (0, 0), None: (0, 2)}
    assert len(out) == len(docs)


def test_near_matches_group_a_bounded_part_of_the_texts_in_a_task(spark, monkeypatch):
    a = [f"t{i}" for i in range(10)]
    docs = docs_of(spark, [(i, " ".join(["q"] * i + a[:5] + ["new"] + a[6:])) for i in range(40)])
    items = spark.createDataFrame([(1, " ".join(a))], "item_id long, text string")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(decontam, "NEAR_BYTES", size // 37, raising=False)
    plans, store = {}, common.store

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(decontam, "store", spy)
    out = decontam.decontaminate(docs, items, near=True).collect()
    assert sorted((r["doc_id"], r["n_hit"], r["n_near"]) for r in out) == [(i, 0, 1) for i in range(40)]
    parts = [int(n) for n in re.findall(r"hashpartitioning\(doc#\w+, version#\w+, (\d+)\), REPARTITION_BY_NUM", plans["decontam-places"])]
    assert parts and min(parts) >= 37


# -- n-gram Jaccard ---------------------------------------------------------


def brute_components(texts):
    import re

    sets = []
    for _, t in texts:
        w = [x.translate(str.maketrans(common.UPPER, common.LOWER)) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(texts)}


def test_jaccard_against_brute_force(spark):
    r = random.Random(5)
    texts, n = [], 0
    for base in range(14):  # groups of copies, each with a few words changed, chained
        w = words(r.choice([3, 8, 30, 90, 140, 260]), 100 + base, 60)
        for _ in range(r.choice([1, 2, 8, 25])):
            texts.append((n, " ".join(w)))
            n += 1
            c = list(w)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                c[r.randrange(len(c))] = f"e{r.randrange(999)}"
            if r.random() < 0.4:
                w = c
            texts.append((n, " ".join(c).upper() if r.random() < 0.3 else "\n".join(c)))
            n += 1
    texts += [(n, ""), (n + 1, "  "), (n + 2, "É a"), (n + 3, "é a"), (n + 4, "a"), (n + 5, "A\t"), (n + 6, " ".join(words(20_000, 9)))]
    want = brute_components(texts)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.jaccard_components(docs_of(spark, texts)).collect()}
    assert got == want


def test_jaccard_links_inside_a_group(spark):
    r, texts = random.Random(3), [(90, "no link to any"), (91, None)]
    base = words(200, 4, 50)
    for i in range(14):  # one group, in which only some pairs link
        c = list(base)
        for _ in range(i % 4):
            c[r.randrange(len(c))] = f"e{i}"
        texts.append((i, " ".join(c)))
    sets = {i: frozenset(tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)) for i, t in texts if t and i < 90}
    first = {s: min(i for i in sets if sets[i] == s) for s in sets.values()}
    ids = sorted(first.values())
    want = {(i, j) for i in ids for j in ids if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    got = [(*sorted((x["a_id"], x["b_id"])), x["a_held"] + x["b_held"]) for x in jaccard.jaccard_links(docs_of(spark, texts)).collect()]
    assert sorted(g[:2] for g in got) == sorted(want) and 0 < len(want) < len(ids) * (len(ids) - 1) // 2 and len(want) > len(ids)
    assert all(n == sum(s in (sets[i], sets[j]) for s in sets.values()) for i, j, n in got)
    assert jaccard.jaccard_links(docs_of(spark, [])).count() == 0


def test_jaccard_cases(spark):
    t = " ".join(words(40, 1))
    out = jaccard.jaccard_components(docs_of(spark, [(7, t), (7, t), (None, t), (3, None), (4, None), (None, "lone text")])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in out if r["n_shingles"] > 1) == [("7", 7), ("7", 7), ("None", 7)]
    assert {(r["doc_id"], r["component_id"]) for r in out if r["n_shingles"] <= 1} == {(3, 3), (4, 4), (None, None)}
    assert jaccard.jaccard_components(docs_of(spark, [])).count() == 0


def test_components(spark):
    r = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(60)] + [(500 + r.randrange(60), 500 + r.randrange(60)) for _ in range(30)] + [(9, 9), (None, 3)]
    got = {x["node"]: x["root"] for x in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    near = {}
    for u, v in pairs:
        if u is not None and u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert got.pop(n) == min(seen)
    assert not got


# -- WARC -------------------------------------------------------------------


def test_warc_cases(spark):
    rows = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, None), (5, "http://c/\r\nX: y", ""), (None, "u", "same"), (7, "http://z/", "é" * 70_000), (8, "r", "twice"), (8, "r", "twice")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, shard string")
    roots = [common.file_uri(scratch_path(spark, "warc-test")) for _ in range(2)]
    sums = []
    for root in roots:
        m = warc.write_warc(pages, root, shard_bytes=2000, roll_bytes=600).collect()
        sums.append(sorted((r["name"], r["sha1"], r["records"]) for r in m))
        for r in m:
            with open(f"{root[7:]}/{r['name']}", "rb") as f:
                data = f.read()
            assert hashlib.sha1(data).hexdigest() == r["sha1"] and gzip.decompress(data).count(b"WARC/1.1\r\n") == r["records"]
    assert sums[0] == sums[1] and len(sums[0]) > 2  # equal input, equal files
    got = warc.read_warc(spark, roots[0]).collect()
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert kinds == {(1, "response", None), (3, "revisit", 1), (None, "revisit", 1), (2, "response", None), (5, "revisit", 2), (7, "response", None), (8, "response", None), (8, "revisit", 8)}
    by = {(r["page_id"], r["record_type"]): r for r in got}
    assert by[(7, "response")]["payload"] == ("é" * 70_000).encode() and by[(3, "revisit")]["payload_bytes"] == 4
    assert by[(1, "response")]["payload_digest"] == by[(3, "revisit")]["payload_digest"]
    root = common.file_uri(scratch_path(spark, "warc-test"))
    warc.write_warc(pages.limit(0), root)
    assert warc.read_warc(spark, root).count() == 0
    root = common.file_uri(scratch_path(spark, "warc-test"))
    warc.write_warc(pages, root, min_bytes=5)
    assert warc.read_warc(spark, root).where("record_type = 'revisit'").count() == 1


# -- token files ------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300), st.sampled_from([64, 4096]))
def test_simple8b_round_trip(values, block):
    v = np.array(values, np.uint64)
    w, o = simple8b.encode(v, block)
    assert simple8b.decode(w, o, len(v), block).tolist() == values


def test_simple8b_blocks_stand_alone():
    v = np.random.default_rng(0).integers(0, 50_000, 10_000, dtype=np.uint64)
    w, o = simple8b.encode(v)
    assert (simple8b.decode(w[o[1] : o[2]], o[1:3] - o[1], 4096) == v[4096:8192]).all()


TEXTS = ["", None, "a  b", " a b ", "\n b", "a\n b", "a \n b", "x<|endoftext|>y z", "é ü", "a's it's 's", "12 34", "a\tb  c", "　 x", "\x1c a", "a\x85 b\xa0 c", "_a _b", "w " * 40_000]


def test_token_ids_are_those_of_whole_texts(spark):
    tokenizers = pytest.importorskip("tokenizers")
    lines = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = TEXTS + lines
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(None, "null id"), (5, "one"), (5, "one")]
    root = common.file_uri(scratch_path(spark, "tokens-test"))
    tokens.write_token_ids(docs_of(spark, rows), root, tokens.default_tokenizer(), shard_bytes=200_000)
    got = sorted(tokens.read_token_ids(spark, root, ids=True).collect(), key=lambda r: r["start"])
    whole = tokenizers.Tokenizer.from_file(tokens.default_tokenizer())
    at = 0
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        data = np.array(ids, "<u4").tobytes()
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) == (i, at, len(ids), zlib.crc32(data), data)
        at += len(ids)
    assert len(got) == len(rows)
    root = common.file_uri(scratch_path(spark, "tokens-test"))
    tokens.write_token_ids(docs_of(spark, []), root, tokens.default_tokenizer())
    assert tokens.read_token_ids(spark, root).count() == 0


# -- toxicity ---------------------------------------------------------------


def toxic_corpus(spark, n=900):
    r, rows, labels = random.Random(3), [], []
    for i in range(n):
        toxic = r.random() < 0.15
        w = words(r.choice([20, 60, 200]), i, 3000)
        if toxic:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(["vileness", "vilely", "scumbag"])
        rows.append((i, " ".join(w)))
        if r.random() < 0.7:
            labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out(spark):
    rows, labels = toxic_corpus(spark)
    docs = docs_of(spark, rows + [(5000, None), (5001, ""), (None, "scumbag"), (5002, "scumbag " * 30_000)])
    frame = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, frame)
    out = toxicity.toxicity(docs, model, "key").collect()  # the column ``key`` is replaced
    score = {r["doc_id"]: r["key"] for r in out}
    held = [(score[i], t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(s >= 0.7) == t for s, t in held]) > 0.95
    assert score[5000] == score[5001] < 0.5 and all(0 <= s <= 1 for s in score.values())
    flags = {r["doc_id"]: r["h"] for r in docs.select("doc_id", toxicity.held_out(docs.doc_id).alias("h")).collect()}
    assert all(flags[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows) and flags[None] is False


def test_toxicity_without_labels(spark):
    docs = docs_of(spark, [(1, "a"), (2, None)])
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["s"] < 0.01 for r in toxicity.toxicity(docs, model, "s").collect())
    assert toxicity.toxicity(docs_of(spark, []), model).count() == 0


# -- LM ---------------------------------------------------------------------


def test_lm_gradient():
    rng = np.random.default_rng(1)
    theta = lm.start(rng.integers(1, 100, lm.VOCABULARY).astype(float)).astype(np.float64)
    ids = np.concatenate([np.zeros(3, int), rng.integers(1, 300, 40), np.zeros(3, int)])
    at = np.arange(3, 43)
    grad = np.zeros(lm.SIZE)
    lm.forward(lm.parts_of(theta), ids, at, lm.parts_of(grad))
    for i in [*np.flatnonzero(grad)[:: max(1, np.count_nonzero(grad) // 40)]]:
        up, down = theta.copy(), theta.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = -(lm.forward(lm.parts_of(up), ids, at).mean() - lm.forward(lm.parts_of(down), ids, at).mean()) / 2e-5
        assert slope == pytest.approx(grad[i], rel=1e-3, abs=1e-7)


def plain_gradient(p, ids, at, g):
    """The gradient by one array operation a step, each over all positions."""
    side, classes = lm.SIDE, np.arange(lm.CLASSES)
    begin, n = at[0], at[-1] + 1 - at[0]
    words = ids[begin - side : begin + n + side]
    e = p["embed"][words]
    h = np.zeros((n, lm.WIDTH), e.dtype)
    for w, o in zip(p["place"], lm.OFFSETS):
        h += e[side + o : side + o + n] * w
    order = np.argsort((ids[at] >> 6).astype(np.uint16), kind="stable")
    target, place = ids[at[order]], (at - begin)[order]
    h = np.tanh(h[place] + p["inner"])
    c, m, rows = target >> 6, target & 63, np.arange(len(at))
    cuts = np.searchsorted(c, [*classes, lm.CLASSES])
    parts = [(k, slice(cuts[k], cuts[k + 1])) for k in classes if cuts[k] < cuts[k + 1]]
    pc, pm = h @ p["to_class"] + p["class"], p["member"][c]
    for k, own in parts:
        pm[own] += h[own] @ p["to_member"][k]
    for z in (pc, pm):
        np.exp(np.minimum(z, lm.MOST, out=z), out=z)
        z *= (1 / (z @ np.ones(z.shape[1], z.dtype)))[:, None]
    np.log(np.maximum(pc[rows, c], 1e-30)) + np.log(np.maximum(pm[rows, m], 1e-30))
    pc[rows, c] -= 1
    pm[rows, m] -= 1
    g["to_class"] += h.T @ pc / len(at)
    g["class"] += pc.sum(0) / len(at)
    g["member"][[k for k, _ in parts]] += np.add.reduceat(pm, [own.start for _, own in parts]) / len(at)
    dh = pc @ p["to_class"].T
    for k, own in parts:
        g["to_member"][k] += h[own].T @ pm[own] / len(at)
        dh[own] += pm[own] @ p["to_member"][k].T
    dh *= (1 - h * h) / len(at)
    g["inner"] += dh.sum(0)
    back, de = np.zeros((n, lm.WIDTH), dh.dtype), np.zeros(e.shape, dh.dtype)
    back[place] = dh
    for j, (w, o) in enumerate(zip(p["place"], lm.OFFSETS)):
        g["place"][j] += np.einsum("bd,bd->d", back, e[side + o : side + o + n])
        de[side + o : side + o + n] += back * w
    by = np.argsort(words.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(words[by], prepend=-1))
    g["embed"][words[by][first]] += np.add.reduceat(de[by], first)


def test_lm_gradient_takes_less_time_than_the_plain_one():
    rng = np.random.default_rng(4)
    theta = lm.start(rng.integers(1, 100, lm.VOCABULARY).astype(float))
    counts = np.minimum(rng.zipf(1.2, lm.BATCH + 300), lm.VOCABULARY - 1)
    ids, at = np.concatenate([np.zeros(lm.SIDE, int), counts, np.zeros(lm.SIDE, int)]), lm.SIDE + np.sort(rng.permutation(lm.BATCH + 300)[: lm.BATCH])
    p, took, grads = lm.parts_of(theta), {}, {}
    for _ in range(40):
        for f in (lm.forward, plain_gradient):
            grads[f] = np.zeros(lm.SIZE, np.float32)
            begin = time.perf_counter()
            f(p, ids, at, lm.parts_of(grads[f]))
            took[f] = min(took.get(f, 9.0), time.perf_counter() - begin)
    assert np.allclose(grads[lm.forward], grads[plain_gradient], atol=1e-6)
    assert took[lm.forward] < 0.9 * took[plain_gradient]


def test_lm_learns_context_and_scores_whole_texts(spark):
    r = random.Random(2)

    def sentence(n):  # each word fixes the next one's half of the vocabulary
        out, x = [], r.randrange(40)
        for _ in range(n):
            out.append(f"v{x}")
            x = (x + r.choice([1, 2])) % 40
        return out

    texts = [(i, " ".join(sentence(r.choice([40, 400])))) for i in range(300)]
    shuffled = sentence(3000)
    plain = " ".join(shuffled)
    r.shuffle(shuffled)
    docs = docs_of(spark, texts)
    model = lm.train_lm(docs, passes=2)
    rows = docs_of(spark, [(1, plain), (2, " ".join(shuffled)), (3, None), (4, "... "), (5, "v1"), (6, "never seen"), (1, plain)])
    got = lm.score_lm(rows, model).collect()
    by = {x["doc_id"]: x for x in got}
    assert len(got) == 7 and by[1]["n_tokens"] == 3000 and (by[3]["n_tokens"], by[3]["log_prob"]) == (0, 0.0) == (by[4]["n_tokens"], by[4]["log_prob"])
    unigram = -np.log(40)
    assert by[1]["log_prob"] / 3000 > unigram + 0.2 and by[1]["log_prob"] > by[2]["log_prob"] + 3000 * 0.3
    assert lm.score_lm(docs_of(spark, []), lm.train_lm(docs_of(spark, []))).count() == 0


def test_lm_trains_on_every_position(spark):
    # a fixed one in eight of the positions would hold only the word p0
    docs = docs_of(spark, [(i, " ".join(f"p{j}" for j in range(8))) for i in range(400)])
    r = lm.score_lm(docs.limit(1), lm.train_lm(docs.coalesce(1))).first()
    assert r["log_prob"] / r["n_tokens"] > -np.log(8) + 0.2


def test_lm_rare_words_score_by_their_counts(spark):
    common = " ".join(f"c{i}" for i in range(lm.VOCABULARY - 2))
    docs = docs_of(spark, [(i, common) for i in range(8)] + [(9, "often " * 6 + "once")])
    model = lm.train_lm(docs, passes=1)
    assert model.n_rare == 7 and {r["n"] for r in model.rare.collect()} == {1, 6}
    got = {r["doc_id"]: r["log_prob"] for r in lm.score_lm(docs_of(spark, [(1, "often"), (2, "once"), (3, "unmet"), (4, "once ONCE"), (5, "twice")]), model).collect()}
    assert got[1] - got[2] == pytest.approx(np.log(6)) and got[2] == pytest.approx(got[3]) == pytest.approx(got[5])
    ids, at, _ = lm.Reader(model.numbers)(["once once"])
    assert got[4] == pytest.approx(lm.Scorer(model.theta)(ids, at).sum() + 2 * np.log(1 / 7), rel=1e-4)


def test_lm_chunks_make_no_difference(spark):
    theta = lm.start(np.ones(lm.VOCABULARY))
    p, read = lm.parts_of(theta), lm.Reader({b"a": 2, b"b": 3})
    ids, at, sizes = read(["a b a", None, "b c " * 50])
    assert sizes.tolist() == [3, 0, 100] and ids[at[:3]].tolist() == [2, 3, 2] and ids[at[4]] == 1
    whole = lm.forward(p, ids, at)
    parts = np.concatenate([lm.forward(p, ids, at[i : i + 7]) for i in range(0, len(at), 7)])
    assert np.allclose(whole, parts, atol=1e-4)
    assert np.allclose(whole, lm.Scorer(theta)(ids, at), atol=1e-4)


# -- mixing -----------------------------------------------------------------


def mix_rows(spark, n=4000):
    r = random.Random(4)
    rows = [(i, "w " * r.randrange(1, 20), r.choice(["en", "en", "de", None]), r.choice(["a", "a", "a", "b", "c"]), 0, True, 1, "k") for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def test_mix_meets_targets_both_ways(spark):
    from pyspark.sql import functions as F

    docs = mix_rows(spark)
    targets = {"source": {"a": 1.0, "b": 1.0, "c": 2.0}, "lang": {"en": 0.5, "de": 0.3, "": 0.2}}
    dims = {"source": F.col("source"), "lang": F.col("lang")}
    frames = [mixing.mix(docs, dims, mixing.tokens_in(F.col("text")), targets, driver_cells=c) for c in (1000, 0)]
    weights = [{r["doc_id"]: r["mix_weight"] for r in f.collect()} for f in frames]
    assert weights[0] == pytest.approx(weights[1], rel=1e-6)
    rows = frames[0].collect()
    total = sum(r["mix_tokens"] for r in rows)
    for dim, want in targets.items():
        for k, share in want.items():
            mass = sum(r["mix_tokens"] * r["mix_weight"] for r in rows if (r[dim] or "") == k)
            assert mass / total == pytest.approx(share / sum(want.values()), rel=1e-6)
            drawn = sum(r["mix_tokens"] * r["mix_copies"] for r in rows if (r[dim] or "") == k)
            assert drawn / total == pytest.approx(share / sum(want.values()), rel=0.1)
    assert frames[0].columns == docs.columns + ["mix_tokens", "mix_weight", "mix_probability", "mix_copies"]


def test_mix_cases(spark):
    from pyspark.sql import functions as F

    docs = docs_of(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")])
    dims, n = mixing.default_dims(), mixing.tokens_in(F.col("text"))
    out = mixing.mix(docs, dims, n).collect()
    assert len(out) == 5 and all(r["mix_weight"] == pytest.approx(1) for r in out) and [r["mix_tokens"] for r in out if r["doc_id"] == 3] == [2, 2]
    out = mixing.mix(docs, {"source": F.col("source")}, n, {"source": {"other": 1.0}}).collect()
    assert all(r["mix_copies"] == 0 for r in out)
    assert mixing.mix(docs_of(spark, []), dims, n).count() == 0
    assert max(r["mix_copies"] for r in mixing.mix(docs, dims, n, size=9.0, repeats=False).collect()) == 1


def test_rake_against_products():
    rng = np.random.default_rng(0)
    w = rng.random((4, 5)) * 100
    codes = [np.repeat(np.arange(4), 5), np.tile(np.arange(5), 4)]
    goals = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.2] * 5)]
    f = mixing.rake(w.reshape(-1), codes, goals).reshape(4, 5)
    assert np.allclose((w * f).sum(1), goals[0]) and np.allclose((w * f).sum(0), goals[1])
    assert np.allclose(f * f[0, 0], np.outer(f[:, 0], f[0]))  # a product of marginal factors


# -- URL filter -------------------------------------------------------------


def test_url_cases(spark):
    rows = [
        (1, "HTTP://WWW.Example.ORG/es/x?q#f"), (2, "http://example.org/de/"), (3, "http://badexample.org/es/"), (4, "https://a.com/fr/1"),
        (5, "https://a.com/de"), (6, "https://a.com/de/"), (7, None), (8, "no scheme.org/x"), (9, "http://x.net/p?page=1&ref=z"), (10, "http://www.x.net/p?page=1"),
        (11, "https://y.net/landing"), (11, "https://y.net/landing"), (12, "http://org"),
    ]
    pages = spark.createDataFrame([(i, u, f'<meta http-equiv="refresh" content="0; url=http://a.com/de/9">' if i == 11 else None, "h", "u") for i, u in rows], "page_id long, url string, html string, host string, _url string")
    rules = spark.createDataFrame([*urls.RULES, ("x.net", None, "block"), (None, "/", "block")], "host string, path string, action string")
    out = urls.filter_urls(pages, rules, urls.page_edges(pages)).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}
    assert len(out) == len(rows) and out[0]["_url"] == "u"
    assert got[1] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert got[2][2:] == ("org/", "allow") and got[3][2:] == ("org/", "allow") and got[12] == ("org", "", None, "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == (None, "block") and got[6][2:] == ("com/de/", "block")
    assert got[7] == ("", "", None, "allow") and got[8] == ("", "", None, "allow")
    assert got[9][2:] == ("x.net", "block")
    assert got[11][2:] == (None, "block")  # it redirects to a blocked page
    assert urls.filter_urls(pages.limit(0), rules, urls.page_edges(pages.limit(0))).count() == 0


def test_explicit_allow_goes_before_a_block_passed_on(spark):
    pages = spark.createDataFrame([(1, "http://a/x"), (2, "http://b/x"), (3, "http://c/x"), (4, "http://d/x"), (5, "http://e/x")], "page_id long, url string")
    edges = spark.createDataFrame([("http://a/x", "http://b/x"), ("http://b/x", "http://c/x"), ("http://d/x", "http://e/x")], "u string, v string")
    rules = spark.createDataFrame([("a", "/", "block"), ("c", "/", "allow"), ("d", "/", "block")], "host string, path string, action string")
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, rules, edges).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "block"}


