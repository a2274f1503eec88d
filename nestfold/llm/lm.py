"""Document scores by masked pseudo-likelihood: a bidirectional window network,
trained in numpy, predicts every token from both sides."""

from __future__ import annotations

from array import array
from collections import Counter
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from nestfold.llm.common import spare, store, table
from nestfold.llm.files import arrow_schema
from nestfold.llm.registry import register
from nestfold.llm.slices import ROW, added, cut

#: Words of the network: CLASSES groups of MEMBERS, by falling frequency. Word 0
#: stands outside every text, word 1 for all rarer words.
CLASSES = MEMBERS = 64
VOCABULARY = CLASSES * MEMBERS
SIDE, WIDTH = 3, 16
#: A pass trains on every position of every text, in rounds over parts of the
#: texts; tasks meet after each round.
PASSES, ROUNDS, BATCH, RATE = 1, 2, 4096, 0.1
CHUNK = 1 << 13
HELD_WORDS = 300_000

#: A-Z in lower case; ASCII that is neither letter nor digit parts words.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def count_words(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` over all texts, counted in each task first."""

    def run(batches):
        seen: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], schema=arrow_schema("word binary, n long"))

        for batch in batches:
            for t in batch.column(0):
                seen.update(words_of(t.as_py()))
                if len(seen) > HELD_WORDS:
                    yield rows()
                    seen.clear()
        yield rows()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


SHAPES = {
    "embed": (VOCABULARY, WIDTH),
    "place": (2 * SIDE, WIDTH),
    "inner": (WIDTH,),
    "to_class": (WIDTH, CLASSES),
    "class": (CLASSES,),
    "to_member": (CLASSES, WIDTH, MEMBERS),
    "member": (CLASSES, MEMBERS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def parts_of(theta: np.ndarray) -> dict[str, np.ndarray]:
    """The network's arrays, as views of one vector."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = theta[at : at + n].reshape(shape)
        at += n
    return out


def start(counts: np.ndarray) -> np.ndarray:
    """First parameters: small random ones, with biases that give each word its
    frequency."""
    theta = np.zeros(SIZE, np.float32)
    p, rng = parts_of(theta), np.random.default_rng(0)
    p["embed"][:] = rng.normal(0, 0.1, p["embed"].shape)
    p["place"][:] = 1.0
    p["to_class"][:] = rng.normal(0, 0.1, p["to_class"].shape)
    p["to_member"][:] = rng.normal(0, 0.1, p["to_member"].shape)
    by = np.maximum(counts, 0.5).reshape(CLASSES, MEMBERS)
    p["class"][:] = np.log(by.sum(1) / by.sum())
    p["member"][:] = np.log(by / by.sum(1, keepdims=True))
    return theta


#: Scores are cut here, so that no exponential overflows.
MOST = 80.0


def _below_most(z):
    """``z``, cut at ``MOST`` in place where anything passes it."""
    return np.minimum(z, MOST, out=z) if z.size and not z.max() <= MOST else z


def _softmax(z, scale=1.0):
    """``z`` becomes the softmax of its rows, times ``scale``."""
    np.exp(_below_most(z), out=z)
    z *= (z.dtype.type(scale) / (z @ np.ones(z.shape[1], z.dtype)))[:, None]
    return z


OFFSETS = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])
#: Positions that are multiplied by a place's weights as one row.
LANES = 64


def _shifts(x):
    """Rows of ``x`` as seen by each neighbour, ``LANES`` positions a row."""
    flat, size = x.reshape(-1), (len(x) - 2 * SIDE) * WIDTH
    return [flat[(SIDE + o) * WIDTH :][:size].reshape(-1, LANES * WIDTH) for o in OFFSETS.tolist()]


def _around(p, ids, begin, end):
    """The words of positions ``begin`` to ``end`` and ``SIDE`` on either side,
    filled up with word 0 to whole rows of ``LANES``; their embeddings, the
    weights of each place as such rows, and the weighted sum of each position's
    neighbours."""
    words = np.concatenate([ids[begin - SIDE : end + SIDE], np.zeros((begin - end) % LANES, ids.dtype)])
    e, weights = p["embed"][words], np.tile(p["place"], LANES)
    shifts = _shifts(e)
    h = shifts[0] * weights[0]
    term = np.empty_like(h)
    for x, w in zip(shifts[1:], weights[1:]):
        h += np.multiply(x, w, out=term)
    return words, e, weights, h.reshape(-1, WIDTH)


def forward(p, ids, at, gradient=None):
    """Log-probabilities of the ascending positions ``at`` of ``ids`` from the
    words around. With ``gradient``, arrays like ``p``, it adds the gradient of
    their negative mean to it instead.

    Words are looked up once for the whole stretch of positions; a neighbour is
    a shift of it, forward and back."""
    if not len(at):
        return np.zeros(0, p["inner"].dtype)
    begin = at[0]
    words, e, weights, h = _around(p, ids, begin, at[-1] + 1)
    n, place = len(h), at - begin
    order = np.argsort((ids[at] >> 6).astype(np.uint16), kind="stable")
    target, place = ids[at[order]], place[order]
    h = h[place]
    h += p["inner"]
    np.tanh(h, out=h)
    c, m, rows = target >> 6, target & 63, np.arange(len(at))
    cuts = np.searchsorted(c, np.arange(CLASSES + 1)).tolist()
    live = [(k, slice(lo, hi)) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if lo < hi]
    share = 1.0 if gradient is None else 1 / len(at)
    pc = h @ p["to_class"]
    pc += p["class"]
    _softmax(pc, share)
    pm = np.empty((len(at), MEMBERS), h.dtype)
    for k, own in live:
        part = np.matmul(h[own], p["to_member"][k], out=pm[own])
        part += p["member"][k]
    _softmax(pm, share)
    if gradient is None:
        logp = np.empty(len(at), h.dtype)
        logp[order] = np.log(np.maximum(pc[rows, c], 1e-30)) + np.log(np.maximum(pm[rows, m], 1e-30))
        return logp
    pc[rows, c] -= h.dtype.type(share)
    pm[rows, m] -= h.dtype.type(share)
    ones = np.ones(len(at), h.dtype)
    gradient["to_class"] += h.T @ pc
    gradient["class"] += ones @ pc
    dh = pc @ p["to_class"].T
    for k, own in live:
        some, mine = h[own], pm[own]
        gradient["to_member"][k] += some.T @ mine
        gradient["member"][k] += ones[own] @ mine
        dh[own] += mine @ p["to_member"][k].T
    h *= h
    np.subtract(1, h, out=h)
    dh *= h
    gradient["inner"] += ones @ dh
    back = np.zeros((n, WIDTH), dh.dtype)
    back[place] = dh
    de = np.zeros(e.shape, dh.dtype)
    lanes, term = back.reshape(-1, LANES * WIDTH), np.empty((n // LANES, LANES * WIDTH), dh.dtype)
    for j, (x, w, o) in enumerate(zip(_shifts(de), weights, OFFSETS)):
        gradient["place"][j] += np.einsum("bd,bd->d", back, e[SIDE + o : SIDE + o + n])
        x += np.multiply(lanes, w, out=term)
    by = np.argsort(words.astype(np.uint16), kind="stable")
    ordered = words[by]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    gradient["embed"][ordered[first]] += np.add.reduceat(de[by], first)
    return None


def _log_share(z, k):
    """Log-softmax of ``z`` at column ``k`` of each row."""
    _below_most(z)
    picked = z[np.arange(len(z)), k]
    np.exp(z, out=z)
    return picked - np.log(z @ np.ones(z.shape[1], z.dtype))


class Scorer:
    """``forward`` without a gradient."""

    def __init__(self, theta: np.ndarray):
        self.p = parts_of(theta)

    def __call__(self, ids, at):
        p = self.p
        if not len(at):
            return np.zeros(0, p["inner"].dtype)
        h = _around(p, ids, at[0], at[-1] + 1)[3]
        target = ids[at]
        order = np.argsort((target >> 6).astype(np.uint16), kind="stable")
        target = target[order]
        h = h[at[order] - at[0]]
        h += p["inner"]
        np.tanh(h, out=h)
        c, m = target >> 6, target & 63
        z = h @ p["to_class"]
        z += p["class"]
        inside = _log_share(z, c)
        cuts = np.searchsorted(c, np.arange(CLASSES + 1)).tolist()
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if lo < hi:
                part = np.matmul(h[lo:hi], p["to_member"][k], out=z[lo:hi])
                part += p["member"][k]
        inside += _log_share(z, m)
        logp = np.empty(len(at), h.dtype)
        logp[order] = inside
        return logp


class Reader:
    """Word numbers of texts, with ``SIDE`` zeros around each text."""

    def __init__(self, numbers: dict[bytes, int]):
        self.numbers = numbers

    def __call__(self, texts, rare: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All numbers, the positions of words among them, words per text. The
        counts of each text's words without a number go to ``rare``."""
        get, edge, sizes = self.numbers.get, [0] * SIDE, []
        out = array("q", edge)
        for t in texts:
            words = words_of(t)
            begin = len(out)
            out.extend(map(get, words, repeat(1)))
            if rare is not None:
                unknown = np.flatnonzero(np.frombuffer(out, np.int64)[begin:] == 1).tolist()
                rare.append(Counter([words[i] for i in unknown]))
            out.extend(edge)
            sizes.append(len(words))
        sizes = np.array(sizes, np.int64)
        at = np.arange(int(sizes.sum())) + np.repeat(SIDE * (1 + np.arange(len(sizes))), sizes)
        return np.frombuffer(out, np.int64), at, sizes


def _pass(docs: DataFrame, numbers, theta: np.ndarray) -> np.ndarray:
    """One round: every task trains from ``theta`` on its texts, and the mean of
    the changes, weighted by windows, is applied. What a small task did not
    touch is zero, which the shuffle's compression takes out."""
    given = docs.sparkSession.sparkContext.broadcast((numbers, theta))

    def run(batches):
        numbers, theta = given.value
        read, given_theta, theta, seen = Reader(numbers), theta, theta.copy(), 0
        p, square = parts_of(theta), np.full(SIZE, 1e-3, np.float32)
        grad, change = np.zeros(SIZE, np.float32), np.empty(SIZE, np.float32)
        g = parts_of(grad)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                ids, at, _ = read(batch.column(0).slice(k, 256).to_pylist())
                for lo in range(0, len(at), BATCH):
                    some = at[lo : lo + BATCH]
                    grad[:] = 0
                    forward(p, ids, some, g)
                    np.multiply(grad, grad, out=change)
                    square += change
                    np.sqrt(square, out=change)
                    np.divide(grad, change, out=change)
                    change *= RATE
                    theta -= change
                    seen += len(some)
        parts = cut((theta - given_theta).astype(np.float16)) if seen else []
        columns = [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary()), pa.array([float(seen)] * len(parts))]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema(schema))

    schema = ROW + ", weight double"
    return theta + added(docs.select("text").mapInArrow(run, schema), np.float16, SIZE).astype(np.float32)


class Model(NamedTuple):
    """Word numbers, parameters, and the counts (``key``, ``n``) of all words
    without a number, with their sum."""

    numbers: dict[bytes, int]
    theta: np.ndarray
    rare: DataFrame
    n_rare: int


def train_lm(docs: DataFrame, passes: int = PASSES, rounds: int = ROUNDS) -> Model:
    """The vocabulary comes from the counts of all texts, ties by the word
    itself; the counts of all other words stay a table. A pass goes over every
    position of all texts, in ``rounds`` over parts of them (by a hash of the
    text), each task on its own share; parameters are averaged after a round."""
    counts = store(count_words(docs), "lm-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - 2).collect()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    numbers = {bytes(r["word"]): i + 2 for i, r in enumerate(top)}
    known = [r["n"] for r in top]
    shares = np.zeros(VOCABULARY)
    shares[1] = total - sum(known)
    shares[2 : 2 + len(known)] = known
    theta = start(shares)
    part = F.pmod(F.xxhash64("text"), F.lit(rounds))
    for k in range(passes * rounds):
        theta = _pass(docs.where(part == k % rounds) if rounds > 1 else docs, numbers, theta)
    least, last = (top[-1]["n"], bytes(top[-1]["word"])) if top else (0, b"")
    rare = counts.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("word") > F.lit(last))))
    rare = rare.groupBy(F.xxhash64("word").alias("key")).agg(F.sum("n").alias("n"))
    return Model(numbers, theta, store(rare, "lm-rare"), total - sum(known))


def score_lm(docs: DataFrame, model: Model, kept: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``kept``) with ``n_tokens`` and ``log_prob``
    added: the sum over all words of the whole text of log p(word | three words
    on either side). A word outside the vocabulary has its own share of the
    rare words' probability, its count over all of theirs; one that training
    has not met counts as met once. The counts are joined by a shuffle on a
    hash of the word. A text without words, or null, scores 0. Columns of those
    names are replaced."""
    given = docs.sparkSession.sparkContext.broadcast((model.numbers, model.theta))

    kept = [c for c in kept or docs.columns if c not in ("n_tokens", "log_prob")]
    both, row = spare(docs, "_scores"), spare(docs, "_row")
    fields = [f for f in docs.select(*kept).schema.fields]
    found = StructType([*fields, StructField("n_tokens", LongType()), StructField("log_prob", DoubleType()), StructField(both, ArrayType(BinaryType())), StructField(row, ArrayType(LongType()))])
    names = [f.name for f in found.fields]

    def run(batches):
        numbers, theta = given.value
        read, score = Reader(numbers), Scorer(theta)
        for batch in batches:
            texts, rare, n_tokens, log_prob = batch.column(len(fields)).to_pylist(), [], [], []
            for k in range(0, len(texts), 128):
                ids, at, sizes = read(texts[k : k + 128], rare)
                logp = np.zeros(len(at))
                for lo in range(0, len(at), CHUNK):
                    logp[lo : lo + CHUNK] = score(ids, at[lo : lo + CHUNK])
                sums = np.concatenate([[0.0], np.cumsum(logp)])[np.concatenate([[0], np.cumsum(sizes)])]
                n_tokens.append(sizes), log_prob.append(np.diff(sums))
            if texts:
                offsets = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
                words = pa.array([w for c in rare for w in c], pa.binary())
                times = pa.array([n for c in rare for n in c.values()], pa.int64())
                columns = [*batch.columns[:-1], pa.array(np.concatenate(n_tokens)), pa.array(np.concatenate(log_prob))]
                lists = [pa.ListArray.from_arrays(offsets, x) for x in (words, times)]
                yield pa.RecordBatch.from_arrays([*columns, *lists], names=names)

    # a word outside the vocabulary is no thousandth of all words, so no key is hot
    out = docs.select(*kept, F.col("text").alias(spare(docs, "_text"))).mapInArrow(run, found)
    keys = F.zip_with(both, row, lambda w, n: F.struct(F.xxhash64(w).alias("key"), n.alias("times"))).alias(both)
    out = store(out.select(*kept, "n_tokens", "log_prob", keys, F.monotonically_increasing_id().alias(row)), "lm-scores")
    met = out.select(row, F.explode(both).alias("_x")).select(row, "_x.key", "_x.times").join(model.rare, "key", "left")
    share = F.log(F.coalesce("n", F.lit(1)) / F.lit(float(max(1, model.n_rare))))
    shares = met.groupBy(row).agg(F.sum(F.col("times") * share).alias(both))
    return out.drop(both).join(shares, row, "left").select(*kept, "n_tokens", (F.col("log_prob") + F.coalesce(both, F.lit(0.0))).alias("log_prob"))


@register("op9_lm_scoring")
def op9_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_lm(docs, train_lm(docs), ["doc_id"])
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return out.select("doc_id", "n_tokens", "log_prob", mean.alias("mean_log_prob"))
