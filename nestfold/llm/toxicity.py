"""Toxicity by non-negative positive-unlabelled learning, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestfold.llm.common import discard, store, table
from nestfold.llm.files import arrow_schema, trimmed
from nestfold.llm.registry import register
from nestfold.llm.slices import ROW, added, cut

#: Labelled rows, and rows without a label, whose texts the classifier is fitted
#: on, at most.
SAMPLE_ROWS, UNLABELLED_ROWS = 30_000, 10_000
FEATURE_BITS, STEM = 18, 5
#: How many standard errors a feature's share of the toxic texts must lie from its share of all.
LEAST_Z = 5.0
STEPS, RATE, DECAY = 400, 0.05, 2e-5
THRESHOLD = 0.7
ROWS = "toxic boolean, features binary"
KEPT_WORDS = 300_000

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_features(word: bytes) -> tuple[int, ...]:
    from xxhash import xxh3_64_intdigest

    mask = (1 << FEATURE_BITS) - 1
    own = xxh3_64_intdigest(word) & mask
    return (own,) if len(word) <= STEM else (own, xxh3_64_intdigest(word[:STEM]) & mask)


def words_of(text: str | None) -> set[bytes]:
    return set(WORD.findall((text or "").encode("utf-8", "surrogatepass").lower()))


@dataclass
class Model:
    """Weights by feature, and the bias; a text's features count once each."""

    weights: dict[int, float]
    bias: float

    def scorer(self):
        kept: dict[bytes, tuple] = {}

        def score(text: str | None) -> float:
            if len(kept) > KEPT_WORDS:
                kept.clear()
            found = set()
            for w in words_of(text):
                f = kept.get(w)
                if f is None:
                    f = kept[w] = tuple(x for x in word_features(w) if x in self.weights)
                if f:
                    found.update(f)
            z = self.bias + sum(self.weights[x] for x in sorted(found))
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

        return score


def _select(in_p: np.ndarray, n_p: int, in_u: np.ndarray, n_u: int) -> np.ndarray:
    """Features whose shares among toxic texts and all texts differ beyond
    chance, from the number of texts of either kind that have each."""
    p, u = in_p / max(n_p, 1), (in_u + 0.5) / (n_u + 1)
    z = (p - u) / np.sqrt(u * np.maximum(1 - u, 1e-9) * (1 / max(n_p, 1) + 1 / max(n_u, 1)))
    return (np.abs(z) > LEAST_Z) & ((in_p >= 3) | (z < 0))


def fit_nnpu(positive, unlabelled, prior: float, names: np.ndarray) -> Model:
    """Logistic weights that minimise the non-negative risk
    ``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])``.

    Both sets are (places in ``names``, row starts); ``names`` are the features.
    Where the second term is below zero, the step goes up it instead, so the
    model cannot win by fitting toxic texts that stand unmarked among the
    unlabelled ones. Without positives, or a prior of 0 or 1, the score is the
    prior.
    """
    safe = min(max(prior, 1e-6), 1 - 1e-6)
    bias = float(np.log(safe / (1 - safe)))
    if len(positive[1]) < 2 or len(unlabelled[1]) < 2 or not 0 < prior < 1:
        return Model({}, bias)
    p, u = positive, unlabelled
    score = lambda x, w, b: b + np.diff(np.concatenate([[0], np.cumsum(w[x[0]])])[x[1]])
    push = lambda x, g: np.bincount(x[0], np.repeat(g, np.diff(x[1])), minlength=len(names))
    theta, m, v = np.append(np.zeros(len(names)), bias), 0.0, 0.0
    for step in range(1, STEPS + 1):
        zp, zu = score(p, theta[:-1], theta[-1]), score(u, theta[:-1], theta[-1])
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if rest >= 0:
            gp, gu = -prior / len(sp) * np.ones(len(sp)), su / len(su)
        else:
            gp, gu = prior * sp / len(sp), -su / len(su)
        g = np.append(push(p, gp) + push(u, gu) + DECAY * theta[:-1], gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(dict(zip(names.tolist(), theta[:-1].tolist())), float(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled rows and ``unlabelled_rows`` rows
    that have no label, those with the smallest hashes of their id, none of them
    held out. Toxic ones are the positives; the unlabelled set is all of them,
    the labels of those that have one taken off. The class prior is the toxic
    share of all labels that are not held out. The driver gets feature counts of
    a fixed size and the selected features of the sample. Several labels of one
    document count as toxic if one does; null ids and labels are left out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    toxic, every = known.agg(F.count_if("toxic"), F.count("*")).first()
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rest = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct().join(known, "doc_id", "left_anti")
    rest = rest.orderBy(F.xxhash64("doc_id"), "doc_id").limit(unlabelled_rows).withColumn("toxic", F.lit(None).cast("boolean"))
    rows = docs.select("doc_id", "text").join(F.broadcast(some.unionByName(rest)), "doc_id").select("toxic", "text")

    def features(batches):
        for batch in batches:
            found = [np.unique(np.array([f for w in words_of(t) for f in word_features(w)], np.uint32)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.binary())], schema=arrow_schema(ROWS))

    size = 1 << FEATURE_BITS

    def count(batches):
        total = np.zeros(2 * size, np.uint64)
        for batch in batches:
            for toxic, f in zip(batch.column("toxic").to_pylist(), batch.column("features").to_pylist()):
                found = np.frombuffer(f, np.uint32).astype(np.int64)
                total[size + found] += 1
                if toxic:
                    total[found] += 1
        parts = cut(total)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], schema=arrow_schema(ROW))

    rows = store(rows.mapInArrow(trimmed(features), ROWS), "toxicity-features")
    n_p, n_u = rows.agg(F.count_if("toxic"), F.count("*")).first()
    counts = added(rows.mapInArrow(trimmed(count), ROW), np.uint64, 2 * size)
    keep = _select(counts[:size].astype(float), n_p, counts[size:].astype(float), n_u)
    place = np.cumsum(keep) - 1

    def kept(batches):
        for batch in batches:
            chosen = [f[keep[f]] for f in (np.frombuffer(x, np.uint32) for x in batch.column("features").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([place[f].astype(np.uint32).tobytes() for f in chosen], pa.binary())], schema=arrow_schema(ROWS))

    got = rows.mapInArrow(trimmed(kept), ROWS).toArrow()  # a few selected features of each sampled row
    flags = np.asarray(got.column("toxic").to_pylist(), bool)
    parts = [np.frombuffer(x, np.uint32).astype(np.int64) for x in got.column("features").to_pylist()]
    discard(rows)

    def packed(which):
        chosen = [parts[i] for i in which]
        return np.concatenate([np.zeros(0, np.int64), *chosen]), np.cumsum([0, *map(len, chosen)])

    return fit_nnpu(packed(np.flatnonzero(flags)), packed(range(len(parts))), toxic / every if every else 0.0, np.flatnonzero(keep))


def toxicity(docs: DataFrame, model: Model, score_col: str = "toxicity") -> DataFrame:
    """``docs`` with ``score_col`` added: the probability that the whole text is
    toxic, from its words alone. An empty or null text gets the model's score
    of no words. An existing column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = shared.value.scorer()
        for t in texts:
            yield pd.Series([score(x) for x in t], dtype="float64")

    return docs.withColumn(score_col, scored(F.col("text")))


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity(docs, train(docs, table(spark, sf_dir, "labels")), "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
