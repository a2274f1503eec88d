"""The corpus pipeline: toxic documents go, one document of each group of near
copies stays, contaminated documents go, the rest is sampled to target
weights and written as token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read again as the next one's ``docs``. All but the last return the
columns of ``docs``.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from nestfold.llm import decontam, jaccard, mixing, tokens, toxicity
from nestfold.llm.common import corpus_session, discard, fits, moved, spare, store, table


#: Keys, of a few bytes each, that are broadcast at most.
MOST_GONE = 1_000_000
#: Tokens drawn, of those that reach the mixing stage.
MIX_SIZE = 0.9


def beside(stage):
    """``stage`` in a session with the settings of the corpus queries."""

    @functools.wraps(stage)
    def run(spark, docs, sf_dir):
        own = corpus_session(spark)
        return stage(own, moved(docs, own), sf_dir)

    return run


def keyed(docs):
    """``docs`` with a column that no two rows share, and its name: a copy of
    ``doc_id`` where that is so already, else a number of the row in a stored
    copy of the table."""
    key = spare(docs, "_row")
    ids = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if ids.limit(1).count() == 0:
        return docs.withColumn(key, F.col("doc_id").cast("long")), key
    return store(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows"), key


def without(rows, key, gone):
    """Rows whose ``key`` is not in ``gone``, a list counted before it is broadcast."""
    gone = store(gone, "pipeline-gone")
    return rows.join(F.broadcast(gone) if fits(gone, MOST_GONE) else gone, key, "left_anti").drop(key)


@beside
def drop_toxic(spark, docs, sf_dir):
    """Documents that score ``toxicity.THRESHOLD`` or more go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = spare(docs, "_toxicity")
    return toxicity.toxicity(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


@beside
def drop_near_copies(spark, docs, sf_dir):
    """Of each component of linked documents the one with the smallest id stays.
    Texts without words are linked with nothing and all stay."""
    rows, key = keyed(docs)
    found = jaccard.jaccard_components(rows, key)
    return without(rows, key, found.where(F.col(key) != F.col("component_id")).select(key)).select(*docs.columns)


@beside
def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item, exactly or nearly, go."""
    rows, key = keyed(docs)
    found = decontam.decontaminate(rows, table(spark, sf_dir, "benchmark"), key, near=True)
    return without(rows, key, found.where("contaminated OR n_near > 0").select(key)).select(*docs.columns)


@beside
def sample_to_weights(spark, docs, sf_dir):
    """Documents are drawn with the raked probabilities, none of them twice:
    scarce categories stay whole, frequent ones are thinned."""
    mixed = mixing.mix(docs, mixing.default_dims(), mixing.tokens_in(F.col("text")), size=MIX_SIZE, repeats=False)
    return mixed.where("mix_copies > 0").select(*docs.columns)


@beside
def write_tokens(spark, docs, sf_dir):
    """Token ids in files, and a row for each document read back from them."""
    return tokens.tokens_of(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", sample_to_weights),
    ("token_ids", write_tokens),
]

#: A trained classifier and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    spark = corpus_session(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, store(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if hasattr(before, "_stored_at"):
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
