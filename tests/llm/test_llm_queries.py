"""The registered corpus queries on the smallest tables: against SQL where there
is one, else against brute force; and the pipeline."""

import zlib

import pytest

import corpus_pipeline
from nestfold.llm import tokens
from nestfold.llm.queries import ORACLES, QUERIES
from nestfold.testing import compare, duckdb_conn

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF), duckdb_conn(SF), ORACLES[name])
    assert ok, msg


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_token_query_against_whole_texts(spark):
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(tokens.default_tokenizer())
    at, want = 0, set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.add((r["doc_id"], at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    assert {tuple(r) for r in QUERIES["op7_token_ids"](spark, SF).collect()} == want


def test_scores_cover_all_documents(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    tox = QUERIES["op8_toxicity"](spark, SF).collect()
    assert len(tox) == n and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in tox)
    lm = QUERIES["op9_lm_scoring"](spark, SF).collect()
    assert len(lm) == n and all(r["log_prob"] <= 0 for r in lm)
    mix = QUERIES["op4_mixing"](spark, SF).collect()
    total = sum(r["tokens"] for r in mix)
    assert len(mix) == n and sum(r["tokens"] * r["weight"] for r in mix) == pytest.approx(total, rel=1e-6)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # repeated rows, null ids and a clashing column do not upset a stage
    odd = docs.unionByName(docs.limit(20)).unionByName(docs.limit(5).selectExpr("CAST(NULL AS long) AS doc_id", "text", "lang", "source", "n_chars"))
    odd = odd.selectExpr("*", "1 AS _row", "'x' AS _toxicity")
    for stages in (corpus_pipeline.STAGES,):
        rows = odd
        for name, stage in stages[:-1]:
            before = rows.count()
            rows = stage(spark, rows, SF)
            assert rows.columns == odd.columns, name
            assert 0 < rows.count() <= before
    from nestfold.llm import decontam, jaccard

    left = rows.select("doc_id", "text")
    found = jaccard.jaccard_components(left).collect()
    assert len({r["component_id"] for r in found if r["n_shingles"]}) == len([r for r in found if r["n_shingles"]])
    assert decontam.decontaminate(left, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0


def test_pipeline_of_empty_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
    assert rows.count() == 0


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100
