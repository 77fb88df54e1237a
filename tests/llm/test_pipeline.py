"""The pipeline against plain versions of its stages, each on what the stage before it kept."""

from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from paywatch.llm import pii, quality_mil
from paywatch.session import stage
from tests.llm import plain
from tests.llm.test_operators import DOCS, SCHEMA, check_packing, ids_of

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_plain_versions(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_join", "personal_data", "mixture_packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    functions = [f for _, f in corpus_pipeline.STAGES]

    good = stage(functions[0](spark, docs, FOLDER), "good")
    scored = quality_mil.score_quality(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert set(texts(good)) == {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert all(texts(docs)[d] == t for d, t in texts(good).items()) and good.count() > 100

    lines = stage(functions[1](spark, good, FOLDER), "lines")
    assert texts(lines) == plain.without_repeated_runs(sorted(texts(good).items()))

    one = stage(functions[2](spark, lines, FOLDER), "one")
    found = plain.near(sorted(texts(lines).items()), 5, 80)
    assert set(texts(one)) == {d for d, (_, root) in found.items() if d == root}

    private = stage(functions[3](spark, one, FOLDER), "private")
    whole = texts(one)
    for d, t in texts(private).items():
        before = whole[d]
        assert t == pii.redact(before)
        if not plain.spans(plain.PERSONAL, before):
            assert t == before
    for df in (good, lines, one, private):
        assert df.columns == COLUMNS
        assert df.where(F.col("n_chars") != F.length("text")).count() == 0

    check_packing(functions[4](spark, private, FOLDER).collect(), [(d, ids_of(t)) for d, t in texts(private).items()])


def test_registered_query_runs_all_stages(spark):
    pieces = queries()["pipeline"](spark, FOLDER)
    assert pieces.count() > 100 and "sequence_id" in pieces.columns


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in DOCS], SCHEMA + ", n_chars long")
    for rows in (docs, docs.limit(0)):
        for name, function in corpus_pipeline.STAGES:
            rows = stage(function(spark, rows, FOLDER), name)
            if name != "mixture_packing":
                assert rows.columns == COLUMNS
