"""A training corpus from `documents`: good ones, without repeated runs of lines, one of each group of near duplicates, without
personal data, packed. Each stage is one operator; its result is written and read again as the next one's documents.

Null and empty texts are one passage without words for the classifier and stay or go by its score; lines, n-grams and personal data have
nothing to find in them, and packing gives them one token. Of copies the first by doc_id, then by a hash of the text, stays (null ids go first
for lines and last for documents); rows that repeat an id with different texts are documents of their own. Extra columns of any name stay
up to the last stage. An empty table gives an empty result."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywatch.llm import line_dedup, ngram_join, packing, pii, quality_mil
from paywatch.llm.common import table
from paywatch.session import stage


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with n_chars after a change of the text."""
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return docs.select(*[f"`{c}`" for c in columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_mil.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.dedup_lines(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, k=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.redact_documents(docs), docs.columns)


def mixture_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("ngram_join", near_duplicates),
    ("personal_data", personal_data),
    ("mixture_packing", mixture_packing),
]

# The classifier is trained and n-gram components are iterated: not SQL. tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
