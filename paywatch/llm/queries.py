"""Queries of the text operators: each takes (spark, folder of parquet tables) and returns a DataFrame."""

from pyspark.sql import functions as F

from paywatch.llm import (
    exact_dedup, line_dedup, ngram_join, order_minhash, packing, pii, quality_mil, secrets, sentencepiece_nbest, source_audit, source_mix,
    url_filter, whitening,
)
from paywatch.llm.common import table


def op1_secret_scan(spark, folder):
    return secrets.scan_secrets(table(spark, folder, "documents"))


def op2_quality_mil(spark, folder):
    return quality_mil.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_sentencepiece_nbest(spark, folder):
    rows = sentencepiece_nbest.decode(sentencepiece_nbest.encode(table(spark, folder, "documents")))
    changed = F.transform("changes", lambda c: F.concat_ws(
        ":", c["rank"], c["start"], c["length"], F.array_join(c["ids"], " ")))
    return rows.select(
        "doc_id", F.size("ids").alias("n_pieces"), F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        "scores", F.array_join(changed, ",").alias("changes"), (F.col("decoded") == F.col("text")).alias("round_trip"))


def op4_url_filter(spark, folder):
    return url_filter.judge_urls(table(spark, folder, "pages"))


def op5_mixture_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


def op6_personal_data(spark, folder):
    return pii.scan_personal_data(table(spark, folder, "documents"))


def op7_ngram_join(spark, folder):
    return ngram_join.near_duplicates(table(spark, folder, "documents"), k=4, percent=85)


def op8_exact_dedup(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op9_line_dedup(spark, folder):
    rows = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return rows.select("doc_id", "removed_lines", F.length("text").cast("long").alias("kept_chars"),
                       F.sha2("text", 256).alias("text_sha256"))


def op10_order_minhash(spark, folder):
    return order_minhash.fingerprint(table(spark, folder, "documents"))


def op11_source_mix(spark, folder):
    return source_mix.mix(table(spark, folder, "documents"))


def op12_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_source_audit(spark, folder):
    return source_audit.audit(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_quality_mil, op3_sentencepiece_nbest, op4_url_filter,
    op5_mixture_packing, op6_personal_data, op7_ngram_join, op8_exact_dedup, op9_line_dedup, op10_order_minhash,
    op11_source_mix, op12_whitening, op13_source_audit)}
