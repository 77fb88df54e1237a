"""Source mix, source audit and whitening against SQL and plain versions, on odd rows."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from paywatch.llm import source_audit, source_mix, whitening
from paywatch.llm.oracle import ORACLE
from tests.llm.test_operators import CLASHES, DOCS, SCHEMA

OTHERS = ("size", "place", "again", "target", "terms", "counts", "n", "rank", "x", "state")


def wide(df):
    return df.withColumns({c: F.lit(1) for c in (*CLASHES, *OTHERS)})


def by_sql(name, docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toPandas())
    con.execute("create table t as select cast(doc_id as bigint) as doc_id, text, lang, source from documents")
    con.execute("create view documents2 as select * from t")
    sql = ORACLE[name].replace("FROM documents", "FROM documents2")
    return sorted(con.execute(sql).fetchall(), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 11: source mix ---------------------------------------------------------------------------------------------------

def hot_docs(n=600):
    rng = random.Random(5)
    out = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "c", None, "é", "", "=x", "null"])
        out.append((i if i % 7 else None, " ".join(["w"] * rng.choice([0, 1, 3, 10, 200])), "en", source))
    return out + [(5, "same text again " * 40, "en", "copies")] * 300 + [(None, None, None, None)] * 20


def test_mix_equals_sql(spark):
    for data in (DOCS, hot_docs()):
        docs = spark.createDataFrame(data, SCHEMA).repartition(5)
        assert rows(source_mix.mix(wide(docs))) == by_sql("op11_source_mix", docs)


def test_mix_is_near_its_targets_and_repeats(spark):
    docs = spark.createDataFrame(hot_docs(), SCHEMA)
    first = source_mix.mix(docs.repartition(3))
    again = source_mix.mix(docs.repartition(7, "text"))
    assert rows(first) == rows(again)
    for r in first.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size"),
                                         F.max("size").alias("longest"), F.sum("size").alias("sum")).collect():
        assert r["sum"] == r["size"] and abs(r.taken - r.target) <= r.longest / 2
    assert first.where("taken > 2 * size").count() == 0
    copies = {r.taken for r in first.where("source = 'copies'").select("taken").distinct().collect()}
    assert copies <= {0, 120, 240} and len(copies) > 1  # equal rows are told apart


def test_mix_refines_level_by_level(spark):
    """Places that agree in their first bits, and rows that agree in all of them."""
    rows_ = spark.range(64).select(
        F.lit("=s").alias("source"), F.lit(1).cast("long").alias("size"), F.col("id").alias("place"), F.col("id").alias("again"))
    rows_ = rows_.union(rows_.select("source", "size", F.lit(1000).cast("long"), F.col("again") + 5))
    budgets = spark.createDataFrame([("=s", 128, 100.0)], "source string, source_size long, target double")
    ends = {r.copy: (r.place, r.again) for r in source_mix.thresholds(rows_, budgets).collect()}
    assert sorted(ends) == [1, 2] and ends[1][0] == 1000 and ends[1][1] == 41
    taken = rows_.where((F.col("place") < 1000) | (F.col("again") < ends[1][1])).count()
    assert taken == 100
    assert rows_.where((F.col("place") < ends[2][0]) | (F.col("place") == ends[2][0]) & (F.col("again") < ends[2][1])).count() == 0


def test_mix_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert source_mix.mix(wide(empty)).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "a"), (2, " \n", "en", None), (2, " \n", "en", None)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in source_mix.mix(blank).collect()] == [(0, 0.0, 0)] * 3


# 13: source audit -------------------------------------------------------------------------------------------------

def audit_docs():
    rng = random.Random(3)
    long = "Wort" * 40
    words = ["the", "The", "cat", "çedille", "ÇA", "x-y", "caterpillar", "cater", "a", " z", "zz9zz", long, long + "e", "long" + long, "日本語", "日本"]
    docs = []
    for i in range(400):
        weights = [((i % 5) + j) % 7 + 1 for j in range(len(words))]
        text = rng.choice([" ", "\n", "1", "\x00"]).join(rng.choices(words, weights, k=rng.choice([1, 5, 30])))
        docs.append((i, text, rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", "b", "c", "d", None, "Ä"])))
    docs += [(7, "copied text that many hold", "fr", "only")] * 50
    docs += [(None, None, "xx", f"s{i}") for i in range(3)] + [(8, "123 456", "xx", "s9"), (9, "q" * 300_000, "yy", "s")]
    return docs


def test_audit_equals_sql(spark):
    for data in (audit_docs(), DOCS):
        docs = spark.createDataFrame(data, SCHEMA).repartition(4)
        assert rows(source_audit.audit(wide(docs))) == by_sql("op13_source_audit", docs)


def test_audit_in_blocks_and_chunks(spark, monkeypatch):
    docs = spark.createDataFrame(audit_docs(), SCHEMA).repartition(4)
    whole = rows(source_audit.audit(docs))
    monkeypatch.setattr(source_audit, "MOST_BITS", 6)  # nearly every bit is set: more pass the bits, none the counts
    assert rows(source_audit.audit(docs, block=2, chunk=3)) == whole


def test_kept_terms_against_plain(spark):
    data = audit_docs()
    lists = source_audit.postings(spark.createDataFrame(data, SCHEMA).repartition(3))
    import re
    held = {}
    for i, (_, text, lang, _) in enumerate(data):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower):
            held.setdefault((lang or "", term), set()).add(i)
    want = sorted(k for k, v in held.items() if len(v) >= 10)
    assert sorted((r.lang, r.term.decode()) for r in source_audit.kept_terms(lists).collect()) == want


def test_shares_are_exact():
    rng = random.Random(1)
    for total in (1, 7, 10**6, 10**13 + 7, 9 * 10**15):
        for n in [0, max(0, total - 2), *(rng.randrange(total) for _ in range(50))]:
            if n + 2 <= total:
                assert int(source_audit._share(n, total)) == 1 + 10**9 * (n + 2) // total


def test_audit_edges(spark):
    assert source_audit.audit(wide(spark.createDataFrame([], SCHEMA))).count() == 0


# 12: whitening ----------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_whitening(x):
    """n, deviations, whitened values, explained shares of whole vectors (a row each)."""
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    away = (n * fit - s) / n
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [k for k in range(min(16, len(values))) if values[k] > 1e-12 * values.sum()]
    return n, ((n * x - s)**2).sum(1), ((n * x - s) / n) @ vectors[:, kept] / np.sqrt(values[kept]), values[kept] / values.sum()


def check_whitening(found, ids, x):
    n, deviations, whitened, explained = plain_whitening(x)
    many = len(explained)
    assert len(found) == len(ids) * many
    assert {r.n for r in found} == {n} and all(r.identity_error <= 1e-9 for r in found)
    order = {v: i for i, v in enumerate(ids)}
    got = np.zeros_like(whitened)
    for r in found:
        got[order[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviations[order[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    np.testing.assert_allclose(got * np.sign((got * whitened).sum(0)), whitened, atol=1e-8)


@pytest.mark.parametrize("rows_, dims, copies", [(400, 24, 0), (300, 5, 200), (10, 20, 0), (2000, 3, 0)])
def test_whitening_against_eigh(spark, rows_, dims, copies):
    rng = np.random.default_rng(rows_ + dims)
    c = (rng.normal(size=(rows_, dims)) * np.linspace(1, 3, dims)).astype(np.float32)
    c = np.concatenate([c, np.repeat(c[:1], copies, axis=0)])
    data = [(i, v.tolist(), 0) for i, v in enumerate(c)]
    found = whitening.whiten(wide(spark.createDataFrame(data, VECTORS).repartition(5))).collect()
    check_whitening(found, list(range(len(c))), np.floor(64 * c.astype(np.float64)).astype(np.int64) + 1_000_000)


def test_whitening_edges(spark):
    rng = np.random.default_rng(2)
    c = rng.normal(size=(30, 4)).astype(np.float32)
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [float("nan")] * 4), (104, [1.0, float("inf"), 0.0, 0.0]),
           (105, [1.0, 2.0])]
    data = [(i, v.tolist(), 0) for i, v in enumerate(c)] + [(i, v, 0) for i, v in bad]
    found = whitening.whiten(spark.createDataFrame(data, VECTORS).repartition(3)).collect()
    check_whitening(found, list(range(30)), np.floor(64 * c.astype(np.float64)).astype(np.int64) + 1_000_000)
    some = spark.createDataFrame([(None, [1.0, 2.0], 0), (1, [3.0, 2.0], 0), (1, [3.0, 2.0], 0)], VECTORS)
    assert sorted((r.vec_id is None, r.component, round(abs(r.whitened), 9)) for r in whitening.whiten(some).collect()) == [
        (False, 1, 1.0), (False, 1, 1.0), (True, 1, 1.0)]
    for data in ([], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)]):
        assert whitening.whiten(spark.createDataFrame(data, VECTORS)).count() == 0
    huge = spark.createDataFrame([(i, [float(i) * 1e30, float(i % 3)], 0) for i in range(6)], VECTORS)
    assert {r.deviation for r in whitening.whiten(huge).collect()} == {None}


def test_rank_one_updates_with_equal_values():
    rng = np.random.default_rng(4)
    values = np.array([[1.0, 1, 1, 2, 2, 5], [0, 0, 3, 3, 3, 3]])
    vectors = np.stack([np.linalg.qr(rng.normal(size=(6, 6)))[0] for _ in range(2)])
    whole = np.einsum("bij,bj,bkj->bik", vectors, values, vectors)
    for step in range(8):
        z, weight = rng.normal(size=(2, 6)), np.array([0.5, 2.0])
        z[:, 2:] *= step % 2  # some updates leave vectors alone
        z[1] *= step != 5
        whole = whole + weight[:, None, None] * z[:, :, None] * z[:, None, :]
        whitening.rank_one(values, vectors, z, weight)
        np.testing.assert_allclose(np.einsum("bij,bj,bkj->bik", vectors, values, vectors), whole, atol=1e-8)
        np.testing.assert_allclose(np.einsum("bji,bjk->bik", vectors, vectors), np.stack([np.eye(6)] * 2), atol=1e-12)
        assert (np.diff(values, axis=1) >= 0).all()


def test_spectra_combine():
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(101, 7)) * 4)
    parts = whitening.Spectra.empty(4, 7)
    for i in range(0, len(x), 4):
        part = x[i:i + 4]
        parts.part(slice(0, len(part))).add(part)
    states = [whitening.Spectra(parts.count[i:i + 1], parts.mean[i:i + 1], parts.values[i:i + 1], parts.vectors[i:i + 1]).to_bytes()
              for i in range(4)]
    one = whitening.Spectra.from_bytes(states, 7).folded()
    assert one.count[0] == 101
    np.testing.assert_allclose(one.mean[0], x.mean(0), atol=1e-12)
    np.testing.assert_allclose(one.values[0], np.linalg.eigvalsh((x - x.mean(0)).T @ (x - x.mean(0))), rtol=1e-8)


def test_terms_of_a_document_are_two_byte_strings(spark):
    texts = ["b a b", "", None, "!!", "Ünïc 中文 ab1ab", "a" * 5000, " z"]
    rows = spark.createDataFrame([(i, t, "x", str(i)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    found = {int(r.source): (bytes(r.terms), np.frombuffer(r.counts, "<i4").tolist()) for r in source_audit.postings(rows.coalesce(1)).collect()}
    assert found == {
        0: (b"a b ", [1, 2]), 1: (b"", []), 2: (b"", []), 3: (b"", []), 4: ("ab Ünïc 中文 ".encode(), [2, 1, 1]),
        5: (b"a" * 5000 + b" ", [1]), 6: (b"z ", [1])}
