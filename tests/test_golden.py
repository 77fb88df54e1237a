"""Known numbers of the fixture data."""

import pytest
from pyspark.sql import functions as F

from paywatch.operators import evaluation as ev
from paywatch.operators import sampling, splits
from paywatch.operators.account_windows import outgoing_features
from paywatch.operators.cleaning import clean_transactions, rejected_transactions
from paywatch.operators.enrichment import enrich
from paywatch.sources import event_payments as source

FOLDERS = {"small": "/root/testdata/sf0.001", "medium": "/root/testdata/sf0.01"}
GOLDEN = {
    "small": dict(raw=1000, paid=20, to_account=7, clean=973, positives=8, accounts=141, entities=50, misses=(58, 70),
                  peaks=(3, 9, 30), similar=108, train=(679, 7), test=(294, 1), ap=0.264976, ks=0.976166, auc=0.986852,
                  youden=0.75, f2=0.76, confusion=(942, 23, 0, 8), budget=[(1, 1, 0), (2, 3, 0), (5, 5, 0), (10, 10, 0)]),
    "medium": dict(raw=10000, paid=229, to_account=94, clean=9677, positives=90, accounts=1411, entities=500, misses=(556, 555),
                   peaks=(3, 11, 31), similar=1125, train=(6483, 57), test=(3194, 33), ap=0.310234, ks=0.972150, auc=0.988017,
                   youden=0.75, f2=0.75, confusion=(9313, 274, 0, 90), budget=[(10, 11, 2), (19, 19, 6), (48, 49, 18), (97, 99, 34)]),
}


@pytest.fixture(scope="module", params=list(FOLDERS))
def case(request, spark):
    raw = source.raw_transactions(spark, FOLDERS[request.param])
    tx = clean_transactions(raw).cache()
    return GOLDEN[request.param], raw, tx, source.raw_accounts(spark, FOLDERS[request.param])


def test_cleaning(case):
    g, raw, tx, _ = case
    rejected = {r["reason"]: r["count"] for r in rejected_transactions(raw).groupBy("reason").count().collect()}
    assert (raw.count(), tx.count()) == (g["raw"], g["clean"])
    assert rejected["amount_paid"] >= g["paid"] and sum(rejected.values()) == g["raw"] - g["clean"]
    assert tx.agg(F.sum("is_laundering")).first()[0] == g["positives"]
    assert raw.filter("to_account is null").count() == g["to_account"]


def test_accounts(case):
    g, _, tx, accounts = case
    assert accounts.count() == g["accounts"] and accounts.select("entity_id").distinct().count() == g["entities"]
    out = enrich(tx, accounts)
    row = out.agg(F.count("*"), F.count_if(F.col("from_entity_id").isNull()), F.count_if(F.col("to_entity_id").isNull())).first()
    assert tuple(row) == (g["clean"], *g["misses"])


def test_windows(case):
    g, _, tx, _ = case
    row = outgoing_features(tx).agg(
        F.max("txn_count_1h_from"), F.max("txn_count_24h_from"), F.max("txn_count_7d_from"),
        F.count_if(F.col("num_similar_amount_txns_24h") > 0)).first()
    assert tuple(row) == (*g["peaks"], g["similar"])


def test_split(case):
    g, _, tx, _ = case
    for part, want in zip(splits.train_test(tx, 10, "ts"), (g["train"], g["test"])):
        assert tuple(part.agg(F.count("*"), F.sum("is_laundering")).first()) == want


def test_metrics(case):
    g, _, tx, _ = case
    scores = source.synthetic_scores(tx)
    row = ev.ranking_metrics(scores).first()
    assert [round(row[c], 6) for c in ("auc_pr", "ks", "roc_auc")] == [g["ap"], g["ks"], g["auc"]]
    assert ev.best_threshold(scores, "youden").first()["threshold"] == g["youden"]
    assert ev.best_threshold(scores, "f2").first()["threshold"] == g["f2"]
    assert tuple(ev.confusion_matrix(scores, 0.75).first()) == g["confusion"]
    budget = ev.alert_budget(scores).orderBy("rate").collect()
    assert [(r["k"], r["alerts"], r["tp"]) for r in budget] == g["budget"]


def test_hash_sample_size(spark):
    events = spark.read.parquet(f"{FOLDERS['medium']}/events.parquet").select(F.col("event_id").alias("tx_id"), F.lit(0).alias("is_laundering"))
    assert sampling.class_sample(events, {0: 0.08}).count() == 823
