"""Early stopping, caps, ids of any type, time zones, folder names."""

import logging
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import build_features, train_and_score, validate
from paywatch import session, settings
from paywatch.columns import FROM_KEYS, STRICT_FEATURES, TO_KEYS
from paywatch.functions.arrays import count_not_above
from paywatch.operators import models, quantiles, splits
from paywatch.operators.cleaning import with_payment_ids
from paywatch.operators.enrichment import account_dimension
from paywatch.operators.hot_keys import HotKeys, find_hot_keys, find_hot_sides
from paywatch.operators.running_totals import running_totals
from paywatch.plans import training
from paywatch.plans.features import payment_features
from paywatch.session import clear_staged, new_path, shared_folder, stage
from paywatch.sources import event_payments as source, tables
from registry.queries import features
from tests.helpers import rows_by_id, skewed_payments

FOLDER = "/root/testdata/sf0.001"


def test_best_round_has_patience():
    falling = [1 / (i + 1) for i in range(100)]
    assert models.best_round(falling) == 100
    bump = [1.0, 0.5] + [0.6] * 29 + [0.4] + [0.7] * 40
    assert models.best_round(bump) == 32  # 29 rounds without improvement don't end it
    assert models.best_round([1.0, 0.5] + [0.6] * 30 + [0.4]) == 2
    assert models.best_round([1.0]) == 1 and settings.EARLY_STOPPING_ROUNDS == 30


@pytest.fixture(scope="module")
def prepared(spark):
    data = stage(features(spark, "/root/testdata/sf0.01"), "features")
    plan = models.fit_preparation(data, STRICT_FEATURES[:8])
    return stage(plan.apply(data), "ready"), plan.keep


def test_slow_rates_keep_their_trees(prepared, monkeypatch):
    ready, keep = prepared
    params = models.TreeParams(n_estimators=12, max_depth=2, learning_rate=0.02)
    model = models.fit_boosted_trees(ready, keep, params)
    assert model.stages[-1].getNumTrees == 12  # not cut before 30 rounds without improvement
    monkeypatch.setattr(models, "best_round", lambda losses: 3)
    assert models.fit_boosted_trees(ready, keep, params).stages[-1].getNumTrees == 3


def test_fold_edges_do_not_depend_on_the_process_zone(prepared, monkeypatch):
    ready, _ = prepared
    sizes = []
    for zone in ("UTC", "America/New_York"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        starts = splits.fold_start_literals(ready)
        sizes.append([ready.filter(F.col("event_timestamp") < s).count() for s in starts])
    monkeypatch.delenv("TZ")
    time.tzset()
    n = ready.count()
    assert sizes[0] == sizes[1] and abs(sizes[0][0] - n / 5) < n / 20


def test_no_caps_by_default(spark, monkeypatch):
    for name, value in (("NATURAL_TEST_MAX_ROWS", 10), ("MAX_TEST_ROWS", 10), ("BACKTEST_CAPS", {0: 1, 1: 1})):
        monkeypatch.setattr(settings, name, value)
    data = stage(features(spark, FOLDER), "features")
    config = training.TrainingConfig(test_days=10, target_rate=0.02, train_fractions={0: 1.0, 1: 1.0})
    assert config.natural_max_rows is config.test_caps is config.backtest_caps is None
    rows = splits.train_test(data, 10)[1]
    neg, pos = rows.filter("is_laundering = 0").count(), rows.filter("is_laundering = 1").count()
    _, test = training.train_and_test(data, config)
    want = (neg, round(neg * 0.02 / 0.98)) if pos / (neg + pos) > 0.02 else (round(pos * 0.98 / 0.02), pos)
    assert abs(test.filter("is_laundering = 0").count() - min(neg, want[0])) <= 2
    windows = splits.backtest_windows(data, (7,), {0: 1.0, 1: 1.0})
    assert windows.count() == splits.trailing_windows(data, (7,)).count() > 10


def test_ids_of_any_case_and_type(spark):
    raw = source.raw_transactions(spark, FOLDER).withColumn("TX_ID", F.concat(F.lit("A-"), "tx_id"))
    assert with_payment_ids(raw).agg(F.min("tx_id")).first()[0].startswith("A-")

    numbers = skewed_payments(spark, 900).cache()
    texts = numbers.withColumn("tx_id", F.concat(F.lit("p"), F.lpad(F.col("tx_id").cast("string"), 9, "0")))
    hot = [h.with_busy_minutes(texts, max_rows=2) for h in find_hot_sides(texts, FROM_KEYS, TO_KEYS, min_rows=60)]
    assert all(hot) and all(h.busy is not None for h in hot)
    plain = payment_features(numbers, HotKeys(tuple(FROM_KEYS)), HotKeys(tuple(TO_KEYS)))
    names = ["txn_count_7d_from", "repeat_counterparty_count", "num_unique_senders", "time_since_last_txn_to"]
    want = {f"p{i:09d}": v for i, v in rows_by_id(plain, *names).items()}
    assert rows_by_id(payment_features(texts, *hot), *names) == want


def test_made_up_ids_split_a_busy_minute(spark):
    tx = skewed_payments(spark, 10).limit(1).drop("tx_id").crossJoin(spark.range(4000)).drop("id")
    tx = with_payment_ids(tx.withColumn("from_account", F.lit(1).cast("bigint")).repartition(2))
    assert tx.agg(F.max("tx_id")).first()[0] > 2**33
    hot = find_hot_keys(tx, FROM_KEYS, min_rows=100).with_busy_minutes(tx, max_rows=200)
    sizes = [r["count"] for r in hot.with_slot(tx).groupBy("_slot").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 2 * 200 and len(sizes) >= 10


def test_many_busy_minutes_are_all_split(spark):
    tx = skewed_payments(spark, 2000).cache()
    hot = find_hot_keys(tx, FROM_KEYS, min_rows=200)
    short, long = (hot.with_busy_minutes(tx, max_rows=1, max_minutes=m) for m in (10**6, 2))
    assert short.short and not long.short and short.busy.count() == long.busy.count() > 2
    names = ["txn_count_7d_from", "repeat_counterparty_count"]
    cold = HotKeys(tuple(TO_KEYS))
    assert rows_by_id(payment_features(tx, short, cold), *names) == rows_by_id(payment_features(tx, long, cold), *names)


def test_unknown_entities_keep_out_of_the_join(spark):
    rows = [(1, 1, None, None, "B"), (1, 2, 7, "E", "B"), (1, 3, 7, "E", "B")]
    dim = account_dimension(spark.createDataFrame(
        rows, "bank_id int, account_number int, entity_id int, entity_name string, bank_name string"))
    assert {r.account_number: r.num_accounts_per_entity for r in dim.collect()} == {1: None, 2: 2, 3: 2}


def test_count_not_above(spark):
    df = spark.createDataFrame([([1, 3, 3, 7], v) for v in range(9)] + [([], 4), ([5], 5)], "a array<int>, v int")
    for r in df.withColumn("n", count_not_above(F.col("a"), F.col("v"))).collect():
        assert r.n == sum(x <= r.v for x in r.a)


def test_running_totals_edges_follow_each_group(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * F.pow(F.lit(1000.0), F.col("id") % 3)).alias("x"), F.lit(1).alias("one"))
    out = running_totals(df, "x", ["one"], by=["g"], buckets=10)
    assert out.agg(F.max("cum_one"), F.min("total_one")).first()[:] == (1000, 1000)
    assert out.groupBy("g").agg(F.count_distinct("cum_one").alias("n")).filter("n = 1000").count() == 3


def test_missed_brackets_are_widened(spark, monkeypatch):
    df = spark.range(1001).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).alias("b"), F.lit(None).cast("double").alias("c"))
    real, seen = quantiles._bracketed, []

    def shifted(numbers, columns, shares, margin, accuracy):
        seen.append(margin)
        return real(numbers, columns, [s + 0.1 for s in shares] if len(seen) == 1 else shares, margin, accuracy)

    monkeypatch.setattr(quantiles, "_bracketed", shifted)
    got = {(r["column"], r["share"]): r["value"] for r in quantiles.exact_quantiles(df, ["a", "b", "c"], [0.5, 0.9]).collect()}
    assert len(seen) > 1 and got["a", 0.5] == 500 and got["a", 0.9] == 900 and got["b", 0.5] == 3 and got["c", 0.5] is None


def test_jobs_with_folder_names(spark, capsys, caplog):
    paths = {n: new_path(spark, n) for n in ("raw", "accounts", "features", "report", "dist", "runs", "predictions")}
    source.raw_transactions(spark, "/root/testdata/sf0.01").write.parquet(paths["raw"])
    source.raw_accounts(spark, "/root/testdata/sf0.01").write.parquet(paths["accounts"])
    build_features.main(spark, paths["raw"], paths["accounts"], paths["features"], "1")
    table = tables.read_table(spark, paths["features"])
    assert "event_date" in table.columns and table.count() > 5000
    assert validate.main(spark, paths["features"], paths["report"], paths["dist"]).count() == 1
    # One column is absent: the run warns, searches and trains.
    lacking = new_path(spark, "lacking")
    table.drop("txn_count_1h_from").write.partitionBy("event_date").parquet(lacking)
    config = training.TrainingConfig(
        strict_columns=False, train_fractions={0: 0.2, 1: 1.0}, target_rate=0.02, backtest_days=(7, 14), forest_trees=2,
        logistic_iterations=5, params=models.TreeParams(n_estimators=2, max_depth=2))
    monkey = models.random_trials
    models.random_trials = lambda n, seed: monkey(n, seed, {**models.SEARCH_RANGES, "n_estimators": (2, 3, "int"), "max_depth": (2, 2, "int")})
    try:
        with caplog.at_level(logging.WARNING):
            result = train_and_score.main(spark, lacking, paths["runs"], paths["predictions"], "10", "1", config)
    finally:
        models.random_trials = monkey
    assert "txn_count_1h_from" in caplog.text and "txn_count_1h_from" not in result.preparation.keep
    assert {"checks", "repeated_keys", "train_profile", "test_profile"} <= set(result.reports)
    assert tables.read_table(spark, paths["runs"]).count() == 1
    assert tables.read_table(spark, paths["predictions"]).count() == result.scored.count()


def test_folder_append_keeps_new_columns(spark):
    folder = new_path(spark, "appended")
    tables.append_table(spark.createDataFrame([(1,)], "a int"), folder)
    tables.append_table(spark.createDataFrame([(2, "x")], "A long, b string"), folder)
    out = spark.read.option("mergeSchema", True).parquet(folder)
    assert sorted(map(tuple, out.select("a", "b").collect())) == [(1, None), (2, "x")]


def test_clear_staged(spark, monkeypatch):
    moved = Path(shared_folder(spark)) / "elsewhere"
    monkeypatch.setattr(session, "shared_folder", lambda _: str(moved))
    stage(spark.range(3), "cleared")
    assert any(moved.rglob("*.parquet"))
    clear_staged(spark)
    assert not any(moved.rglob("*.parquet"))
