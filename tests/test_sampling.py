from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from paywatch.operators import sampling, splits
from paywatch.operators.dedup import dedupe_keys
from tests.helpers import START, payment, payments, skewed_payments


@pytest.fixture(scope="module")
def tx(spark):
    return skewed_payments(spark, 4000).withColumnRenamed("ts", "event_timestamp").cache()


def ids(df):
    return sorted(r["tx_id"] for r in df.select("tx_id").collect())


def classes(df):
    return {r[0]: r[1] for r in df.groupBy("is_laundering").count().collect()}


def test_exact_sizes(tx):
    have = classes(tx)
    assert classes(sampling.class_cap(tx, {0: 100, 1: 7})) == {0: 100, 1: 7}
    assert classes(sampling.class_cap(tx, {0: 10**9, 1: 0})) == {0: have[0]}
    assert classes(sampling.class_cap(tx, {0: None, 1: have[1]})) == have
    assert classes(sampling.class_cap(tx, {1: 1})) == {1: 1}


def test_samples_do_not_depend_on_partitioning_and_nest(tx):
    small, large = sampling.class_cap(tx, {0: 50}), sampling.class_cap(tx.repartition(7), {0: 500})
    assert set(ids(small)) < set(ids(large))
    assert ids(small) == ids(sampling.class_cap(tx.repartition(3), {0: 50}))
    assert ids(small) != ids(sampling.class_cap(tx, {0: 50}, seed=1))


def test_fraction(tx):
    have = classes(tx)
    got = classes(sampling.class_sample(tx, {0: 0.25, 1: 1.0}))
    assert got[1] == have[1] and abs(got[0] / have[0] - 0.25) < 0.04


@pytest.mark.parametrize("rate", [0.01, 0.05, 0.2])
def test_rate_enforcement(tx, rate):
    neg, pos = (classes(tx)[c] for c in (0, 1))
    got = classes(sampling.enforce_positive_rate(tx, rate))
    if pos / (neg + pos) > rate:
        assert got == {0: neg, 1: min(round(neg * rate / (1 - rate)), pos)}
    else:
        assert got == {0: min(round(pos * (1 - rate) / rate), neg), 1: pos}


def test_rate_is_left_alone_with_one_class(tx):
    negatives = tx.filter("is_laundering = 0")
    assert sampling.enforce_positive_rate(negatives, 0.01).count() == negatives.count()


def test_natural_rate_sample(tx):
    got = sampling.natural_rate_sample(tx, max_rows=500, rate=0.02)
    counts = classes(got)
    assert 480 <= counts[0] <= 490 and counts[1] == min(10, round(counts[0] * 0.02 / 0.98))
    keys = ["from_bank", "from_account", "to_bank", "to_account", "event_timestamp"]
    assert got.select(*keys).distinct().count() == got.count()


def test_dedupe_keeps_lowest_id_and_groups_nulls(spark):
    rows = [payment(i, 0, to_bank=None, amount=i) for i in range(50, 0, -1)] + [payment(99, 1)]
    df = payments(spark, rows).withColumnRenamed("ts", "event_timestamp")
    out = dedupe_keys(df)
    assert ids(out) == [1, 99] and out.columns == df.columns


def test_split_is_complete(tx):
    train, test = splits.train_test(tx, 10)
    assert sorted(ids(train) + ids(test)) == ids(tx)
    latest = tx.agg(F.max("event_timestamp")).first()[0]
    assert test.agg(F.min("event_timestamp")).first()[0] >= latest - timedelta(days=10)
    assert train.agg(F.max("event_timestamp")).first()[0] < latest - timedelta(days=10)
    assert {r[0] for r in splits.with_split(tx, 10).select("split").distinct().collect()} == {"train", "test"}


def test_backtest_caps_hold_per_window(tx):
    got = splits.backtest_windows(tx, (3, 7, 14), {0: 0.9, 1: 1.0}, {0: 60, 1: 5})
    sizes = {(r["window_days"], r["is_laundering"]): r["count"]
             for r in got.groupBy("window_days", "is_laundering").count().collect()}
    assert len(sizes) == 6 and all(n <= (5 if c else 60) for (_, c), n in sizes.items())


def test_folds_expand(spark):
    df = payments(spark, [payment(i, i) for i in range(103)]).withColumnRenamed("ts", "event_timestamp")
    out = splits.time_series_folds(df, 4).groupBy("fold", "role").agg(
        F.count("*").alias("n"), F.min("tx_id").alias("a"), F.max("tx_id").alias("b")).collect()
    got = {(r["fold"], r["role"]): (r["n"], r["a"], r["b"]) for r in out}
    assert got == {
        (1, "train"): (23, 0, 22), (1, "validate"): (20, 23, 42), (2, "train"): (43, 0, 42), (2, "validate"): (20, 43, 62),
        (3, "train"): (63, 0, 62), (3, "validate"): (20, 63, 82), (4, "train"): (83, 0, 82), (4, "validate"): (20, 83, 102)}


def test_one_minute_stays_in_one_fold(spark):
    df = payments(spark, [payment(i, min(i, 10)) for i in range(60)]).withColumnRenamed("ts", "event_timestamp")
    out = splits.time_series_folds(df, 4).filter(F.col("event_timestamp") == F.lit(START + timedelta(minutes=10)))
    assert out.groupBy("fold").agg(F.count_distinct("role").alias("n")).filter("n > 1").count() == 0
