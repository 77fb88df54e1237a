import math

import pytest
from pyspark.sql import functions as F

from paywatch.columns import FROM_KEYS, TO_KEYS
from paywatch.operators.account_windows import incoming_features, outgoing_features
from paywatch.operators.hot_keys import HotKeys, find_hot_keys, find_hot_sides
from paywatch.plans.features import payment_features, transaction_features
from tests.helpers import payment, payments, rows_by_id, skewed_payments

COLD = HotKeys(tuple(FROM_KEYS)), HotKeys(tuple(TO_KEYS))
ALL_HOT = HotKeys(tuple(FROM_KEYS), everything=True), HotKeys(tuple(TO_KEYS), everything=True)


@pytest.fixture(params=["direct", "spread"])
def hot(request):
    return COLD if request.param == "direct" else ALL_HOT


def test_one_hour_bound_is_inclusive(spark, hot):
    tx = payments(spark, [payment(0, 0), payment(1, 60), payment(2, 121)])
    assert rows_by_id(outgoing_features(tx, hot[0]), "txn_count_1h_from") == {0: (1,), 1: (2,), 2: (1,)}


def test_same_minute_rows_are_peers_and_ties_follow_the_id(spark, hot):
    tx = payments(spark, [payment(5, 10, amount=1), payment(3, 10, amount=1), payment(4, 10, amount=2), payment(9, 9, amount=1)])
    got = rows_by_id(outgoing_features(tx, hot[0]), "txn_count_1h_from", "time_since_last_txn_from", "prev_amount_paid",
                     "num_similar_amount_txns_24h", "first_txn_of_day_from", "repeat_counterparty_count", "is_new_counterparty")
    assert got == {9: (1, None, None, 0, 1, 0, 1), 3: (4, 60, 1.0, 1, 0, 1, 0), 4: (4, 0, 1.0, 1, 0, 2, 0),
                   5: (4, 0, 2.0, 1, 0, 3, 0)}


def test_single_row_has_no_deviation_and_null_bank_is_a_group(spark, hot):
    tx = payments(spark, [payment(0, 0, from_bank=None), payment(1, 5, from_bank=None), payment(2, 6, to_bank=None)])
    got = rows_by_id(outgoing_features(tx, hot[0]), "txn_count_7d_from", "txn_amount_std_7d_from", "num_unique_banks",
                     "cross_bank_ratio_7d")
    assert got == {0: (1, None, 1, 0.0), 1: (2, 0.0, 1, 0.0), 2: (1, None, 0, 0.0)}


def test_incoming(spark, hot):
    tx = payments(spark, [payment(0, 0, 1), payment(1, 3, 2), payment(2, 3, 2), payment(3, 4, 1, 9)])
    got = rows_by_id(incoming_features(tx, hot[1]), "time_since_last_txn_to", "num_unique_senders")
    assert got == {0: (None, 2), 1: (180, 2), 2: (0, 2), 3: (None, 1)}


def test_frames_cross_week_edges(spark, hot):
    """Every minute gap up to two weeks, around the edges where the spread path cuts time."""
    day = 24 * 60
    minutes = [0, 1, 3 * day, 7 * day, 7 * day + 1, 8 * day, 14 * day, 14 * day + 1, 21 * day + 1, 30 * day]
    tx = payments(spark, [payment(i, m, amount=i + 1) for i, m in enumerate(minutes)])
    got = rows_by_id(outgoing_features(tx, hot[0]), "txn_count_7d_from", "max_txn_amount_7d_from", "txn_amount_sum_24h_from")
    for i, m in enumerate(minutes):
        week = [j for j, x in enumerate(minutes) if m - 7 * day <= x <= m]
        last_day = [j for j, x in enumerate(minutes) if m - day <= x <= m]
        assert got[i] == (len(week), max(week) + 1.0, float(sum(j + 1 for j in last_day)))


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7)
    return a == b


def test_hot_accounts_get_the_same_features(spark):
    tx = skewed_payments(spark).cache()
    direct = payment_features(tx, *COLD)
    some = find_hot_keys(tx, FROM_KEYS, min_rows=200), find_hot_keys(tx, TO_KEYS, min_rows=200)
    assert [h.frame.count() for h in some] == [1, 1]
    names = direct.columns
    expected = rows_by_id(direct, *names)
    assert len(expected) == tx.count()
    split = tuple(h.with_busy_minutes(tx, max_rows=2) for h in some)
    split_all = tuple(h.with_busy_minutes(tx, max_rows=1) for h in ALL_HOT)
    assert all(h.busy.count() > 5 for h in (*split, *split_all))
    for variant in (some, ALL_HOT, split, split_all):
        out = payment_features(tx, *variant)
        got = rows_by_id(out, *names)
        assert out.count() == len(expected)
        bad = [(i, n) for i, row in expected.items() for n, a, b in zip(names, row, got[i]) if not close(a, b)]
        assert not bad, bad[:5]


def test_hot_list_is_bounded(spark):
    tx = skewed_payments(spark)
    assert not find_hot_keys(tx, FROM_KEYS, min_rows=10**6)
    assert find_hot_keys(tx, FROM_KEYS, min_rows=1, max_keys=3).everything
    sides = find_hot_sides(tx, FROM_KEYS, TO_KEYS, min_rows=200, max_keys=5)
    assert [h.frame.count() for h in sides] == [1, 1]
    assert all(h.everything for h in find_hot_sides(tx, FROM_KEYS, TO_KEYS, min_rows=1, max_keys=3))
    mixed = find_hot_sides(tx, FROM_KEYS, TO_KEYS, min_rows=30, max_keys=2)
    assert all(h.everything or h.frame.count() <= 2 for h in mixed)


def test_past_features_ignore_later_rows(spark):
    """Removing the future changes only the lifetime counts."""
    tx = skewed_payments(spark, 800).cache()
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    leaky = {"num_unique_receivers", "num_unique_senders", "num_unique_banks"}
    names = [c for c in payment_features(tx, *COLD).columns if c not in leaky]
    whole = rows_by_id(payment_features(tx, *COLD).filter(F.col("event_timestamp") < cut), *names)
    past = rows_by_id(payment_features(tx.filter(F.col("ts") < cut), *COLD), *names)
    assert whole.keys() == past.keys()
    assert all(close(a, b) for i in past for a, b in zip(whole[i], past[i]))


def test_input_order_does_not_matter(spark):
    tx = skewed_payments(spark, 600).cache()
    names = payment_features(tx, *COLD).columns
    first = rows_by_id(payment_features(tx, *COLD), *names)
    again = rows_by_id(payment_features(tx.repartition(3, F.rand(1)).orderBy(F.rand(2)), *COLD), *names)
    assert all(close(a, b) for i in first for a, b in zip(first[i], again[i]))


def test_a_minute_of_copies_is_split(spark):
    """A third of the table is one payment repeated in one minute: its rows form many groups."""
    rows = [payment(i * 3, 500, 1, 2, 77.5, 1, 1) for i in range(400)]
    rows += [payment(i * 3 + 1, i, 1 + i % 7, 2 + i % 5, 1.0 + i % 3, 1, 1) for i in range(800)]
    tx = payments(spark, rows).repartition(4).cache()
    hot = tuple(h.with_busy_minutes(tx, max_rows=25) for h in find_hot_sides(tx, FROM_KEYS, TO_KEYS, min_rows=300))
    assert all(hot) and hot[0].busy.count() == 1
    sizes = hot[0].with_slot(tx).filter("_slot is not null").groupBy(*FROM_KEYS, "_slot").count()
    assert sizes.agg(F.max("count")).first()[0] <= 30
    names = payment_features(tx, *COLD).columns
    want, got = (rows_by_id(payment_features(tx, *h), *names) for h in (COLD, hot))
    bad = [(i, n) for i, row in want.items() for n, a, b in zip(names, row, got[i]) if not close(a, b)]
    assert len(got) == len(want) and not bad, bad[:5]


def test_hot_account_lookup(spark):
    """Listed accounts, with and without master data, find what the plain lookup finds."""
    tx = skewed_payments(spark, 1500).cache()
    rows = [(b, a, a // 3, f"E{a // 3}", f"B{b}") for a in range(2, 80) for b in (1, 2)]
    for extra in ([], [(1, 1, 500, "Hot", "B1")]):
        accounts = spark.createDataFrame(
            rows + extra, "bank_id bigint, account_number bigint, entity_id bigint, entity_name string, bank_name string")
        hot = find_hot_sides(tx, FROM_KEYS, TO_KEYS, min_rows=60)
        assert all(hot) and tx.filter("from_bank is null").count() > 0
        names = transaction_features(tx, accounts, *COLD).columns
        want, got = (rows_by_id(transaction_features(tx, accounts, *h), *names) for h in (COLD, hot))
        bad = [(i, n) for i, row in want.items() for n, a, b in zip(names, row, got[i]) if not close(a, b)]
        assert len(got) == len(want) == tx.count() and not bad, bad[:5]
