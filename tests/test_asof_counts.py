"""Distinct counts without the future, on the plain and the spread path, against a plain version."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from paywatch.columns import FROM_KEYS
from paywatch.operators.asof_counts import distinct_asof
from paywatch.operators.hot_keys import HotKeys, find_hot_keys


def payments(n=900):
    rng = random.Random(6)
    out = []
    for i in range(n):
        hot = i % 3 == 0
        bank, account = (1, 7) if hot else (rng.choice([1, 2, None]), rng.randrange(12))
        minute = 5 if hot and rng.random() < 0.5 else rng.randrange(60)  # half of the hot account's payments share a minute
        out.append((i, datetime(2024, 1, 1) + timedelta(minutes=minute), bank, account, rng.choice([None, *range(40)])))
    return out


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(payments(), "tx_id long, ts timestamp_ntz, from_bank int, from_account int, to_account int").repartition(4)


def wanted():
    seen, out = {}, {}
    for i, ts, bank, account, to in sorted(payments(), key=lambda r: (r[1], r[0])):
        mine = seen.setdefault((bank, account), set())
        if to is not None:
            mine.add(to)
        out[i] = len(mine)
    return out


@pytest.mark.parametrize("path", ["plain", "spread", "busy minutes", "everything"])
def test_paths_agree(tx, path):
    hot = HotKeys(tuple(FROM_KEYS))
    if path != "plain":
        hot = find_hot_keys(tx, FROM_KEYS, min_rows=100)
        assert hot
    if path == "everything":
        hot = replace(hot, frame=None, everything=True)
    if path == "busy minutes":
        hot = hot.with_busy_minutes(tx, max_rows=20)
        assert hot.busy is not None
    out = distinct_asof(tx, FROM_KEYS, "to_account", "n", hot)
    assert out.columns == [*tx.columns, "n"]
    assert {r.tx_id: r.n for r in out.collect()} == wanted()
