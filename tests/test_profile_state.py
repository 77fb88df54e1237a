"""Merged daily states against the same figures of the rows."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paywatch.operators import preparation, profile_state, quality

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = []
    for i in range(3000):
        a = rng.gauss(1e6, 1)  # a large mean: squares would cancel
        data.append((i, datetime(2024, 1, 1) + timedelta(hours=i % 240), a, a * 2 + rng.gauss(0, 1), None if i % 5 == 0 else rng.random(), 4.0))
    return spark.createDataFrame(data, "tx_id long, event_timestamp timestamp_ntz, a double, b double, c double, d double").repartition(6)


@pytest.mark.parametrize("days", [(0, 10), (2, 3), (4, 9)])
def test_columns_of_any_range(rows, days):
    state = profile_state.column_state(rows, COLUMNS)
    inside = lambda df, c: df.where(f"{c} >= date'2024-01-01' + {days[0]} and {c} < date'2024-01-01' + {days[1]}")
    part = inside(rows, "to_date(event_timestamp)")
    found = {r["column"]: r for r in profile_state.merged_columns(inside(state, "day"), [0.5, 0.9]).collect()}
    for want in quality.numeric_stats(part, COLUMNS).collect():
        got = found[want["column"]]
        for name in ("avg", "std", "min", "max"):
            assert got[name] == pytest.approx(want[name], rel=1e-9, abs=1e-9)
        assert (got["rows"], got["n"]) == part.agg(F.count("*"), F.count(want["column"])).first()
        values = sorted(r[0] for r in part.select(want["column"]).dropna().collect())
        for i, share in enumerate((0.5, 0.9)):
            place = sum(v <= got[f"q{i}"] for v in values) / len(values)
            assert place >= share - 0.05 and (sum(v < got[f"q{i}"] for v in values) / len(values) <= share + 0.05)


def test_scales_and_correlations(rows):
    filled = rows.fillna(0.0, COLUMNS)
    state = profile_state.column_state(filled, COLUMNS)
    want = preparation.fit_standardization(filled, COLUMNS).scales
    got = profile_state.merged_scales(state).scales
    for c in "abc":
        assert got[c] == pytest.approx(want[c], rel=1e-9)
    pairs = profile_state.pair_state(filled, COLUMNS)
    assert pairs.count() == 10
    for part in (filled, filled.where("to_date(event_timestamp) < '2024-01-04'")):
        days = [r[0] for r in part.select(F.to_date("event_timestamp")).distinct().collect()]
        found = profile_state.merged_correlations(pairs.where(F.col("day").isin(days)), COLUMNS)
        want = {(r.column_a, r.column_b): r.abs_r for r in preparation.correlation_pairs(part, COLUMNS).collect()}
        for r in found.collect():
            other = want[r.column_a, r.column_b]
            assert r.abs_r is None and (other is None or math.isnan(other)) or r.abs_r == pytest.approx(other, abs=1e-9)


def test_states_do_not_copy_rows_per_column(rows):
    """Rows are grouped by day alone; columns become rows afterwards."""
    text = profile_state.column_state(rows, COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert text.index("Generate") < text.index("ObjectHashAggregate") and text.count("Generate") == 1


def test_a_column_without_values_and_rows_without_a_day(spark):
    rows = spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS event_timestamp, 1d AS a, CAST(NULL AS DOUBLE) AS b "
                     "UNION ALL SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)")
    found = {(str(r.day), r.column): (r.rows, r.n, r.mean, r.m2, r.low) for r in profile_state.column_state(rows, ["a", "b"]).collect()}
    assert found == {("None", "a"): (1, 1, 1.0, 0.0, 1.0), ("None", "b"): (1, 0, None, None, None),
                     ("2024-01-01", "a"): (1, 0, None, None, None), ("2024-01-01", "b"): (1, 0, None, None, None)}
