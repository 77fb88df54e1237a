import math
import re

import numpy as np
import pytest
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from paywatch.columns import LEAKY_FEATURES, TS, missing_columns, require_columns, select_present
from paywatch.operators import preparation as prep
from paywatch.operators import quality
from paywatch.operators.splits import holdout_cutoff, train_test, with_split
from paywatch.session import stage


@pytest.fixture(scope="module")
def frames(spark):
    train = spark.createDataFrame(
        [(1, 1.0, None, 5.0, None), (2, 3.0, 10.0, 5.0, None), (3, 4.0, 20.0, 5.0, None), (4, 10.0, 40.0, 5.0, None)],
        "tx_id bigint, a double, b double, c double, d double")
    test = spark.createDataFrame([(9, None, None, None, 7.0)], train.schema)
    return train, test


def test_imputation(frames, spark):
    train, test = frames
    plan = prep.fit_imputation(train, ["a", "b", "c", "d"])
    assert plan.medians == {"a": 3.5, "b": 20.0, "c": 5.0, "d": 0.0} and plan.indicators == ("b", "d")
    row = plan.apply(test).first()
    assert (row["a"], row["b"], row["c"], row["d"]) == (3.5, 20.0, 5.0, 7.0)
    assert (row["b_is_missing"], row["d_is_missing"]) == (1, 0)
    assert "d_is_missing" not in plan.apply(test, ["b_is_missing"]).columns
    assert prep.Imputation.from_table(plan.as_table(spark)) == plan


def test_correlation_filter_counts_dropped_columns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    y = x + rng.normal(size=300) * 0.2   # close to x
    z = y + rng.normal(size=300) * 0.2   # close to y, less so to x
    w = rng.normal(size=300)
    rows = [tuple(map(float, r)) + (1.0,) for r in zip(x, y, z, w)]
    df = spark.createDataFrame(rows, "x double, y double, z double, w double, k double")
    r = np.abs(np.corrcoef([x, y, z]))
    limit = (r[0, 2] + min(r[0, 1], r[1, 2])) / 2
    assert prep.uncorrelated(df, list("xyzwk"), limit) == ["x", "w", "k"]
    pairs = {(p["column_a"], p["column_b"]): p["abs_r"] for p in prep.correlation_pairs(df, list("xyzwk")).collect()}
    assert math.isclose(pairs["x", "y"], r[0, 1], rel_tol=1e-9) and pairs["x", "k"] is None


def test_standardization(frames):
    train, _ = frames
    out = prep.fit_standardization(train, ["a", "c"]).apply(train).toPandas()
    assert abs(out["a"].mean()) < 1e-12 and math.isclose(out["a"].std(ddof=0), 1.0) and set(out["c"]) == {0.0}


def test_required_columns(frames):
    train, _ = frames
    assert missing_columns(train, ["a", "zz"]) == ["zz"]
    assert require_columns(train, ["A", "zz"], strict=False) == ["zz"]
    with pytest.raises(ValueError, match="zz"):
        require_columns(train, ["a", "zz"])
    assert select_present(train, ["c", "zz", "a"]).columns == ["c", "a"]


def test_trainable_guard(spark):
    rows = [("train", 0), ("train", 1), ("test", 0), ("test", 1)]
    schema = "split string, is_laundering int"
    quality.require_trainable(quality.sample_checks(spark.createDataFrame(rows, schema)))
    for broken, message in ((rows[:2], "no rows"), (rows[:3], "one class"), (rows + [("test", None)], "null labels")):
        with pytest.raises(ValueError, match=message):
            quality.require_trainable(quality.sample_checks(spark.createDataFrame(broken, schema)))


def test_quality_on_empty_table(spark):
    empty = spark.createDataFrame([], "from_bank int, is_laundering int")
    row = quality.label_summary(empty).first()
    assert (row["row_count"], row["fraud_count"], row["fraud_rate"]) == (0, None, None)
    assert quality.duplicate_keys(empty, ["from_bank"]).first()[0] == 0


def test_moments_are_merged_from_tasks(spark):
    df = spark.range(5000).repartition(7).select(
        (F.col("id") * 1.5 + 1e6).alias("a"), F.pmod(F.xxhash64("id"), F.lit(97)).cast("int").alias("b"), F.lit(123456789.123).alias("same"),
        (F.col("id") * F.col("id")).alias("c"))
    found = prep.moments(df, ["a", "b", "same", "c"])
    want = abs(Correlation.corr(prep.assemble(df, ["a", "b", "same", "c"], "_v"), "_v").first()[0].toArray())
    np.testing.assert_allclose(found.correlations(), want, atol=1e-9)
    assert np.isnan(found.correlations()[2, 0]) and found.scales(["same"]) == {"same": (123456789.123, 0.0)}
    assert found.scales(["a", "c"])["c"] == pytest.approx(prep.fit_standardization(df, ["c"]).scales["c"])
    with pytest.raises(Exception, match="null"):
        prep.moments(df.withColumn("b", F.when(F.col("b") > 3, F.col("b"))), ["a", "b"])


def test_prepared_features_leave_out_windows_of_leaky_columns(spark):
    from registry.queries import _prepared

    train, test, _ = _prepared(spark, "/root/testdata/sf0.001")
    assert not {*LEAKY_FEATURES} & {*train.columns, *test.columns}


def test_staged_tables_are_read_in_more_tasks_than_cores(spark):
    rows = spark.range(4_000_000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c")).coalesce(2)
    read = stage(rows, "wide").select("a").mapInArrow(lambda batches: (b for b in batches if b.num_rows), "a double")
    tasks = read.groupBy(F.spark_partition_id()).count().count()
    assert tasks > 2


def test_stage_restores_the_session(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    stage(spark.range(10).repartition("id"), "few", "1m")
    assert spark.conf.get(key) == before


def test_train_and_test_rows_are_read_from_their_own_folders(spark):
    from registry.queries import _newton, _prepared

    found = [_prepared(spark, "/root/testdata/sf0.001")[:2], [None, _newton(spark, "/root/testdata/sf0.001")[1]]]
    for train, test in found:
        for part, rows in (("train", train), ("test", test)):
            if rows is not None:
                text = rows._jdf.queryExecution().executedPlan().toString()
                assert re.search(rf"PartitionFilters: \[[^\]]*split#\d+ = {part}\)", text)
                assert {r.count("/split=") for r in rows.inputFiles()} == {1}
    train, test = found[0]
    assert train.agg(F.max(TS)).first()[0] < test.agg(F.min(TS)).first()[0]
    assert not train.isEmpty() and test.count() == found[1][1].count()


def test_rows_without_time_are_in_neither_part(spark):
    rows = spark.sql("""SELECT id, CASE WHEN id % 5 > 0 THEN timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id AS INT)) END AS at
        FROM range(30)""")
    cutoff = holdout_cutoff(rows, 10, "at")
    staged = stage(with_split(rows, 10, "at", cutoff), "parts", folders="split")
    want = train_test(rows, 10, "at")
    for part, plain in zip(("train", "test"), want):
        assert sorted(r.id for r in staged.where(F.col("split") == part).collect()) == sorted(r.id for r in plain.collect())
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
