import pytest
from pyspark.sql import functions as F

from paywatch.columns import LEAKY_FEATURES
from paywatch.operators import evaluation, models
from paywatch.plans.training import TrainingConfig, train_and_evaluate
from paywatch.plans.validation import validate_table
from paywatch.session import stage
from paywatch.sources import runs, tables
from registry.queries import features


@pytest.fixture(scope="module")
def table(spark):
    return stage(features(spark, "/root/testdata/sf0.01"), "features")


CONFIG = TrainingConfig(
    test_days=10, train_fractions={0: 0.3, 1: 1.0}, target_rate=0.02, backtest_days=(7, 14),
    backtest_fractions={0: 0.3, 1: 1.0}, params=models.TreeParams(n_estimators=4, max_depth=3),
    forest_trees=6, logistic_iterations=30)


@pytest.fixture(scope="module")
def result(spark, table):
    spark.sql("DROP TABLE IF EXISTS run_log")
    spark.sql("DROP TABLE IF EXISTS predicted")
    return train_and_evaluate(table, CONFIG, runs_table="run_log", predictions_table="predicted")


def test_models_beat_chance(result):
    found = {r["model"]: r for r in result.benchmark.collect()}
    assert set(found) == {"boosted_trees", "random_forest", "logistic"}
    for row in found.values():
        assert 0 <= row["auc_pr"] <= 1 and 0 <= row["ks"] <= 1 and row["roc_auc"] > 0.6


def test_leaky_features_stay_out(result):
    assert not set(LEAKY_FEATURES) & set(result.preparation.keep)
    assert "txn_velocity_7d_from" not in result.preparation.keep


def test_run_and_predictions_are_written(spark, result):
    row = spark.table("run_log").first()
    assert row["run_id"] == result.run_id and row["n_test"] == result.scored.count() and row["n_train"] > 0
    found = spark.table("predicted")
    assert found.count() == row["n_test"]
    assert found.filter((F.col("fraud_probability") < 0) | (F.col("fraud_probability") > 1)).count() == 0


def test_saved_model_scores_the_same(spark, result):
    path = spark.table("run_log").first()["model_path"]
    base = result.scored.drop("score")
    again = models.score(models.load_model(path), base)
    joined = again.select("tx_id", F.col("score").alias("s")).join(result.scored.select("tx_id", "score"), "tx_id")
    assert joined.filter(F.abs(F.col("s") - F.col("score")) > 1e-12).count() == 0


def test_views(result):
    for name, view in result.reports.items():
        assert view.count() > 0, name
    stress = result.reports["stress"].first()
    assert stress["delta"] == pytest.approx(stress["auc_pr_stressed"] - stress["auc_pr_base"])


def test_capped_stratified_test_set(table):
    from paywatch.plans.training import model_input, train_and_test
    config = TrainingConfig(test_days=10, natural_test_rate=False, test_caps={0: 200, 1: 10}, exclude_leaky=False)
    _, test = train_and_test(model_input(table, config), config)
    assert test.count() <= 210 and set(LEAKY_FEATURES) <= set(test.columns)


def test_search_orders_trials(table):
    trials = [models.TreeParams(n_estimators=1, max_depth=1), models.TreeParams(n_estimators=4, max_depth=4)]
    found = models.search(table, ["amount_paid", "hour_of_day"], trials, folds=2)
    assert len(found) == 2 and found[0][1] >= found[1][1] and {p for p, _ in found} == set(trials)
    assert models.random_trials(3) == models.random_trials(3) != models.random_trials(3, seed=1)


def test_validation_tables(spark, table):
    tables.overwrite_features(table, "feature_table", files_per_day=2)
    report = validate_table(spark, "feature_table", "report_table", "distribution_table").first()
    assert report["row_count"] == table.count() and report["feature_table"] == "feature_table"
    assert spark.table("distribution_table").count() == 32 * 7
    assert "event_date" in spark.table("feature_table").columns


def test_older_prediction_table_gains_run_columns(spark, result):
    spark.sql("DROP TABLE IF EXISTS old_predicted")
    out = runs.predictions(result.scored, "r", "m")
    tables.append_table(out.drop("run_id", "model_version"), "old_predicted")
    runs.write_predictions(out, "old_predicted")
    assert spark.table("old_predicted").filter("run_id = 'r'").count() == out.count()


def test_reports_of_plain_scores(spark):
    scores = spark.createDataFrame([(i, i % 2, i / 10) for i in range(10)], "tx_id bigint, label int, score double")
    assert [r["tx_id"] for r in evaluation.top_k_rows(scores, 3).collect()] == [9, 8, 7]
