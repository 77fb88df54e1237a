"""Train on the past, evaluate on the holdout, backtest, log the run and write predictions."""

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.columns import (
    EVENT_DATE, KEYS, LABEL, LEAKY_FEATURES, MODEL_FEATURES, TS, has_column, require_columns, select_present,
)
from paywatch.operators import evaluation, models, sampling, splits
from paywatch.operators.dedup import dedupe_keys
from paywatch.operators.quality import require_trainable, sample_checks, sample_profile
from paywatch.session import shared_folder, stage
from paywatch.sources import runs


@dataclass(frozen=True)
class TrainingConfig:
    test_days: int = settings.TEST_DAYS
    seed: int = settings.SEED
    exclude_leaky: bool = True
    strict_columns: bool = True
    train_fractions: dict = field(default_factory=lambda: dict(settings.TRAIN_FRACTIONS))
    # Caps are off by default, here and below: all steps are distributed and need none.
    train_caps: dict | None = None
    natural_test_rate: bool = True
    target_rate: float = settings.TARGET_TEST_RATE
    natural_max_rows: int | None = None
    test_fractions: dict = field(default_factory=lambda: dict(settings.TEST_FRACTIONS))
    test_caps: dict | None = None
    backtest_days: tuple = settings.BACKTEST_DAYS
    backtest_fractions: dict = field(default_factory=lambda: dict(settings.BACKTEST_FRACTIONS))
    backtest_caps: dict | None = None
    params: models.TreeParams = models.TreeParams()
    trials: int = 0
    forest_trees: int = 400
    logistic_iterations: int = 500

    @property
    def features(self):
        left_out = LEAKY_FEATURES if self.exclude_leaky else []
        return [c for c in MODEL_FEATURES if c not in left_out]


@dataclass(frozen=True)
class TrainingResult:
    models: dict
    preparation: models.Preparation
    params: models.TreeParams
    scores: DataFrame
    scored: DataFrame
    benchmark: DataFrame
    reports: dict
    run: DataFrame
    version: str
    run_id: str


def model_input(features: DataFrame, config: TrainingConfig) -> DataFrame:
    """Ids, label and the wanted features of rows that have a time."""
    absent = require_columns(features, config.features, config.strict_columns)
    wanted = ["tx_id", *KEYS, LABEL, EVENT_DATE, *[c for c in config.features if c not in absent]]
    return select_present(features, wanted).filter(F.col(TS).isNotNull())


def train_and_test(data: DataFrame, config: TrainingConfig):
    """Sampled, de-duplicated train and test sets, each written once."""
    train, test = splits.train_test(data, config.test_days)
    train = sampling.stratified_sample(train, config.train_fractions, config.train_caps, seed=config.seed)
    train = stage(dedupe_keys(train), "train")
    if config.natural_test_rate:
        test = sampling.natural_rate_sample(test, config.natural_max_rows, config.target_rate, seed=config.seed)
    else:
        test = dedupe_keys(sampling.stratified_sample(test, config.test_fractions, config.test_caps, seed=config.seed))
    return train, stage(test, "test")


def pre_training_reports(train: DataFrame, test: DataFrame, features) -> dict:
    """Checks per split, null rates, repeated keys per split and a profile of the features; one row per split or
    column each, written once."""
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    repeated = both.groupBy("split", *KEYS).agg(F.count("*").alias("n")).groupBy("split").agg(
        F.count_if(F.col("n") > 1).alias("repeated_keys"), F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("extra_rows"))
    return {
        "checks": stage(sample_checks(both), "checks"),
        "repeated_keys": stage(repeated, "repeated_keys"),
        "train_profile": stage(sample_profile(train, features), "train_profile"),
        "test_profile": stage(sample_profile(test, features), "test_profile"),
    }


def reports(scores: DataFrame) -> dict:
    """Every operating view of one model's scores."""
    youden = evaluation.best_threshold(scores, "youden").first()["threshold"]
    return {
        "confusion_at_half": evaluation.confusion_matrix(scores, 0.5),
        "classification_at_half": evaluation.classification_report(scores, 0.5),
        "best_youden": evaluation.best_threshold(scores, "youden"),
        "best_f2": evaluation.best_threshold(scores, "f2"),
        "confusion_at_youden": evaluation.confusion_matrix(scores, youden),
        "classification_at_youden": evaluation.classification_report(scores, youden),
        "alert_budget": evaluation.alert_budget(scores),
        "operating_point": evaluation.alert_budget(scores, [settings.DEFAULT_ALERT_RATE]),
        "top_k_shares": evaluation.top_k_shares(scores),
        "top_k_counts": evaluation.top_k_counts(scores),
        "investigation_capacity": evaluation.investigation_capacity(scores),
    }


def train_and_evaluate(features: DataFrame, config=TrainingConfig(), model_folder=None, runs_table=None,
                       predictions_table=None) -> TrainingResult:
    spark = features.sparkSession
    data = model_input(features, config)
    train, test = train_and_test(data, config)
    wanted = [c for c in config.features if has_column(train, c)]
    checks = pre_training_reports(train, test, wanted)
    require_trainable(checks["checks"])

    prepared = models.fit_preparation(train, wanted)
    keep = prepared.keep
    ready, ready_test = stage(prepared.apply(train), "train_ready"), stage(prepared.apply(test), "test_ready")
    params = config.params
    if config.trials:
        best, mean = models.search(train, wanted, models.random_trials(config.trials, config.seed))[0]
        params = params if mean is None else best  # no fold could be scored

    fitted = {
        "boosted_trees": models.fit_boosted_trees(ready, keep, params, seed=config.seed),
        "random_forest": models.fit_forest(ready, keep, config.forest_trees, seed=config.seed),
        "logistic": models.fit_logistic(prepared.scales.apply(ready), keep, config.logistic_iterations),
    }
    scored = stage(models.score(fitted["boosted_trees"], ready_test), "scored")
    per_model = {
        "boosted_trees": models.as_scores(scored),
        "random_forest": models.as_scores(models.score(fitted["random_forest"], ready_test)),
        "logistic": models.as_scores(models.score(fitted["logistic"], prepared.scales.apply(ready_test))),
    }
    named = [s.withColumn("model", F.lit(name)) for name, s in per_model.items()]
    all_scores = stage(named[0].unionByName(named[1]).unionByName(named[2]), "scores")
    scores = per_model["boosted_trees"]

    windows = splits.backtest_windows(data, config.backtest_days, config.backtest_fractions, config.backtest_caps,
                                      seed=config.seed)
    backtest = models.score(fitted["boosted_trees"], prepared.apply(windows))
    backtest = stage(evaluation.backtest_metrics(
        backtest.select("window_days", "tx_id", F.col(LABEL).alias("label"), "score")), "backtest")
    views = {
        **checks,
        **reports(scores),
        "backtest": backtest,
        "stability": evaluation.stability_trend(backtest),
        "importance": models.feature_importance(fitted["boosted_trees"], keep, spark),
        "stress": models.stress_test(fitted["boosted_trees"], ready_test, prepared),
    }

    run_id = runs.new_run_id()
    version = runs.model_version(run_id)
    folder = model_folder or f"{shared_folder(spark)}/paywatch/models"
    path = models.save_model(fitted["boosted_trees"], folder, version)
    models.save_model(models.scorer(prepared, fitted["boosted_trees"]), folder, f"{version}-scorer")  # from raw features
    prepared.imputation.as_table(spark).write.mode("overwrite").parquet(f"{path}-imputation")
    summary = evaluation.run_summary(train, scores, splits.holdout_cutoff(data, config.test_days))
    run = runs.run_row(summary, run_id, version, asdict(params), keep, path)
    if runs_table:
        runs.write_once(run, runs_table)
    if predictions_table:
        runs.write_once(runs.predictions(scored, run_id, version), predictions_table)
    return TrainingResult(fitted, prepared, params, all_scores, scored,
                          evaluation.ranking_metrics(all_scores, ["model"]), views, run, version, run_id)
