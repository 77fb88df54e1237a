"""Queries that fit a model fit the whole one: all rounds and iterations of the defaults, unless the fit itself ends before."""

import datetime
import random
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from paywatch.operators import models
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of 600 events of 30 days and 40 customers."""
    path, draw = str(tmp_path_factory.mktemp("tables")), random.Random(5)
    start = datetime.datetime(2024, 1, 1)
    events = [(i, start + datetime.timedelta(minutes=72 * i), draw.randrange(40), draw.choice(["view", "click", "error", "signup"]),
               draw.uniform(1, 400), f'{{"k": {draw.randrange(40)}}}') for i in range(600)]
    events = spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.write.parquet(f"{path}/events.parquet")
    spark.range(40).select(F.col("id").alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey")).write.parquet(f"{path}/customer.parquet")
    return path


def test_score_logreg_is_fitted_until_it_converges(spark, folder, monkeypatch):
    fitted, fit = [], models.fit_logistic
    monkeypatch.setattr(models, "fit_logistic", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    QUERIES["score_logreg"](spark, folder).count()
    model, = [m.stages[-1] for m in fitted]
    assert model.getMaxIter() == 500 and 50 < model.summary.totalIterations < 500


def test_score_gbt_asks_for_all_rounds(spark, folder, monkeypatch):
    asked, fit = [], models.fit_boosted_trees

    def short(train, columns, params=models.TreeParams(), **more):
        asked.append((params, more))
        return fit(train, columns, replace(params, n_estimators=2), **more)

    monkeypatch.setattr(models, "fit_boosted_trees", short)
    QUERIES["score_gbt"](spark, folder).count()
    assert asked == [(models.TreeParams(), {})] and models.TreeParams().n_estimators == 400 and models.TreeParams().max_depth == 5


@pytest.mark.parametrize("losses, fitted", [
    ([1 / (i + 1) for i in range(400)], [100, 400]),  # the best round is the last one
    ([abs(i - 69) for i in range(400)], [100]),  # patience ends with the round 100
    ([abs(i - 70) for i in range(400)], [100, 400]),
    ([2 - i / 100 for i in range(90)] + [0.5] + [0.6] * 29 + [0.4] + [0.7] * 279, [100, 400]),  # 29 rounds without a lower one
    ([1 / (i + 1) for i in range(120)], [120]),  # a quarter is within patience
])
def test_stopping_round_is_that_of_all_rounds(losses, fitted, monkeypatch):
    seen = []

    def fit(rounds, past, columns):
        seen.append(rounds)
        return SimpleNamespace(stages=[SimpleNamespace(transform=lambda df: df),
                                       SimpleNamespace(evaluateEachIteration=lambda df: losses[:rounds])])

    monkeypatch.setattr(models, "_fit", fit)
    classifier = SimpleNamespace(setParams=lambda maxIter: maxIter)
    assert models._stopping_round(classifier, None, None, [], len(losses)) == models.best_round(losses)
    assert seen == fitted


def test_first_trees_do_not_depend_on_later_ones(spark):
    draw = random.Random(3)
    rows = [(draw.random(), draw.random(), float(draw.random() < 0.3)) for _ in range(300)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, label double").coalesce(1))
    short, long = (GBTClassifier(maxIter=n, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=7).fit(df) for n in (3, 9))
    assert [t.toDebugString.split("\n")[1:] for t in short.trees] == [t.toDebugString.split("\n")[1:] for t in long.trees[:3]]
    assert short.evaluateEachIteration(df) == pytest.approx(long.evaluateEachIteration(df)[:3])
