"""spark-submit jobs/train_and_score.py FEATURES RUNS PREDICTIONS [TEST_DAYS] [TRIALS]"""

import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from paywatch import settings
from paywatch.plans.training import TrainingConfig, train_and_evaluate
from paywatch.session import clear_staged
from paywatch.sources.tables import read_table


def main(spark, features, runs, predictions, test_days=settings.TEST_DAYS, trials=settings.SEARCH_TRIALS,
         config=TrainingConfig()):
    config = replace(config, test_days=int(test_days), trials=int(trials))
    result = train_and_evaluate(read_table(spark, features), config, runs_table=runs, predictions_table=predictions)
    result.benchmark.show()
    for name, view in result.reports.items():
        print(name)
        view.show(50, truncate=False)
    return result


if __name__ == "__main__":
    session = SparkSession.builder.appName("train_and_score").getOrCreate()
    main(session, *sys.argv[1:])
    clear_staged(session)
