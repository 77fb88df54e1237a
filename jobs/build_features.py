"""spark-submit jobs/build_features.py TRANSACTIONS ACCOUNTS OUTPUT [FILES_PER_DAY]"""

import sys

from pyspark.sql import SparkSession

from paywatch.plans.features import build_transaction_features
from paywatch.session import clear_staged
from paywatch.sources.tables import overwrite_features, read_table


def main(spark, transactions, accounts, output, files_per_day=None):
    features = build_transaction_features(read_table(spark, transactions), read_table(spark, accounts))
    overwrite_features(features, output, files_per_day=files_per_day and int(files_per_day))


if __name__ == "__main__":
    session = SparkSession.builder.appName("build_features").getOrCreate()
    main(session, *sys.argv[1:])
    clear_staged(session)
