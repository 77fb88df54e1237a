"""spark-submit jobs/validate.py FEATURES REPORT [DISTRIBUTIONS]"""

import sys

from pyspark.sql import SparkSession

from paywatch.plans.validation import validate_table


def main(spark, features, report, distributions=None):
    written = validate_table(spark, features, report, distributions)
    written.show(truncate=False, vertical=True)
    return written


if __name__ == "__main__":
    main(SparkSession.builder.appName("validate").getOrCreate(), *sys.argv[1:])
