"""Health report of a feature table, written as tables."""

from paywatch.operators.quality import distribution_report, validation_report
from paywatch.sources.tables import overwrite_table, read_table


def validate_table(spark, feature_table, report_table, distribution_table=None, path=None, distribution_path=None):
    """Writes the one-row report (and the distributions) and returns the written report."""
    features = read_table(spark, feature_table)
    overwrite_table(validation_report(features, feature_table), report_table, path=path)
    if distribution_table:
        overwrite_table(distribution_report(features), distribution_table, path=distribution_path)
    return read_table(spark, report_table)
