"""Health checks of the feature table and of training samples. Each is one pass of aggregates."""

import logging

from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.columns import KEYS, LABEL, MODEL_FEATURES, TS
from paywatch.operators.quantiles import approximate_quantiles, exact_quantiles

log = logging.getLogger(__name__)

CHECKED = KEYS + [LABEL] + MODEL_FEATURES
SHARES = (0.5, 0.9, 0.99)


def _long(row: DataFrame, fields) -> DataFrame:
    """One-row aggregate to rows: `fields` holds one dict of output name → column per row."""
    structs = [F.struct(*[c.alias(n) for n, c in f.items()]) for f in fields]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _label_aggregates(label=LABEL):
    return [
        F.count("*").alias("row_count"),
        F.sum(label).alias("fraud_count"),
        F.try_divide(F.sum(label).cast("double"), F.count("*")).alias("fraud_rate"),
    ]


def _null_rate(column):
    return F.avg(F.col(column).isNull().cast("double"))


def _bad_aggregates(label=LABEL):
    def bad_amount(c):
        return F.count_if((F.col(c) <= 0) | F.col(c).isNull())
    return [
        bad_amount("amount_paid").alias("bad_amount_paid_cnt"),
        bad_amount("amount_received").alias("bad_amount_received_cnt"),
        F.count_if(~F.col(label).isin(0, 1) | F.col(label).isNull()).alias("bad_label_cnt"),
    ]


def label_summary(df: DataFrame, label=LABEL) -> DataFrame:
    return df.agg(*_label_aggregates(label))


def time_span(df: DataFrame, ts=TS) -> DataFrame:
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def null_rates(df: DataFrame, columns=CHECKED) -> DataFrame:
    """(column, null_rate)."""
    row = df.agg(*[_null_rate(c).alias(c) for c in columns])
    return _long(row, [{"column": F.lit(c), "null_rate": F.col(c)} for c in columns])


def bad_values(df: DataFrame, label=LABEL) -> DataFrame:
    return df.agg(*_bad_aggregates(label))


def duplicate_keys(df: DataFrame, keys=KEYS) -> DataFrame:
    """Rows beyond the first of each key; null keys group together; 0 when there are none."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows_estimate"))


def numeric_stats(df: DataFrame, columns=MODEL_FEATURES) -> DataFrame:
    """(column, avg, std, min, max)."""
    stats = {"avg": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{s}__{c}") for c in columns for s, f in stats.items()])
    return _long(row, [{"column": F.lit(c), **{s: F.col(f"{s}__{c}") for s in stats}} for c in columns])


def percentiles(df: DataFrame, columns=MODEL_FEATURES, shares=SHARES, exact=False) -> DataFrame:
    """(column, share, value)."""
    return (exact_quantiles if exact else approximate_quantiles)(df, columns, shares)


def distribution_report(df: DataFrame, columns=MODEL_FEATURES, shares=SHARES, exact=False) -> DataFrame:
    """(column, stat, value) of avg, std, min, max and percentiles."""
    stats = numeric_stats(df, columns).unpivot("column", ["avg", "std", "min", "max"], "stat", "value")
    label = F.concat(F.lit("p"), F.round(F.col("share") * 100).cast("int").cast("string"))
    points = percentiles(df, columns, shares, exact).select("column", label.alias("stat"), "value")
    return stats.unionByName(points)


def validation_report(df: DataFrame, table: str, columns=CHECKED, keys=KEYS, label=LABEL, ts=TS) -> DataFrame:
    """One row: counts, time span, null rates, bad values, duplicates. Two passes over the table."""
    report = df.agg(
        *_label_aggregates(label),
        F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"),
        *[_null_rate(c).alias(f"null_rate__{c}") for c in columns],
        *_bad_aggregates(label),
    )
    return report.withColumns({
        "duplicate_rows_estimate": duplicate_keys(df, keys).scalar(),
        "feature_table": F.lit(table),
        "generated_at": F.current_timestamp(),
    })


def class_weights(df: DataFrame, label=LABEL) -> DataFrame:
    """Class counts (at least 1), the positives' weight for trees and balanced weights for linear models."""
    neg, pos = F.greatest(F.count_if(F.col(label) == 0), F.lit(1)), F.greatest(F.count_if(F.col(label) == 1), F.lit(1))
    row = df.agg(neg.alias("neg"), pos.alias("pos"))
    n = F.col("neg") + F.col("pos")
    return row.withColumns({
        "scale_pos_weight": F.col("neg") / F.col("pos"),
        "balanced_weight_neg": n / (2 * F.col("neg")),
        "balanced_weight_pos": n / (2 * F.col("pos")),
    })


def sample_checks(df: DataFrame, split="split", label=LABEL) -> DataFrame:
    """Per split: rows, null labels, classes present, and what would make metrics unstable."""
    out = df.groupBy(split).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(label).isNull()).alias("null_labels"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    return out.withColumns({
        "both_classes": ((F.col("negatives") > 0) & (F.col("positives") > 0)).cast("int"),
        "few_positives": (F.col("positives") < settings.MIN_TEST_POSITIVES).cast("int"),
        "few_rows": (F.col("rows") < settings.MIN_TEST_ROWS).cast("int"),
    })


def require_trainable(checks: DataFrame, split="split", splits=("train", "test")):
    """Raises unless every split has rows, no null label and both classes; warns of what makes metrics unstable.
    `checks` are those of `sample_checks`."""
    seen = {r[split]: r for r in checks.collect()}
    for name in splits:
        row = seen.get(name)
        if row is None:
            raise ValueError(f"{name}: no rows")
        if row["null_labels"]:
            raise ValueError(f"{name}: {row['null_labels']} null labels")
        if not row["both_classes"]:
            raise ValueError(f"{name}: one class only")
        if row["few_positives"]:
            log.warning("%s: only %d positives; metrics will vary much", name, row["positives"])
        if row["few_rows"]:
            log.warning("%s: only %d rows; metrics will vary much", name, row["rows"])


def sample_profile(df: DataFrame, columns=MODEL_FEATURES) -> DataFrame:
    """(column, min, max, mean, null_pct) of a training sample."""
    row = df.agg(*[
        a.alias(f"{s}__{c}") for c in columns for s, a in {
            "min": F.min(F.col(c).cast("double")), "max": F.max(F.col(c).cast("double")),
            "mean": F.round(F.avg(F.col(c).cast("double")), 4), "null_pct": F.round(_null_rate(c) * 100, 2),
        }.items()
    ])
    stats = ("min", "max", "mean", "null_pct")
    return _long(row, [{"column": F.lit(c), **{s: F.col(f"{s}__{c}") for s in stats}} for c in columns])
