"""Reproducible samples. Every choice follows the md5 order of the payment id (see functions.hashing)."""

from pyspark.sql import DataFrame, Window, functions as F

from paywatch import settings
from paywatch.columns import LABEL
from paywatch.functions.hashing import below_fraction, hash_order
from paywatch.functions.scalars import round_half_even
from paywatch.operators.dedup import dedupe_keys
from paywatch.session import stage


def class_sample(df: DataFrame, fractions, label=LABEL, seed=settings.SEED) -> DataFrame:
    """Keeps about `fractions[c]` of class c; other labels are left out. A filter: no shuffle."""
    keep = F.lit(False)
    for value, fraction in fractions.items():
        keep = keep | ((F.col(label) == value) & below_fraction(fraction, seed=seed))
    return df.filter(keep)


def class_limits(spark, caps, label=LABEL) -> DataFrame:
    """(label, keep) for `take_lowest`; a cap of None means all."""
    rows = [(value, 2**62 if cap is None else int(cap)) for value, cap in caps.items()]
    return spark.createDataFrame(rows, f"{label} int, keep bigint")


def take_lowest(df: DataFrame, limits: DataFrame, by=(LABEL,), seed=settings.SEED) -> DataFrame:
    """Exactly `keep` rows per group, lowest hash first; groups absent from `limits` are left out.

    Finds the last kept (hash, id) of each group: rows are counted per leading 16 bits of the hash,
    and only the one bucket where the limit falls, 1/65,536 of the rows, is ranked. Hashes are even, so
    no bucket is a heavy one. The rows themselves are filtered in place and never shuffled. `limits`
    has one row per class (and window) and is broadcast.
    """
    by = list(by)
    order = hash_order(seed=seed)
    narrow = df.select(*by, "tx_id", order.alias("_h")).withColumn("_bucket", F.substring("_h", 1, 4))
    counts = narrow.groupBy(*by, "_bucket").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumn("_upto", upto).join(F.broadcast(limits), by)
    before = F.col("_upto") - F.col("n")
    # The bucket holding the keep-th row, and how many of its rows to keep; none if all rows fit.
    reached = counts.filter((before < F.col("keep")) & (F.col("_upto") >= F.col("keep"))).select(
        *by, "_bucket", (F.col("keep") - before).alias("_rest")
    )
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_h", "tx_id"))
    inside = narrow.join(F.broadcast(reached), [*by, "_bucket"]).withColumn("_rank", rank)
    last = inside.filter(F.col("_rank") == F.col("_rest")).select(
        *by, F.col("_h").alias("_last_h"), F.col("tx_id").alias("_last_id")
    )
    cut = limits.filter(F.col("keep") > 0).join(F.broadcast(last), by, "left").drop("keep")
    kept = df.join(F.broadcast(cut), by).filter(
        F.col("_last_h").isNull()
        | (order < F.col("_last_h"))
        | ((order == F.col("_last_h")) & (F.col("tx_id") <= F.col("_last_id")))
    )
    return kept.select(*df.columns)


def class_cap(df: DataFrame, caps, label=LABEL, seed=settings.SEED) -> DataFrame:
    """At most `caps[c]` rows of class c."""
    return take_lowest(df, class_limits(df.sparkSession, caps, label), [label], seed)


def stratified_sample(df: DataFrame, fractions, caps=None, label=LABEL, seed=settings.SEED) -> DataFrame:
    """Fraction per class, then an optional cap per class."""
    sample = class_sample(df, fractions, label, seed)
    return class_cap(sample, {c: (caps or {}).get(c) for c in fractions}, label, seed) if caps else sample


def rate_limits(df: DataFrame, rate: float, label=LABEL) -> DataFrame:
    """(label, keep) that bring the positive rate to `rate` by thinning the class in excess."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos"))
    neg, pos = F.col("neg"), F.col("pos")
    observed = F.try_divide(pos.cast("double"), neg + pos)
    both = (neg > 0) & (pos > 0)

    keep_pos = F.when(both & (observed > rate), F.least(round_half_even(neg * F.lit(rate) / F.lit(1 - rate)), pos))
    keep_neg = F.when(both & (observed < rate), F.least(round_half_even(pos * F.lit(1 - rate) / F.lit(rate)), neg))
    return row.select(F.inline(F.array(
        F.struct(F.lit(0).alias(label), F.coalesce(keep_neg, neg).alias("keep")),
        F.struct(F.lit(1).alias(label), F.coalesce(keep_pos, pos).alias("keep")),
    )))


def enforce_positive_rate(df: DataFrame, rate=settings.TARGET_TEST_RATE, label=LABEL, seed=settings.SEED) -> DataFrame:
    return take_lowest(df, rate_limits(df, rate, label), [label], seed)


def natural_rate_sample(df: DataFrame, max_rows=None, rate=settings.TARGET_TEST_RATE,
                        label=LABEL, seed=settings.SEED, keys=None) -> DataFrame:
    """Test set at a realistic rate: cap the classes, drop repeated keys, then enforce the rate.

    No `max_rows` means no cap. The set is written once before its rate is enforced, which needs counts and a cut.
    """
    if max_rows is None:
        capped = df.filter(F.col(label).isin(0, 1))
    else:
        capped = class_cap(df, {0: int(max_rows * (1 - rate)), 1: int(max_rows * rate)}, label, seed)
    unique = stage(dedupe_keys(capped, keys) if keys else dedupe_keys(capped), "natural_rate_sample")
    return enforce_positive_rate(unique, rate, label, seed)
