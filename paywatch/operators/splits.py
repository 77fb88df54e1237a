"""Splits by time."""

from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.columns import EVENT_DATE, LABEL, TS, has_column
from paywatch.functions.scalars import days_before
from paywatch.operators.running_totals import running_totals
from paywatch.operators.sampling import class_sample, take_lowest


def holdout_cutoff(df: DataFrame, days=settings.TEST_DAYS, ts=TS):
    """Latest time minus `days`, as a scalar subquery: it reads one column and may prune day folders."""
    return df.agg(days_before(F.max(ts), days)).scalar()


def with_split(df: DataFrame, days=settings.TEST_DAYS, ts=TS, cutoff=None) -> DataFrame:
    """Adds `split`: train before the cutoff, test from it on. Rows without time are left out. `cutoff` is a scalar that is known
    already."""
    dated = df.filter(F.col(ts).isNotNull())
    cutoff = holdout_cutoff(dated, days, ts) if cutoff is None else cutoff
    return dated.withColumn("split", F.when(F.col(ts) < cutoff, "train").otherwise("test"))


def _before(df, time, ts):
    """Rows before `time`; the same bound on the partition column, where there is one, skips its folders."""
    early = F.col(ts) < time
    return df.filter(early & (F.col(EVENT_DATE) <= F.to_date(time)) if has_column(df, EVENT_DATE) else early)


def _since(df, time, ts):
    late = F.col(ts) >= time
    return df.filter(late & (F.col(EVENT_DATE) >= F.to_date(time)) if has_column(df, EVENT_DATE) else late)


def train_test(df: DataFrame, days=settings.TEST_DAYS, ts=TS):
    """(train, test) as two filters on the cutoff."""
    cutoff = holdout_cutoff(df, days, ts)
    return _before(df, cutoff, ts), _since(df, cutoff, ts)


def trailing_windows(df: DataFrame, days=settings.BACKTEST_DAYS, ts=TS, latest=None) -> DataFrame:
    """Each row once per trailing window that holds it, under `window_days`; one pass for all windows."""
    latest = df.agg(F.max(ts)).scalar() if latest is None else latest
    recent = _since(df, days_before(latest, max(days)), ts)
    out = recent.withColumn("_latest", latest).withColumn("window_days", F.explode(F.array(*[F.lit(d) for d in days])))
    return out.filter(F.col(ts) >= days_before(F.col("_latest"), F.col("window_days"))).drop("_latest")


def backtest_windows(df: DataFrame, days=settings.BACKTEST_DAYS, fractions=None, caps=None,
                     ts=TS, label=LABEL, seed=settings.SEED) -> DataFrame:
    """Trailing windows, sampled per class, with a cap per (window, class) where `caps` are given.

    The fraction filter comes before the copies; the latest time is that of all rows.
    """
    fractions = settings.BACKTEST_FRACTIONS if fractions is None else fractions
    latest = df.agg(F.max(ts)).scalar()
    inside = trailing_windows(class_sample(df, fractions, label, seed), days, ts, latest)
    if not caps:
        return inside
    rows = [(d, c, int(n)) for d in days for c, n in caps.items()]
    limits = df.sparkSession.createDataFrame(rows, f"window_days int, {label} int, keep bigint")
    return take_lowest(inside, limits, ["window_days", label], seed)


def fold_starts(df: DataFrame, folds=settings.CV_FOLDS, ts=TS) -> DataFrame:
    """One row, one array: the first time of each validation block. Blocks hold equal row counts and end
    with the data; boundaries are times, so payments of one minute stay together."""
    minutes = df.groupBy(ts).agg(F.count("*").alias("rows"))
    ranked = running_totals(minutes, ts, ["rows"])
    block = F.floor(F.col("total_rows") / (folds + 1))
    return ranked.agg(F.array(*[
        F.min(F.when(F.col("cum_rows") > F.col("total_rows") - block * (folds + 1 - i), F.col(ts)))
        for i in range(1, folds + 1)
    ]).alias("starts"))


def fold_start_literals(df: DataFrame, folds=settings.CV_FOLDS, ts=TS):
    """`fold_starts` as literals of the column's own type. They travel as text, since a Python time would be read
    in the zone of the Python process; literals, since a subquery would run again in every pass that uses it."""
    starts = fold_starts(df, folds, ts).select(F.transform("starts", lambda s: s.cast("string"))).first()[0]
    return [F.lit(s).cast(df.schema[ts].dataType) for s in starts]


def time_series_folds(df: DataFrame, folds=settings.CV_FOLDS, ts=TS) -> DataFrame:
    """Each row with its `fold` and `role`: train before a fold's block, validate inside it."""
    out = df.withColumn("_starts", fold_starts(df, folds, ts).scalar())
    out = out.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    start, end = F.element_at("_starts", F.col("fold")), F.try_element_at("_starts", F.col("fold") + 1)
    role = F.when(F.col(ts) < start, "train").when(end.isNull() | (F.col(ts) < end), "validate")
    return out.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_starts")
