"""Profiles that merge: one state per day and column, and one per day for all pairs of columns.

A day's state is made once; the report, scaling and correlations of any range of days come from merged states, without a scan of the
rows. Means and squared deviations are merged around common centres, so nothing cancels; quantiles come from mergeable sketches.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.columns import TS
from paywatch.operators.preparation import Standardization
from paywatch.session import package_on_workers

SALTS = 64
PAIRS = "day date, n long, mean array<double>, comoment array<double>"


def column_state(df: DataFrame, columns, ts=TS) -> DataFrame:
    """(day, column, rows, n, mean, m2, low, high, sketch) of each day and column; `n` counts values, nulls are left out.

    One wide row per day, turned into a row per column afterwards: payments are not copied per column, and a task keeps a group
    per day.
    """
    numbers = df.select(F.to_date(ts).alias("day"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def state(x):
        return F.struct(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("low"),
                        F.max(x).alias("high"), F.kll_sketch_agg_double(x).alias("sketch"))

    days = numbers.groupBy("day").agg(F.count("*").alias("rows"), *[state(f"x{i}").alias(f"s{i}") for i, _ in enumerate(columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("s")) for i, c in enumerate(columns)])
    return days.select("day", "rows", F.inline(each)).select("day", "column", "rows", "s.*")


def merged_columns(state: DataFrame, shares=()) -> DataFrame:
    """(column, rows, n, avg, std, min, max) over all days of `state`, in the terms of `numeric_stats`, and an approximate
    `q<i>` for each of `shares`. Filter the days first."""
    centre = state.where("n > 0").groupBy("column").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("avg"))
    away = F.col("mean") - F.col("avg")
    moved = state.join(F.broadcast(centre), "column", "left").withColumn("m2", F.col("m2") + F.col("n") * away * away)
    out = moved.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max("avg").alias("avg"), F.sum("m2").alias("m2"),
        F.min("low").alias("min"), F.max("high").alias("max"))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    out = out.select("column", "rows", "n", "avg", std.alias("std"), "min", "max")
    if shares:
        sketches = state.where("n > 0").groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
        sketches = sketches.select("column", *[
            F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias(f"q{i}") for i, s in enumerate(shares)])
        out = out.join(sketches, "column", "left")
    return out


def merged_scales(state: DataFrame) -> Standardization:
    """Means and population deviations of all days of `state`, as `fit_standardization` gives them."""
    row = merged_columns(state).agg(F.collect_list(F.struct("column", "n", "avg", "std")).alias("all")).first()  # an entry per column
    return Standardization({c: (mean or 0.0, (std or 0.0) * math.sqrt((n - 1) / n) or 1.0 if n else 1.0) for c, n, mean, std in row["all"]})


def _join(a, b):
    """Two (n, mean, comoment) as one."""
    n = a[0] + b[0]
    away = b[1] - a[1]
    return n, a[1] + away * (b[0] / n), a[2] + b[2] + np.outer(away, away) * (a[0] * b[0] / n)


def _per_task(many: int):
    def run(batches):
        found = {}
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, many)
            days = batch.column("day").cast(pa.int32()).to_numpy(zero_copy_only=False)
            for day in np.unique(days):
                part = x[days == day]
                mean = part.mean(0)
                one = (len(part), mean, (part - mean).T @ (part - mean))
                found[day] = _join(found[day], one) if day in found else one
        keys = sorted(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()).cast(pa.date32()), pa.array([found[k][0] for k in keys], pa.int64()),
             pa.array([found[k][1].tolist() for k in keys], pa.list_(pa.float64())),
             pa.array([found[k][2].ravel().tolist() for k in keys], pa.list_(pa.float64()))], names=["day", "n", "mean", "comoment"])

    return run


def _folded(frame: pd.DataFrame):
    total = None
    for n, mean, comoment in zip(frame["n"], frame["mean"], frame["comoment"]):
        one = (n, np.asarray(mean), np.asarray(comoment).reshape(len(mean), len(mean)))
        total = one if total is None else _join(total, one)
    return total


def _one_row(frame: pd.DataFrame) -> pd.DataFrame:
    n, mean, comoment = _folded(frame)
    return frame.iloc[:1].assign(n=[n], mean=[mean.tolist()], comoment=[comoment.ravel().tolist()])


def pair_state(df: DataFrame, columns, ts=TS) -> DataFrame:
    """(day, n, mean, comoment) of each day: means of the columns and sums of products of deviations of all pairs. Columns must have no
    nulls and rows a time. Tasks bring one row for each of their days; those are joined in two steps."""
    package_on_workers(df.sparkSession)
    rows = df.where(F.col(ts).isNotNull()).select(
        F.to_date(ts).alias("day"), F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("x"))
    parts = rows.mapInArrow(_per_task(len(list(columns))), PAIRS).withColumn("salt", (F.spark_partition_id() % SALTS).cast("int"))
    parts = parts.groupBy("day", "salt").applyInPandas(_one_row, PAIRS + ", salt int").drop("salt")
    return parts.groupBy("day").applyInPandas(_one_row, PAIRS)


def merged_correlations(state: DataFrame, columns) -> DataFrame:
    """(column_a, column_b, abs_r) for each pair in column order over all days of `state`; null where undefined. One row per day reaches the
    task that joins them."""
    names = list(columns)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        _, _, c = _folded(frame)
        spread = np.sqrt(np.diag(c))
        rows = []
        for i, a in enumerate(names):
            for j in range(i + 1, len(names)):
                both = spread[i] * spread[j]
                rows.append((a, names[j], min(1.0, abs(c[i, j]) / both) if both > 0 else None))
        return pd.DataFrame(rows, columns=["column_a", "column_b", "abs_r"])

    return state.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(run, "column_a string, column_b string, abs_r double")
