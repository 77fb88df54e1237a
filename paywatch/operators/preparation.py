"""From feature columns to model inputs. Fitting returns small plans (one value per column);
applying them is a projection of literals."""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.operators.quantiles import medians
from paywatch.session import package_on_workers

SUFFIX = "_is_missing"


@dataclass(frozen=True)
class Imputation:
    """Medians of the training rows, and the columns that had nulls there."""

    medians: dict
    indicators: tuple

    @property
    def columns(self):
        return [*self.medians, *[c + SUFFIX for c in self.indicators]]

    def apply(self, df: DataFrame, keep=None) -> DataFrame:
        """Fills nulls and adds `<column>_is_missing`; with `keep`, only the indicators named there."""
        marks = [c for c in self.indicators if keep is None or c + SUFFIX in keep]
        flagged = df.withColumns({c + SUFFIX: F.col(c).isNull().cast("int") for c in marks})
        return flagged.withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in self.medians.items()
        })

    def as_table(self, spark) -> DataFrame:
        """(column, median, has_indicator), to be saved with a model."""
        rows = [(c, float(m), c in self.indicators) for c, m in self.medians.items()]
        return spark.createDataFrame(rows, "column string, median double, has_indicator boolean")

    @classmethod
    def from_table(cls, df: DataFrame):
        rows = df.collect()  # one row per feature
        return cls({r["column"]: r["median"] for r in rows},
                   tuple(r["column"] for r in rows if r["has_indicator"]))


def null_counts(df: DataFrame, columns) -> dict:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()


def fit_imputation(train: DataFrame, columns) -> Imputation:
    """Exact medians; a column without any value is filled with 0 and flagged."""
    found = {r["column"]: r["value"] for r in medians(train, columns).collect()}  # one row per feature
    nulls = null_counts(train, columns)
    return Imputation(
        {c: found[c] if found.get(c) is not None else 0.0 for c in columns},
        tuple(c for c in columns if nulls[c]),
    )


def assemble(df: DataFrame, columns, output="features") -> DataFrame:
    """Vector in the given column order; columns must have no nulls."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


MOMENTS = "n long, mean array<double>, products array<double>"
MERGERS = 16


def _merge(a, b):
    """Count, means and centred products of the rows of both."""
    if a is None or not b[0]:
        return b if a is None else a
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def _state(state):
    n, mean, products = state
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([mean], pa.list_(pa.float64())),
                                       pa.array([products.ravel()], pa.list_(pa.float64()))], names=["n", "mean", "products"])


def _moments(batches):
    """One state for all rows of a task. Values count from the first row of their batch, so a constant column has products of exactly 0."""
    state = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if any(c.null_count for c in batch.columns):
            raise ValueError("a null among the columns to be correlated")
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
        if np.isnan(x).any():
            raise ValueError("NaN among the columns to be correlated")
        first = x[0].copy()
        x = x - first
        mean = x.mean(axis=0)
        x -= mean
        state = _merge(state, (len(x), first + mean, x.T @ x))
    if state is not None:
        yield _state(state)


def _states(rows):
    return [(r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(len(r["mean"]), -1)) for r in rows]


def _merged(batches):
    state = None
    for batch in batches:
        for one in _states(batch.to_pylist()):
            state = _merge(state, one)
    if state is not None:
        yield _state(state)


@dataclass(frozen=True)
class Moments:
    """Row count, means and sums of centred products of some columns."""

    columns: tuple
    n: int
    mean: np.ndarray
    products: np.ndarray

    def correlations(self):
        """Absolute Pearson correlations as a small columns × columns array; NaN for a constant column."""
        if self.n < 2:
            raise ValueError(f"correlations of {self.n} rows")
        variance = np.diag(self.products) / (self.n - 1)
        deviation = np.sqrt(np.where(abs(variance) < 1e-12, np.nan, variance))
        out = abs(self.products / (self.n - 1) / np.outer(deviation, deviation))
        np.fill_diagonal(out, 1.0)
        return out

    def scales(self, columns) -> dict:
        """{column: (mean, population deviation)}"""
        at = {c: i for i, c in enumerate(self.columns)}
        n = max(1, self.n)
        return {c: (float(self.mean[at[c]]), float(np.sqrt(self.products[at[c], at[c]] / n))) for c in columns}


def moments(df: DataFrame, columns) -> Moments:
    """Of columns without nulls and NaN, in one pass. Tasks hold one state each, MERGERS tasks merge them and one merges theirs."""
    columns = tuple(columns)
    package_on_workers(df.sparkSession)
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    states = numbers.mapInArrow(_moments, MOMENTS)
    for tasks in (MERGERS, 1):
        states = states.repartition(tasks).mapInArrow(_merged, MOMENTS)
    row = states.first()
    if row is None:
        return Moments(columns, 0, np.zeros(len(columns)), np.zeros((len(columns), len(columns))))
    return Moments(columns, *_states([row])[0])


def correlation_matrix(df: DataFrame, columns):
    """Absolute Pearson correlations as a small columns × columns array; NaN for a constant column."""
    return moments(df, columns).correlations()


def correlation_pairs(df: DataFrame, columns) -> DataFrame:
    """(column_a, column_b, abs_r) for each pair in column order; null where undefined."""
    matrix = correlation_matrix(df, columns)
    rows = [
        (a, b, None if matrix[i, j] != matrix[i, j] else float(matrix[i, j]))
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j
    ]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, abs_r double")


def uncorrelated(df: DataFrame, columns, limit=settings.CORRELATION_LIMIT):
    """Columns not above `limit` with any earlier column, whether that one is kept or not."""
    return kept_columns(correlation_matrix(df, columns), columns, limit)


def kept_columns(matrix, columns, limit):
    return [c for j, c in enumerate(columns) if not any(matrix[i, j] > limit for i in range(j))]


@dataclass(frozen=True)
class Standardization:
    """Mean and population deviation per column; deviation 0 counts as 1."""

    scales: dict = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(std) for c, (mean, std) in self.scales.items()
        })


def fit_standardization(train: DataFrame, columns) -> Standardization:
    row = train.agg(*[
        F.struct(F.avg(F.col(c).cast("double")), F.stddev_pop(F.col(c).cast("double"))).alias(c) for c in columns
    ]).first()
    return Standardization({c: (row[c][0] or 0.0, row[c][1] or 1.0) for c in columns})


def neutralize(df: DataFrame, imputation: Imputation, columns=settings.STRESS_FEATURES) -> DataFrame:
    """Overwrites columns with their training median."""
    return df.withColumns({c: F.lit(float(imputation.medians.get(c, 0.0))) for c in columns})
