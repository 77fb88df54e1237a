"""Run log and prediction tables."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywatch.columns import RUN_SCHEMA, TO_KEYS, FROM_KEYS, TS
from paywatch.sources.tables import add_column_if_absent, align_to, append_once, append_table, create_if_absent, is_folder

ID_COLUMNS = [*FROM_KEYS, *TO_KEYS, TS]


def new_run_id(now=None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def model_version(run_id: str, model="boosted_trees") -> str:
    return f"{model}_{run_id}"


def features_json(columns):
    return F.to_json(F.array(*[F.lit(c) for c in columns]))


def params_json(params: dict):
    return F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in params.items()]))


def run_row(summary: DataFrame, run_id, version, params: dict, columns, model_path) -> DataFrame:
    """The run-log row: one-row metrics plus run metadata, in the run table's columns."""
    return align_to(summary.withColumns({
        "run_id": F.lit(run_id),
        "model_version": F.lit(version),
        "params_json": params_json(params),
        "features_json": features_json(columns),
        "model_path": F.lit(model_path),
        "created_at": F.current_timestamp().cast("timestamp_ntz"),
    }), RUN_SCHEMA)


def log_run(spark: SparkSession, row: DataFrame, table: str, path=None):
    create_if_absent(spark, table, RUN_SCHEMA, path)
    append_table(row, table)


def predictions(scored: DataFrame, run_id, version) -> DataFrame:
    """One row per scored payment: its keys, the probability and the run's stamps."""
    return scored.select(
        *ID_COLUMNS,
        F.col("score").alias("fraud_probability"),
        F.lit(version).alias("model_name"),
        F.lit(version).alias("model_version"),
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().cast("timestamp_ntz").alias("scored_at"),
    )


def write_predictions(df: DataFrame, table: str, path=None):
    """Appends predictions; older tables first get the run columns they lack."""
    spark = df.sparkSession
    create_if_absent(spark, table, df.schema, path)
    for column in ("run_id", "model_version"):
        add_column_if_absent(spark, table, column, "string")
    append_table(df, table)


def write_once(df: DataFrame, table: str, path=None):
    """Run rows or predictions, keyed by their run id: a retried write leaves one copy. Older tables first get the run columns."""
    spark = df.sparkSession
    if not is_folder(table) and spark.catalog.tableExists(table):
        for column in ("run_id", "model_version"):
            add_column_if_absent(spark, table, column, "string")
    append_once(df, table, "run_id", path)
