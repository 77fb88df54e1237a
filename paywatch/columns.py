"""Column catalog: one list shared by feature build, validation and training."""

import logging

from pyspark.sql import types as T

log = logging.getLogger(__name__)

TS = "event_timestamp"
LABEL = "is_laundering"
TX_ID = "tx_id"
EVENT_DATE = "event_date"  # partition column of the written feature table
FROM_KEYS = ["from_bank", "from_account"]
TO_KEYS = ["to_bank", "to_account"]
KEYS = FROM_KEYS + TO_KEYS + [TS]

# The feature table's columns in output order, with their types.
FEATURE_TABLE = [
    ("event_timestamp", "timestamp_ntz"),
    ("from_bank", None),
    ("from_account", None),
    ("to_bank", None),
    ("to_account", None),
    ("is_laundering", "int"),
    ("amount_paid", "double"),
    ("amount_received", "double"),
    ("log_amount", "double"),
    ("is_large_txn", "int"),
    ("is_rounded_amount", "int"),
    ("receiving_currency", "string"),
    ("payment_currency", "string"),
    ("currencies_different", "int"),
    ("payment_format", "string"),
    ("same_bank", "int"),
    ("hour_of_day", "int"),
    ("day_of_week", "int"),
    ("is_weekend", "int"),
    ("time_since_last_txn_from", "bigint"),
    ("txn_count_1h_from", "bigint"),
    ("txn_count_24h_from", "bigint"),
    ("txn_count_7d_from", "bigint"),
    ("txn_amount_sum_24h_from", "double"),
    ("avg_txn_amount_7d_from", "double"),
    ("max_txn_amount_7d_from", "double"),
    ("num_unique_receivers", "bigint"),
    ("txn_amount_std_7d_from", "double"),
    ("num_unique_banks", "bigint"),
    ("cross_bank_ratio_7d", "double"),
    ("first_txn_of_day_from", "int"),
    ("amount_vs_7d_avg_ratio", "double"),
    ("amount_zscore_7d_from", "double"),
    ("pct_change_vs_prev", "double"),
    ("txn_velocity_7d_from", "double"),
    ("time_since_last_txn_to", "bigint"),
    ("num_unique_senders", "bigint"),
    ("is_new_counterparty", "int"),
    ("repeat_counterparty_count", "bigint"),
    ("num_similar_amount_txns_24h", "bigint"),
    ("txn_gap_std_7d", "double"),
    ("from_entity_id", None),
    ("from_entity_name", "string"),
    ("to_entity_id", None),
    ("to_entity_name", "string"),
    ("from_bank_name", "string"),
    ("to_bank_name", "string"),
    ("from_num_accounts_per_entity", "bigint"),
    ("to_num_accounts_per_entity", "bigint"),
]

# Model inputs in training order.
MODEL_FEATURES = [
    "amount_paid", "amount_received", "log_amount",
    "currencies_different", "same_bank", "hour_of_day", "day_of_week", "is_weekend",
    "time_since_last_txn_from", "txn_count_1h_from", "txn_count_24h_from", "txn_count_7d_from",
    "txn_amount_sum_24h_from", "avg_txn_amount_7d_from", "max_txn_amount_7d_from",
    "txn_amount_std_7d_from", "txn_gap_std_7d", "time_since_last_txn_to",
    "num_unique_receivers", "num_unique_senders", "num_unique_banks", "cross_bank_ratio_7d",
    "is_new_counterparty", "repeat_counterparty_count", "num_similar_amount_txns_24h",
    "first_txn_of_day_from", "amount_vs_7d_avg_ratio", "amount_zscore_7d_from",
    "pct_change_vs_prev", "txn_velocity_7d_from",
    "is_large_txn", "is_rounded_amount",
]

# Lifetime counts see later payments, so they are left out of model inputs unless asked for.
# Fixed values.
LEAKY_FEATURES = ["num_unique_receivers", "num_unique_senders", "num_unique_banks"]
STRICT_FEATURES = [c for c in MODEL_FEATURES if c not in LEAKY_FEATURES]

# Columns of the run table.
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("cutoff_ts", T.TimestampNTZType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("test_fraud_rate", T.DoubleType()),
    T.StructField("auc_pr", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("ks", T.DoubleType()),
    T.StructField("best_threshold_youden", T.DoubleType()),
    T.StructField("params_json", T.StringType()),
    T.StructField("features_json", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])


def missing_columns(df, wanted):
    present = {c.lower() for c in df.columns}
    return [c for c in wanted if c.lower() not in present]


def has_column(df, name):
    """Names compare as Spark compares them: without case."""
    return not missing_columns(df, [name])


def require_columns(df, wanted, strict=True):
    """Raise when columns are absent, or warn and return their names when `strict` is off."""
    absent = missing_columns(df, wanted)
    if absent and strict:
        raise ValueError(f"the input lacks {len(absent)} wanted columns: {', '.join(absent)}")
    if absent:
        log.warning("going on without %d absent columns: %s", len(absent), ", ".join(absent))
    return absent


def select_present(df, wanted):
    """Keep the wanted columns that exist, in the wanted order."""
    absent = set(missing_columns(df, wanted))
    return df.select(*[c for c in wanted if c not in absent])
