"""The feature table: one row per payment."""

from pyspark.sql import DataFrame, functions as F

from paywatch.columns import FEATURE_TABLE, FROM_KEYS, TO_KEYS
from paywatch.functions.scalars import with_amount_flags, with_calendar, with_ratios
from paywatch.operators.account_windows import incoming_features, outgoing_features
from paywatch.operators.cleaning import clean_transactions, with_payment_ids
from paywatch.operators.enrichment import account_dimension, with_account_side
from paywatch.operators.hot_keys import find_hot_keys, find_hot_sides


def transaction_features(tx: DataFrame, accounts: DataFrame, hot_from=None, hot_to=None) -> DataFrame:
    """All feature columns plus `tx_id`, from cleaned payments.

    Each side's account lookup follows that side's windows, so a sort-merge lookup finds the rows
    already partitioned by account: two shuffles of the payments in all, and a third, by pair of accounts, where
    there are hot accounts.
    """
    dimension = account_dimension(accounts)
    hot_from = find_hot_keys(tx, FROM_KEYS) if hot_from is None else hot_from
    hot_to = find_hot_keys(tx, TO_KEYS) if hot_to is None else hot_to
    def attributes(side, hot):
        return lambda rows: with_account_side(rows, dimension, side, hot)

    out = outgoing_features(tx, hot_from, attributes("from", hot_from))
    out = incoming_features(out, hot_to, tx, attributes("to", hot_to))
    return _typed(with_ratios(with_amount_flags(with_calendar(out))))


def payment_features(tx: DataFrame, hot_from=None, hot_to=None) -> DataFrame:
    """The columns of `transaction_features` that need no account data: all keys and model inputs."""
    out = incoming_features(outgoing_features(tx, hot_from), hot_to, source=tx)
    return _typed(with_ratios(with_amount_flags(with_calendar(out))))


def _typed(df: DataFrame) -> DataFrame:
    df = df.withColumnRenamed("ts", "event_timestamp")
    typed = [F.col(name).cast(kind).alias(name) if kind else F.col(name)
             for name, kind in FEATURE_TABLE if name in df.columns]
    return df.select("tx_id", *typed)


def build_transaction_features(raw: DataFrame, accounts: DataFrame, strict=True) -> DataFrame:
    """From raw tables: clean, add behaviour, account and calendar columns.

    Busy accounts are counted on the raw rows: that reads four key columns and parses nothing, and
    a count before cleaning can only be higher.
    """
    raw = with_payment_ids(raw)
    hot_from, hot_to = find_hot_sides(raw, FROM_KEYS, TO_KEYS)
    return transaction_features(clean_transactions(raw, strict=strict), accounts, hot_from, hot_to)
