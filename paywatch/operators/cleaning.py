"""Typed, filtered payments."""

from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.columns import has_column
from paywatch.functions.scalars import parse_timestamp, to_double, to_label
from paywatch.session import stage


def with_payment_ids(raw: DataFrame) -> DataFrame:
    """Raw payments with a `tx_id`. Made-up ids are written with the rows, so they stay the same when a
    lost task runs again; every later tie-break and join relies on that."""
    if has_column(raw, "tx_id"):
        return raw
    return stage(raw.withColumn("tx_id", F.monotonically_increasing_id()), "payments_with_ids")


def _usable():
    return (
        (F.col("_amounts.paid") > 0)
        & (F.col("_amounts.received") > 0)
        & F.col("from_account").isNotNull()
        & F.col("to_account").isNotNull()
    )


def clean_transactions(raw: DataFrame, fmt=settings.TIMESTAMP_FORMAT, strict=True) -> DataFrame:
    """Payments with positive amounts and both accounts known; one row per `tx_id`.

    A bad timestamp raises when `strict`; otherwise the row is left out here and listed by
    `rejected_transactions`.
    """
    # Exploded, so that the filter does not read the texts again: it would be moved below a plain projection, with all that makes an amount.
    amounts = F.struct(to_double("amount_paid").alias("paid"), to_double("amount_received").alias("received"))
    out = raw.withColumn("_amounts", F.explode(F.array(amounts))).filter(_usable()).select(
        "tx_id",
        parse_timestamp("timestamp", fmt, strict).alias("ts"),
        "from_bank", "from_account", "to_bank", "to_account",
        F.col("_amounts.paid").alias("amount_paid"),
        F.col("_amounts.received").alias("amount_received"),
        "receiving_currency", "payment_currency", "payment_format",
        to_label("is_laundering").alias("is_laundering"),
    )
    return out if strict else out.filter(F.col("ts").isNotNull())


def rejected_transactions(raw: DataFrame, fmt=settings.TIMESTAMP_FORMAT) -> DataFrame:
    """Raw rows that cleaning leaves out, with the first reason that applies."""
    paid, received = to_double("amount_paid"), to_double("amount_received")
    reason = (
        F.when(paid.isNull() | (paid <= 0), "amount_paid")
        .when(received.isNull() | (received <= 0), "amount_received")
        .when(F.col("from_account").isNull(), "from_account")
        .when(F.col("to_account").isNull(), "to_account")
        .when(parse_timestamp("timestamp", fmt, strict=False).isNull(), "timestamp")
    )
    return raw.withColumn("reason", reason).filter(F.col("reason").isNotNull())
