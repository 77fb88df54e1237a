"""Column expressions. All stay on the JVM side."""

from pyspark.sql import Column, functions as F

from paywatch import settings

NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def parse_timestamp(text, fmt=settings.TIMESTAMP_FORMAT, strict=True) -> Column:
    if strict:
        return F.to_timestamp_ntz(F.col(text), F.lit(fmt))
    return F.try_to_timestamp(F.col(text), F.lit(fmt)).cast("timestamp_ntz")


def to_double(text) -> Column:
    """Number or null. The pattern keeps out 'NaN', 'Infinity' and the '1.5d' that a plain cast accepts.

    No match gives '', which casts to null: the text is named once, so it is computed once.
    """
    return F.regexp_extract(F.col(text).cast("string"), NUMBER_PATTERN, 0).try_cast("double")


def to_label(value) -> Column:
    """1 for what rounds to the number 1; 0 for zero, null, junk and other numbers."""
    return flag(F.col(value).cast("string").try_cast("decimal(38,0)") == 1)


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def ratio(numerator, denominator) -> Column:
    return numerator / F.nullif(denominator, F.lit(0.0))


def day_of_week(ts) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(ts) - 1


def days_before(ts, days) -> Column:
    return ts - F.make_dt_interval(F.lit(days) if isinstance(days, int) else days)


def round_half_even(value) -> Column:
    return F.bround(value, 0).cast("bigint")


def with_calendar(df, ts="ts"):
    dow = day_of_week(F.col(ts))
    return df.withColumns({
        "tx_date": F.to_date(ts),
        "hour_of_day": F.hour(ts),
        "day_of_week": dow,
        "is_weekend": flag(dow.isin(0, 6)),
        "same_bank": flag(F.col("from_bank") == F.col("to_bank")),
    })


def with_amount_flags(df, large=settings.LARGE_AMOUNT, step=settings.ROUNDED_STEP):
    return df.withColumns({
        "log_amount": F.ln("amount_paid"),
        "is_large_txn": flag(F.col("amount_paid") >= large),
        "is_rounded_amount": flag(F.col("amount_paid") % step == 0),
        "currencies_different": flag(F.col("receiving_currency") != F.col("payment_currency")),
    })


def with_ratios(df):
    """Amount against the account's own recent behaviour; needs the 7-day columns and `prev_amount_paid`."""
    paid = F.col("amount_paid")
    mean, std, prev = (F.col(c) for c in ("avg_txn_amount_7d_from", "txn_amount_std_7d_from", "prev_amount_paid"))
    return df.withColumns({
        "amount_vs_7d_avg_ratio": ratio(paid, mean),
        "amount_zscore_7d_from": ratio(paid - mean, std),
        "pct_change_vs_prev": ratio(paid - prev, prev),
        "txn_velocity_7d_from": F.col("txn_count_7d_from").cast("double") / 7,
    })
