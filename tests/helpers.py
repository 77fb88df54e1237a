"""Small hand-made inputs."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

COLUMNS = ("tx_id bigint, ts timestamp_ntz, from_bank int, from_account bigint, to_bank int, to_account bigint, "
           "amount_paid double, amount_received double, receiving_currency string, payment_currency string, "
           "payment_format string, is_laundering int")
START = datetime(2024, 1, 1)


def payment(tx_id, minute, from_account=1, to_account=2, amount=10.0, from_bank=1, to_bank=2, label=0):
    return (tx_id, START + timedelta(minutes=minute), from_bank, from_account, to_bank, to_account,
            float(amount), float(amount), "Euro", "Euro", "wire", label)


def payments(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def skewed_payments(spark, n=3000, seed=7):
    """A third of all rows pay from one account and a third pay into one, many in the same minute."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        hot_from, hot_to = draw.random() < 0.34, draw.random() < 0.34
        rows.append(payment(
            i, draw.randrange(0, 60 * 24 * 25, 240 if draw.random() < 0.5 else 1),
            1 if hot_from else draw.randrange(2, 80), 1 if hot_to else draw.randrange(2, 60),
            draw.choice([123.45, 123.45, 5000.0, round(draw.uniform(1, 9e4), 2)]),
            1 if hot_from else draw.choice([1, 2, None]), 1 if hot_to else draw.choice([1, 2, 3, None]),
            int(draw.random() < 0.05)))
    return payments(spark, rows).repartition(5, F.rand(seed))


def rows_by_id(df, *columns):
    return {r["tx_id"]: tuple(r[c] for c in columns) for r in df.select("tx_id", *columns).collect()}
