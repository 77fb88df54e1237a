import re

import pytest

from paywatch.functions.scalars import to_double, to_label
from paywatch.operators.cleaning import clean_transactions, rejected_transactions, with_payment_ids
from paywatch.operators.enrichment import enrich, entity_account_counts
from paywatch.sources import event_payments as source
from tests.helpers import payment, payments

RAW = ("tx_id bigint, timestamp string, from_bank int, from_account bigint, to_bank int, to_account bigint, "
       "amount_paid string, amount_received string, receiving_currency string, payment_currency string, "
       "payment_format string, is_laundering string")


def raw(spark, *rows):
    full = [(i, t, 1, f, 2, g, p, r, "Euro", "Euro", "wire", "0") for i, (t, f, g, p, r) in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


def test_label_table(spark):
    df = spark.createDataFrame([(None,), ("0",), ("1",), ("0.6",), ("x",), ("2",), ("0.4",), (" 1 ",)], "v string")
    assert [r[0] for r in df.select(to_label("v")).collect()] == [0, 0, 1, 1, 0, 0, 0, 1]


def test_numbers(spark):
    texts = ["1", "1.5", " 2.5e3 ", ".5", "-3", "1.5d", "2f", "NaN", "Infinity", "n/a", "", None, "1,5", "0x1p3"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    found = [r[0] for r in df.select(to_double("v")).collect()]
    assert found == [1.0, 1.5, 2500.0, 0.5, -3.0] + [None] * 9


def test_unusable_rows_are_left_out_and_listed(spark):
    good = "2024/01/01 10:00"
    df = raw(spark, (good, 1, 2, "5", "5"), (good, 1, 2, "0", "5"), (good, 1, 2, "5", "x"), (good, None, 2, "5", "5"),
             (good, 1, None, "5", "5"), ("2024-01-01", 1, 2, "5", "5"))
    assert [r["tx_id"] for r in clean_transactions(df, strict=False).collect()] == [0]
    assert {r["tx_id"]: r["reason"] for r in rejected_transactions(df).collect()} == {
        1: "amount_paid", 2: "amount_received", 3: "from_account", 4: "to_account", 5: "timestamp"}


def test_bad_timestamp_raises_when_strict(spark):
    with pytest.raises(Exception, match="(?i)parse|timestamp"):
        clean_transactions(raw(spark, ("2024-01-01", 1, 2, "5", "5"))).collect()


def test_duplicate_accounts_do_not_multiply_payments(spark):
    accounts = spark.createDataFrame(
        [(1, 1, 7, "E7", "B1"), (1, 1, 3, "E3", "B1"), (1, 1, None, "none", "B1"), (2, 2, 3, "E3", "B2"), (2, 9, 3, "E3", "B2")],
        "bank_id int, account_number bigint, entity_id bigint, entity_name string, bank_name string")
    out = enrich(payments(spark, [payment(0, 0), payment(1, 1, from_bank=None), payment(2, 2, to_account=5)]), accounts)
    rows = {r["tx_id"]: r for r in out.collect()}
    assert len(rows) == 3 and out.count() == 3
    assert (rows[0]["from_entity_id"], rows[0]["from_entity_name"], rows[0]["to_entity_id"]) == (3, "E3", 3)
    assert rows[0]["from_num_accounts_per_entity"] == 3
    assert rows[1]["from_entity_id"] is None and rows[2]["to_entity_id"] is None
    assert {r[0]: r[1] for r in entity_account_counts(accounts).collect()}[3] == 3


def test_missing_ids_are_made_once(spark):
    df = raw(spark, *[("2024/01/01 10:00", 1, 2, "5", "5")] * 20).drop("tx_id").repartition(4)
    out = with_payment_ids(df)
    first, again = (sorted(r["tx_id"] for r in out.select("tx_id").collect()) for _ in range(2))
    assert first == again and len(set(first)) == 20
    assert with_payment_ids(out) is out


def test_amounts_are_read_once(spark):
    text = clean_transactions(source.raw_transactions(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("regexp_extract", text)) == 2
