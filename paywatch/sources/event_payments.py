"""Raw payment and account tables derived from the `events`, `customer` and `nation` parquet tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

DUPLICATE_ID_SHIFT = 10**9


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One raw payment per event: text timestamps, amounts and labels, with junk in known places."""
    read = spark.read.parquet
    # Exploded, so that `k` is a column: filters on amounts and accounts would else parse `props` again wherever they name it.
    parsed = F.array(F.get_json_object("props", "$.k").cast("bigint"))
    events = read(f"{folder}/events.parquet").withColumn("k", F.explode(parsed))
    customer = read(f"{folder}/customer.parquet").select("c_custkey", "c_nationkey")
    payer = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("from_bank"))
    payee = customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("to_bank"))

    k, value, kind = F.col("k"), F.col("value"), F.col("event_type")
    paid = (
        F.when(k % 50 == 49, "n/a")
        .when(kind == "signup", "5000.0")
        .when(k % 10 == 0, ((F.floor(value) + 1) * 1000).cast("double").cast("string"))
        .otherwise((value * 1000).cast("string"))
    )
    received = F.when(kind == "view", value * 900).otherwise(value * 1000 + 1).cast("string")
    currency = F.element_at(
        F.array(F.lit("US Dollar"), F.lit("Euro"), F.lit("Yuan")), (F.col("user_id") % 3 + 1).cast("int")
    )
    label = (
        F.when((kind == "error") & (value > 150), "1")
        .when(k == 13, None)
        .when(k == 14, "x")
        .otherwise("0")
    )
    return (
        events.join(payer, "user_id", "left")
        .join(payee, "k", "left")
        .select(
            F.col("event_id").alias("tx_id"),
            F.date_format("ts", "yyyy/MM/dd HH:mm").alias("timestamp"),
            "from_bank",
            F.col("user_id").alias("from_account"),
            "to_bank",
            F.when(k != 98, k).alias("to_account"),
            paid.alias("amount_paid"),
            received.alias("amount_received"),
            F.when(k % 4 == 0, "Euro").otherwise(currency).alias("receiving_currency"),
            currency.alias("payment_currency"),
            kind.alias("payment_format"),
            label.alias("is_laundering"),
        )
    )


def raw_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Account master data; every 17th customer is left out so that some lookups miss."""
    read = spark.read.parquet
    nation = read(f"{folder}/nation.parquet").select("n_nationkey", "n_name")
    entity = F.floor(F.col("c_custkey") / 3).cast("bigint")
    return (
        read(f"{folder}/customer.parquet")
        .filter(F.col("c_custkey") % 17 != 0)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_nationkey").alias("bank_id"),
            F.col("c_custkey").alias("account_number"),
            entity.alias("entity_id"),
            F.concat(F.lit("Entity "), entity.cast("string")).alias("entity_name"),
            F.col("n_name").alias("bank_name"),
        )
    )


def with_duplicate_payments(tx: DataFrame) -> DataFrame:
    """Adds every 200th payment again under another id."""
    copies = tx.filter(F.col("tx_id") % 200 == 0).withColumn("tx_id", F.col("tx_id") + DUPLICATE_ID_SHIFT)
    return tx.unionByName(copies)


def with_duplicate_accounts(accounts: DataFrame) -> DataFrame:
    copies = accounts.filter(F.col("account_number") % 50 == 1).withColumn("entity_id", F.col("entity_id") + 10**6)
    return accounts.unionByName(copies)


def synthetic_scores(tx: DataFrame, amount="amount_paid", keep=()) -> DataFrame:
    """A score with ties that rises with the amount: a metric input that needs no model."""
    p = F.col(amount)
    return tx.select(
        "tx_id", *keep,
        F.col("is_laundering").alias("label"),
        (F.floor(p / (p + 50000) * 1000) / 1000.0).cast("double").alias("score"),
    )
