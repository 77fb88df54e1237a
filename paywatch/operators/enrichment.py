"""Account and entity attributes for both ends of a payment."""

from pyspark.sql import DataFrame, functions as F

from paywatch.operators.hot_keys import null_safe_match, renamed as renamed_keys


def entity_account_counts(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("entity_id").agg(F.count_distinct("account_number").alias("num_accounts_per_entity"))


def account_dimension(accounts: DataFrame) -> DataFrame:
    """One row per (bank, account) — the lowest entity id wins — with the size of its entity.

    The counts join the accounts once here, so each side of a payment needs a single lookup.
    """
    first = F.min(F.struct(F.isnull("entity_id").alias("unknown"), "entity_id", "entity_name", "bank_name"))
    unique = accounts.groupBy("bank_id", "account_number").agg(first.alias("a")).select(
        "bank_id", "account_number", "a.entity_id", "a.entity_name", "a.bank_name"
    )
    # Accounts without an entity match nothing; kept out of the join, they don't meet in one task.
    known, unknown = unique.filter(F.col("entity_id").isNotNull()), unique.filter(F.col("entity_id").isNull())
    known = known.join(entity_account_counts(accounts), "entity_id", "left")
    return known.unionByName(unknown.withColumn("num_accounts_per_entity", F.lit(None).cast("bigint")))


def with_account_side(tx: DataFrame, dimension: DataFrame, side: str, hot=None) -> DataFrame:
    """Left lookup of the `from` or `to` account. Broadcast or sort-merge is left to Spark's size checks.

    Accounts listed in `hot` bring their attributes by broadcast; their rows pass the general lookup under
    a key that matches nothing, so they spread instead of meeting in one task. Rows that still carry the `_group` of
    their windows are looked up by it and not shuffled again.
    """
    keys = [f"{side}_bank", f"{side}_account"]
    renamed = dimension.select(
        F.col("bank_id").alias(keys[0]),
        F.col("account_number").alias(keys[1]),
        F.col("entity_id").alias(f"{side}_entity_id"),
        F.col("entity_name").alias(f"{side}_entity_name"),
        F.col("bank_name").alias(f"{side}_bank_name"),
        F.col("num_accounts_per_entity").alias(f"{side}_num_accounts_per_entity"),
    )
    if hot is None or hot.frame is None:
        return tx.join(renamed, keys, "left")

    values = renamed.columns[2:]
    grouped = "_group" in tx.columns
    own = F.lit(None).cast(tx.schema["_group"].dataType["_slot"].dataType).alias("_slot") if grouped else \
        F.lit(None).cast("bigint").alias("own")
    general = renamed.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()).select(
        F.struct(*[F.col(k).cast(tx.schema[k].dataType).alias(k) for k in keys], own).alias("_key"), *values)
    listed = hot.frame.join(renamed, keys, "left").withColumnsRenamed({v: f"_{v}" for v in values})
    listed = F.broadcast(renamed_keys(listed.withColumn("_hot", F.lit(True)), keys))  # as long as the hot list
    rows = tx.join(listed, null_safe_match(keys), "left")
    cold = F.col("_hot").isNull()
    if grouped:  # hot rows have a slot there
        rows = rows.join(general, F.col("_group") == F.col("_key"), "left")
    else:
        own_key = F.struct(*[F.when(cold, F.col(k)).alias(k) for k in keys],
                           F.when(~cold, F.xxhash64("tx_id")).alias("own"))
        rows = rows.withColumn("_key", own_key).join(general, "_key", "left")
    picked = [F.when(cold, F.col(v)).otherwise(F.col(f"_{v}")).alias(v) for v in values]
    return rows.select(*tx.columns, *picked)


def enrich(tx: DataFrame, accounts: DataFrame, hot_from=None, hot_to=None) -> DataFrame:
    dimension = account_dimension(accounts)
    out = with_account_side(tx, dimension, "from", hot_from)
    return with_account_side(out, dimension, "to", hot_to)
