"""Distinct counts that don't see the future: how many different counterparties an account has had up to and including each payment.

Ordinary accounts mark the first payment of each value and add the marks up in one window. A hot account's first payments are found by
an aggregate that combines map-side, counted by slot (see `hot_keys`) and added up over slots; rows only add the marks of their own
slot, so no task holds an account.
"""

from pyspark.sql import DataFrame, Window, functions as F

from paywatch.columns import FROM_KEYS, TO_KEYS
from paywatch.operators.hot_keys import HotKeys, find_hot_keys, null_safe_match, renamed
from paywatch.session import stage


def _running(mark, keys):
    order = Window.partitionBy(*keys).orderBy("ts", "tx_id").rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(mark.cast("bigint")).over(order)


def distinct_asof(tx: DataFrame, keys, value: str, name: str, hot: HotKeys | None = None) -> DataFrame:
    """Adds `name`: different non-null values of `value` among the account's payments up to this one by (ts, tx_id).

    Null keys are an account of their own. `tx_id` must be unique. Without `hot` busy accounts are counted first.
    """
    keys = list(keys)
    hot = find_hot_keys(tx, keys) if hot is None else hot

    def first_of(group):
        return (F.row_number().over(Window.partitionBy(*group, value).orderBy("ts", "tx_id")) == 1) & F.col(value).isNotNull()

    if not hot:
        return tx.withColumn("_first", first_of(keys)).withColumn(name, _running(F.col("_first"), keys)).drop("_first")

    narrow = stage(hot.only(tx.select("tx_id", "ts", *keys, value)), "asof_rows")
    hot = hot.with_busy_minutes(narrow) if hot.busy is None else hot
    firsts = hot.with_slot(narrow).where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.min(F.struct("_slot", "tx_id")).alias("_at"))
    firsts = stage(firsts.select(*keys, value, "_at._slot", F.col("_at.tx_id").alias("_first_id")), "asof_firsts")
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    history = narrow.select("ts", "tx_id", *keys)
    slots = hot.with_slot(history).select(*keys, "_slot").distinct()
    new = renamed(firsts.groupBy(*keys, "_slot").agg(F.count("*").alias("_new")), [*keys, "_slot"])
    slots = slots.join(new, null_safe_match([*keys, "_slot"]), "left").drop(*[f"_k_{k}" for k in [*keys, "_slot"]])
    slots = slots.withColumn("_earlier", F.coalesce(F.sum("_new").over(before), F.lit(0))).drop("_new")

    rows = hot.with_slot(tx)
    # A plain equality on the slot: ordinary accounts (null slot) match nothing.
    marks = renamed(firsts, [*keys, value, "_slot"])
    rows = rows.join(marks, null_safe_match([*keys, value]) & (F.col("_slot") == F.col("_k__slot")), "left")
    rows = rows.drop(*[f"_k_{k}" for k in [*keys, value, "_slot"]])
    group = [*keys, "_slot"]
    own = F.when(F.col("_slot").isNull(), first_of(group)).otherwise(F.coalesce(F.col("tx_id") == F.col("_first_id"), F.lit(False)))
    rows = rows.withColumn("_first", own).withColumn("_own", _running(F.col("_first"), group))
    rows = rows.join(renamed(slots, [*keys, "_slot"]), null_safe_match(keys) & (F.col("_slot") == F.col("_k__slot")), "left")
    total = F.col("_own") + F.coalesce("_earlier", F.lit(0))
    return rows.withColumn(name, total).select(*tx.columns, name)


def receivers_asof(tx: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Different accounts that the payer has paid so far."""
    return distinct_asof(tx, FROM_KEYS, "to_account", "num_receivers_so_far", hot)


def senders_asof(tx: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Different accounts that have paid into the receiver so far."""
    return distinct_asof(tx, TO_KEYS, "from_account", "num_senders_so_far", hot)
