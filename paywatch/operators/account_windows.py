"""Behaviour of the paying and the receiving account up to each payment.

Ordinary accounts: plain windows per account, all on one shuffle. Time frames are RANGE frames, so
payments of the same minute count as peers; order-sensitive values break ties by `tx_id`.

Hot accounts: their rows are grouped per slot instead, a minute or an id range of a very busy minute
(see `hot_keys`). What the windows cannot see from inside a slot comes from a per-slot frame
(`slot_history`), whose size is limited by the minutes covered, not by the rows. It joins on the very
grouping the rows are shuffled by.
"""

from pyspark.sql import DataFrame, Window, functions as F

from paywatch import settings
from paywatch.columns import FROM_KEYS, TO_KEYS
from paywatch.functions.scalars import flag, seconds_between
from paywatch.operators.hot_keys import HotKeys, find_hot_keys, null_safe_match, renamed
from paywatch.session import stage

def over_range(aggregate: str, keys, span: str):
    """`aggregate` over the account's rows from `span` ago up to and including the current minute."""
    return F.expr(
        f"{aggregate} over (partition by {', '.join(keys)} order by ts "
        f"range between interval {span} preceding and current row)"
    )


def _similar(amount, previous):
    return F.coalesce(F.abs(amount - previous) <= settings.SIMILAR_AMOUNT_TOLERANCE, F.lit(False))


# ---- ordinary accounts ------------------------------------------------------------------------

def with_previous(tx: DataFrame, keys) -> DataFrame:
    """Gap to, and amount of, the account's previous payment; first payment of the calendar day."""
    order = Window.partitionBy(*keys).orderBy("ts", "tx_id")
    out = tx.withColumns({
        "_previous_ts": F.lag("ts").over(order),
        "prev_amount_paid": F.lag("amount_paid").over(order),
    })
    new_day = F.col("_previous_ts").isNull() | (F.to_date("_previous_ts") < F.to_date("ts"))
    return out.withColumns({
        "time_since_last_txn_from": seconds_between(F.col("_previous_ts"), F.col("ts")),
        "first_txn_of_day_from": flag(new_day),
    }).drop("_previous_ts")


def with_rolling(tx: DataFrame, keys) -> DataFrame:
    """1-hour, 24-hour and 7-day frames over the account's payments."""
    hour, day, week = "'1' hour", "'24' hour", "'7' day"
    tx = tx.withColumns({
        "_similar": flag(_similar(F.col("amount_paid"), F.col("prev_amount_paid"))).cast("bigint"),
        "_cross": flag(F.col("from_bank") != F.col("to_bank")).cast("bigint"),
    })
    return tx.withColumns({
        "txn_count_1h_from": over_range("count(1)", keys, hour),
        "txn_count_24h_from": over_range("count(1)", keys, day),
        "txn_count_7d_from": over_range("count(1)", keys, week),
        "txn_amount_sum_24h_from": over_range("sum(amount_paid)", keys, day),
        "avg_txn_amount_7d_from": over_range("avg(amount_paid)", keys, week),
        "max_txn_amount_7d_from": over_range("max(amount_paid)", keys, week),
        "txn_amount_std_7d_from": over_range("stddev_samp(amount_paid)", keys, week),
        "cross_bank_ratio_7d": over_range("avg(_cross)", keys, week),
        "txn_gap_std_7d": over_range("stddev_samp(time_since_last_txn_from)", keys, week),
        "num_similar_amount_txns_24h": over_range("sum(_similar)", keys, day),
    }).drop("_similar", "_cross")


def with_counterparties(tx: DataFrame, keys) -> DataFrame:
    """How often the account paid this counterparty before; lifetime receivers and banks (leaky).

    Distinct counts add up a mark on one row per value. Banks come first and receivers directly
    below counterparties, because (keys, to_account, to_bank) then is one sort for both.
    """
    bank = Window.partitionBy(*keys, "to_bank").orderBy("ts", "tx_id")
    receiver = Window.partitionBy(*keys, "to_account").orderBy("to_bank", "ts", "tx_id")
    pair = Window.partitionBy(*keys, "to_account", "to_bank").orderBy("ts", "tx_id")
    account = Window.partitionBy(*keys)
    out = tx.withColumn("_bank", (F.row_number().over(bank) == 1) & F.col("to_bank").isNotNull())
    out = out.withColumn("_receiver", (F.row_number().over(receiver) == 1) & F.col("to_account").isNotNull())
    out = out.withColumn("repeat_counterparty_count", F.row_number().over(pair).cast("bigint") - 1)
    return out.withColumns({
        "num_unique_receivers": F.sum(F.col("_receiver").cast("bigint")).over(account),
        "num_unique_banks": F.sum(F.col("_bank").cast("bigint")).over(account),
    }).drop("_receiver", "_bank")


def with_incoming(tx: DataFrame, keys) -> DataFrame:
    """Gap to the previous payment into the account; lifetime senders (leaky)."""
    order = Window.partitionBy(*keys).orderBy("ts", "tx_id")
    sender = Window.partitionBy(*keys, "from_account").orderBy("ts", "tx_id")
    out = tx.withColumns({
        "time_since_last_txn_to": seconds_between(F.lag("ts").over(order), F.col("ts")),
        "_sender": (F.row_number().over(sender) == 1) & F.col("from_account").isNotNull(),
    })
    total = F.sum(F.col("_sender").cast("bigint")).over(Window.partitionBy(*keys))
    return out.withColumn("num_unique_senders", total).drop("_sender")


# ---- hot accounts: per-slot history -----------------------------------------------------------

def slot_history(hot: DataFrame, keys) -> DataFrame:
    """One row per (account, slot) with everything that looks beyond that slot.

    Steps: aggregate per slot; look one slot back per account; sum slots to minutes; run the frames
    over minutes.
    """
    paid = F.col("amount_paid")
    inside = Window.partitionBy(*keys, "_slot").orderBy("tx_id")
    marked = hot.withColumn("_similar", flag(_similar(paid, F.lag("amount_paid").over(inside))))
    slots = marked.groupBy(*keys, "ts", "_slot").agg(
        F.count("*").alias("n"),
        F.avg(paid).alias("mean"),
        F.coalesce(F.var_pop(paid), F.lit(0.0)).alias("variance"),
        F.sum(paid).alias("total"),
        F.min(paid).alias("low"),
        F.max(paid).alias("high"),
        F.min_by("amount_paid", "tx_id").alias("first_amount"),
        F.max_by("amount_paid", "tx_id").alias("last_amount"),
        F.sum("_similar").alias("similar"),
        F.count_if(F.col("from_bank") != F.col("to_bank")).alias("cross"),
    )

    order = Window.partitionBy(*keys).orderBy("ts", "_slot")  # a slot's minute is its `ts`: one sort, also for minutes
    slots = slots.withColumns({
        "_previous_ts": F.lag("ts").over(order), "h_prev_amount": F.lag("last_amount").over(order),
    })
    gap = seconds_between(F.col("_previous_ts"), F.col("ts"))
    slots = slots.withColumns({
        "h_gap": gap,
        "h_new_day": flag(F.col("_previous_ts").isNull() | (F.to_date("_previous_ts") < F.to_date("ts"))),
        "similar": F.col("similar") + flag(_similar(F.col("first_amount"), F.col("h_prev_amount"))),
        # Payments after the first of a slot have gap 0, so they only add to the count.
        "gaps": F.col("n") - flag(F.col("_previous_ts").isNull()),
        "gap": F.coalesce(gap, F.lit(0)).cast("decimal(19,0)"),
    })
    frames = _minute_frames(_minutes(slots, keys), keys)
    return _lookup(slots.select(*keys, "ts", "_slot", "h_gap", "h_prev_amount", "h_new_day"), frames, [*keys, "ts"])


def _minutes(slots: DataFrame, keys) -> DataFrame:
    """Sums of slots per minute. Squared deviations are taken from a centre inside the minute."""
    centre = F.avg("mean").over(Window.partitionBy(*keys, "ts"))
    n, shift = F.col("n"), F.col("_shift")
    return slots.withColumn("_centre", centre).withColumn("_shift", F.col("mean") - F.col("_centre")).groupBy(*keys, "ts").agg(
        F.sum(n).alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("similar").alias("similar"), F.sum("cross").alias("cross"),
        F.sum("gaps").alias("gaps"), F.sum("gap").cast("decimal(19,0)").alias("gap"),
        (F.first("_centre") + F.sum(n * shift) / F.sum(n)).alias("mean"),
        (F.sum(n * (F.col("variance") + shift * shift)) - F.sum(n * shift) * F.sum(n * shift) / F.sum(n)).alias("_m2"),
    )


FRAMES = {  # name: (aggregate, value, days)
    "h_count_24h": (F.sum, "n", 1), "h_sum_24h": (F.sum, "total", 1), "h_similar": (F.sum, "similar", 1),
    "h_count_7d": (F.sum, "n", 7), "_sum_7d": (F.sum, "total", 7), "_cross_7d": (F.sum, "cross", 7),
    "h_max_7d": (F.max, "high", 7), "_min_7d": (F.min, "low", 7),
    "_s1": (F.sum, "_d1", 7), "_s2": (F.sum, "_d2", 7),
    "_g0": (F.sum, "gaps", 7), "_g1": (F.sum, "gap", 7), "_g2": (F.sum, "_gap2", 7),
}


def _minute_frames(minutes: DataFrame, keys) -> DataFrame:
    """24-hour and 7-day frames without sliding, in time linear in the minutes.

    A frame that ends in a week reaches back into the week before only. So each week of an account gets
    its own minutes (kind 0) and those of the week before, moved on by 7 days (kind 7): the frame of a
    minute is the running total of kind 0 up to it plus the running total, from the end, of kind 7 down
    to it. Days work alike with kind 1. No value is subtracted again, so nothing cancels, and one window
    group holds at most the minutes of two weeks.

    The copies are dealt out by week, so tasks are as large as the copies, not as the minutes behind them, and
    the weeks of an account spread. They are sorted twice, on and back, each time by day and minute, which is one
    order for weeks and days; a total takes the place of its value, so rows don't grow on the way.
    """
    hourly = minutes.withColumn("h_count_1h", over_range("sum(n)", keys, "'1' hour"))  # at most 61 minutes back
    spread = hourly.withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1), F.lit(7))))
    at = F.col("ts") + F.make_dt_interval("_kind")
    day = F.datediff(at, F.lit("1970-01-01").cast("date"))
    week = [*keys, "_week"]
    spread = spread.select(
        *keys, "_kind", at.alias("_at"), day.alias("_day"), F.floor(day / 7).cast("int").alias("_week"), "h_count_1h",
        "n", "total", "low", "high", "similar", "cross", "gaps", "gap", "mean", "_m2").repartition(*week)

    first = [F.col("_day").asc(), F.col("_at").asc()]
    whole = Window.partitionBy(*week).orderBy(*first).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Deviations are taken from a common centre of the week: squares of raw amounts would cancel badly.
    spread = spread.withColumn("_d", F.col("mean") - F.avg("mean").over(whole)).withColumns({
        "_d1": F.col("n") * F.col("_d"),
        "_d2": F.col("_m2") + F.col("n") * F.col("_d") * F.col("_d"),
        "_gap2": F.col("gap") * F.col("gap"),
    }).select(*week, "_kind", "_at", "_day", (-F.col("_day")).alias("_back"), "h_count_1h", *[
        F.col(value).alias(name) for name, (_, value, _) in FRAMES.items()])

    onward = {1: Window.partitionBy(*week, "_day").orderBy("_at"), 7: Window.partitionBy(*week).orderBy(*first)}
    own = F.col("_kind") == 0
    spread = spread.withColumns({
        name: F.when(own, f(F.when(own, F.col(name))).over(onward[days])).otherwise(F.col(name))
        for name, (f, _, days) in FRAMES.items()}).drop("_day")

    last = F.col("_at").desc()
    back = {1: Window.partitionBy(*week, "_back").orderBy(last), 7: Window.partitionBy(*week).orderBy("_back", last)}
    earlier = {name: f(F.when(F.col("_kind") == days, F.col(name))).over(back[days]) for name, (f, _, days) in FRAMES.items()}
    joined = {F.max: F.greatest, F.min: F.least}
    spread = spread.withColumns({
        name: joined[f](F.col(name), earlier[name]) if f in joined else F.col(name) + F.coalesce(earlier[name], F.lit(0))
        for name, (f, _, _) in FRAMES.items()
    }).filter(own).withColumnRenamed("_at", "ts")

    n, g0 = F.col("h_count_7d").cast("double"), F.col("_g0")
    spread_amount = F.greatest(F.col("_s2") - F.col("_s1") * F.col("_s1") / n, F.lit(0.0))
    # Whole seconds: exact in decimals, so equal gaps give exactly 0.
    g1 = F.col("_g1").cast("decimal(19,0)")
    spread_gap = (F.col("_g2").cast("decimal(38,0)") * g0.cast("decimal(12,0)") - g1 * g1).cast("double")
    return spread.select(
        *keys, "ts", "h_count_1h", "h_count_24h", "h_count_7d", "h_sum_24h", "h_max_7d", "h_similar",
        (F.col("_sum_7d") / n).alias("h_avg_7d"),
        (F.col("_cross_7d") / n).alias("h_cross"),
        F.when(n > 1, F.when(F.col("_min_7d") == F.col("h_max_7d"), 0.0)
               .otherwise(F.sqrt(spread_amount / (n - 1)))).alias("h_std_7d"),
        F.when(g0 > 1, F.sqrt(spread_gap / (g0.cast("double") * (g0 - 1)))).alias("h_gap_std"),
    )


def _distinct_per_account(hot: DataFrame, keys, value, name) -> DataFrame:
    """Two-step distinct count: no group holds more than one row per distinct value."""
    return hot.groupBy(*keys).agg(F.count_distinct(value).alias(name))


def _lookup(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Left join on keys where null equals null."""
    return df.join(renamed(other, keys), null_safe_match(keys), "left").drop(*[f"_k_{k}" for k in keys])


def _join_history(rows: DataFrame, history: DataFrame, hot: HotKeys) -> DataFrame:
    """Joins on the struct the rows are already grouped by; ordinary accounts (null slot) match nothing."""
    keyed = history.withColumn("_group", hot.group()).drop(*hot.keys, "ts", "_slot")
    return rows.join(keyed, "_group", "left")


def _hot_rows(source: DataFrame, hot: HotKeys, columns):
    """(rows, hot): the hot accounts' rows with their slots, written once for the passes that follow."""
    rows = stage(hot.only(source.select("tx_id", "ts", *columns)), "hot_rows")
    hot = hot.with_busy_minutes(rows) if hot.busy is None else hot
    return hot.with_slot(rows), hot


def _spread_outgoing(tx: DataFrame, hot: HotKeys, lookup) -> DataFrame:
    keys = list(hot.keys)
    narrow, hot = _hot_rows(tx, hot, [*FROM_KEYS, *TO_KEYS, "amount_paid"])
    history = slot_history(narrow, keys)
    history = _lookup(history, _distinct_per_account(narrow, keys, "to_account", "h_receivers"), keys)
    history = _lookup(history, _distinct_per_account(narrow, keys, "to_bank", "h_banks"), keys)

    rows = hot.with_slot(tx).withColumn("_group", hot.group())
    rows = with_counterparties(with_rolling(with_previous(rows, ["_group"]), ["_group"]), ["_group"])
    rows = _join_history(rows, history, hot)
    first_in_slot = F.col("time_since_last_txn_from").isNull()
    is_hot = F.col("_slot").isNotNull()

    def beyond(name):
        return F.when(is_hot, F.col(name))

    def replaced(name, column):
        return F.when(is_hot, F.col(name)).otherwise(F.col(column)).alias(column)

    swaps = {
        "txn_count_1h_from": "h_count_1h", "txn_count_24h_from": "h_count_24h",
        "txn_count_7d_from": "h_count_7d", "txn_amount_sum_24h_from": "h_sum_24h",
        "avg_txn_amount_7d_from": "h_avg_7d", "max_txn_amount_7d_from": "h_max_7d",
        "txn_amount_std_7d_from": "h_std_7d", "cross_bank_ratio_7d": "h_cross",
        "txn_gap_std_7d": "h_gap_std", "num_similar_amount_txns_24h": "h_similar",
        "num_unique_receivers": "h_receivers", "num_unique_banks": "h_banks",
    }
    rows = rows.withColumns({
        **{column: replaced(name, column) for column, name in swaps.items()},
        "first_txn_of_day_from": F.when(is_hot & ~(first_in_slot & (F.col("h_new_day") == 1)), 0)
                                  .otherwise(F.col("first_txn_of_day_from")),
        "prev_amount_paid": F.when(is_hot & first_in_slot, F.col("h_prev_amount"))
                             .otherwise(F.col("prev_amount_paid")),
        "time_since_last_txn_from": F.coalesce("time_since_last_txn_from", beyond("h_gap")),
    }).drop(*[c for c in history.columns if c.startswith("h_")])
    rows = lookup(rows).drop("_group")

    # Earlier slots of the same counterparty: running counts over slots, not rows.
    pair = [*FROM_KEYS, *TO_KEYS]
    seen = narrow.groupBy(*pair, "_slot").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*pair).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("_seen", F.sum("_n").over(before)).filter("_seen > 0").drop("_n")
    # A plain equality on the slot: ordinary accounts (null slot) match nothing.
    seen = renamed(seen, [*pair, "_slot"])
    rows = rows.join(seen, null_safe_match(pair) & (F.col("_slot") == F.col("_k__slot")), "left")
    total = F.col("repeat_counterparty_count") + F.coalesce("_seen", F.lit(0))
    return rows.withColumn("repeat_counterparty_count", total).drop("_seen", "_slot", "_k__slot", *[f"_k_{k}" for k in pair])


def _spread_incoming(tx: DataFrame, hot: HotKeys, source: DataFrame, lookup) -> DataFrame:
    keys = list(hot.keys)
    narrow, hot = _hot_rows(source, hot, [*keys, "from_account"])
    slots = narrow.select(*keys, "ts", "_slot").distinct()
    previous = F.lag("ts").over(Window.partitionBy(*keys).orderBy("_slot"))
    history = slots.withColumn("h_gap", seconds_between(previous, F.col("ts")))
    history = _lookup(history, _distinct_per_account(narrow, keys, "from_account", "h_senders"), keys)

    rows = with_incoming(hot.with_slot(tx).withColumn("_group", hot.group()), ["_group"])
    rows = _join_history(rows, history, hot)
    is_hot = F.col("_slot").isNotNull()
    rows = rows.withColumns({
        "time_since_last_txn_to": F.coalesce("time_since_last_txn_to", F.when(is_hot, F.col("h_gap"))),
        "num_unique_senders": F.when(is_hot, F.col("h_senders")).otherwise(F.col("num_unique_senders")),
    }).drop("h_gap", "h_senders")
    return lookup(rows).drop("_group", "_slot")


# ---- entry points -----------------------------------------------------------------------------

def _as_they_are(rows):
    return rows


def outgoing_features(tx: DataFrame, hot: HotKeys | None = None, lookup=_as_they_are) -> DataFrame:
    """Adds the paying account's features. Unused ones are pruned by Catalyst when not selected.

    Without `hot` the busy accounts are counted first; only if there are any, their rows are written once.
    `lookup` adds the account's attributes while rows are still partitioned by the account.
    """
    hot = find_hot_keys(tx, FROM_KEYS) if hot is None else hot
    if hot:
        out = _spread_outgoing(tx, hot, lookup)
    else:
        out = lookup(with_counterparties(with_rolling(with_previous(tx, FROM_KEYS), FROM_KEYS), FROM_KEYS))
    return out.withColumn("is_new_counterparty", flag(F.col("repeat_counterparty_count") == 0))


def incoming_features(tx: DataFrame, hot: HotKeys | None = None, source: DataFrame | None = None,
                      lookup=_as_they_are) -> DataFrame:
    """Adds the receiving account's features. `source` is the plain payment table behind `tx`, when
    `tx` already carries computed columns that a history pass should not compute again."""
    source = tx if source is None else source
    hot = find_hot_keys(source, TO_KEYS) if hot is None else hot
    return _spread_incoming(tx, hot, source, lookup) if hot else lookup(with_incoming(tx, TO_KEYS))
