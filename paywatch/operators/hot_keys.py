"""Finding accounts too busy for one window task, and keying their rows so they spread."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from paywatch import settings
from paywatch.functions.arrays import count_not_above
from paywatch.session import stage

SAMPLE_PER_BLOCK = 64


@dataclass(frozen=True)
class HotKeys:
    """Accounts whose rows are spread over slots: minutes, or id ranges inside very busy minutes.

    `frame` lists the accounts (at most `MAX_HOT_KEYS` rows, so it may be broadcast). `everything` means
    that list would be longer: then every account takes the spread path, which needs no list. `busy`
    holds the minutes to split and the ids at which they are cut; `short` tells that they are at most
    `MAX_HOT_KEYS`, so that list may be broadcast, too. Ids may be of any type that has an order.
    """

    keys: tuple
    frame: DataFrame | None = None
    everything: bool = False
    busy: DataFrame | None = None
    short: bool = True

    def __bool__(self):
        return self.everything or self.frame is not None

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of the hot accounts."""
        if self.everything:
            return df
        return df.join(F.broadcast(renamed(self.frame, self.keys)), null_safe_match(self.keys), "left_semi")

    def with_slot(self, df: DataFrame) -> DataFrame:
        """Adds `_slot`: null for ordinary accounts, else (minute, block). Slots order like (ts, tx_id)."""
        columns = df.columns
        if self.everything:
            hot = F.lit(True)
        else:
            marked = renamed(self.frame, self.keys).withColumn("_hot", F.lit(True))
            df, hot = df.join(F.broadcast(marked), null_safe_match(self.keys), "left"), F.col("_hot")
        block = F.lit(0).cast("bigint")
        if self.busy is not None:
            at = [*self.keys, "ts"]
            busy = renamed(self.busy, at, "_b_")
            df = df.join(F.broadcast(busy) if self.short else busy, null_safe_match(at, "_b_"), "left")
            block = F.coalesce(count_not_above(F.col("cuts"), F.col("tx_id")).cast("bigint"), block)
        slot = F.when(hot, F.struct(F.col("ts").alias("minute"), block.alias("block")))
        return df.withColumn("_slot", slot).select(*columns, "_slot")

    def group(self):
        """The window partition: (bank, account, slot). A struct compares null banks as equal."""
        return F.struct(*self.keys, "_slot")

    def with_busy_minutes(self, tx: DataFrame, max_rows=settings.HOT_KEY_ROWS, max_minutes=settings.MAX_HOT_KEYS):
        """Looks for minutes of hot accounts with more than `max_rows` rows and cuts them at ids into blocks of about that
        size. Cuts are quantiles of the `SAMPLE_PER_BLOCK` ids per block whose hashes fall into a range, so they follow
        the ids whatever gaps these have, and the sample of a minute is a small share of its rows.
        """
        if not self:
            return self
        at = [*self.keys, "ts"]
        rows = self.only(tx.select("tx_id", *at))
        minutes = rows.groupBy(*at).agg(F.count("*").alias("n")).filter(F.col("n") > max_rows)
        minutes = stage(minutes.withColumn("blocks", F.ceil(F.col("n") / F.lit(max_rows))), "busy_minutes")
        found = minutes.count()
        if not found:
            return self
        short = found <= max_minutes
        listed = renamed(minutes, at, "_b_")
        sample = rows.join(F.broadcast(listed) if short else listed, null_safe_match(at, "_b_"))
        chosen = F.pmod(F.xxhash64("tx_id"), F.col("n")) < SAMPLE_PER_BLOCK * F.col("blocks")
        sample = sample.filter(chosen).groupBy(*at).agg(
            F.sort_array(F.collect_list("tx_id")).alias("ids"), F.first("blocks").alias("blocks"))
        parts = F.sequence(F.lit(1).cast("bigint"), F.greatest(F.col("blocks") - 1, F.lit(1)))
        cuts = F.transform(parts, lambda i: F.get("ids", F.floor(F.size("ids") * i / F.col("blocks")).cast("int")))
        return replace(self, busy=stage(sample.select(*at, cuts.alias("cuts")), "busy_cuts"), short=short)


def renamed(df, keys, prefix="_k_"):
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def null_safe_match(keys, prefix="_k_"):
    condition = F.lit(True)
    for k in keys:
        condition &= F.col(k).eqNullSafe(F.col(prefix + k))
    return condition


def account_load(tx: DataFrame, keys) -> DataFrame:
    """Rows per account."""
    return tx.groupBy(*keys).agg(F.count("*").alias("rows"))


def busiest_accounts(tx: DataFrame, keys, n=100) -> DataFrame:
    """Skew report: the n accounts with most rows."""
    return account_load(tx, keys).orderBy(F.desc("rows"), *keys).limit(n)


def find_hot_keys(tx: DataFrame, keys, min_rows=settings.HOT_KEY_ROWS, max_keys=settings.MAX_HOT_KEYS) -> HotKeys:
    """Counts rows per account (two columns, combined map-side) and brings back a bounded list.

    The limit only tells a short list from a long one; no account loses its treatment through it.
    """
    listed = account_load(tx, keys).filter(F.col("rows") > min_rows).select(*keys).limit(max_keys + 1)
    return _from_rows(tx, keys, listed.collect(), max_keys)


def find_hot_sides(tx: DataFrame, from_keys, to_keys, min_rows=settings.HOT_KEY_ROWS, max_keys=settings.MAX_HOT_KEYS):
    """(paying, receiving) hot accounts from one pass over the payments."""
    sides = F.array(*[
        F.struct(F.lit(i).alias("side"), *[F.col(k).alias(f"k{j}") for j, k in enumerate(keys)])
        for i, keys in enumerate((from_keys, to_keys))
    ])
    names = [f"k{j}" for j in range(len(from_keys))]
    busy = tx.select(F.inline(sides)).groupBy("side", *names).agg(F.count("*").alias("rows"))
    rows = busy.filter(F.col("rows") > min_rows).select("side", *names).limit(2 * max_keys + 1).collect()
    if len(rows) > 2 * max_keys:
        return HotKeys(tuple(from_keys), everything=True), HotKeys(tuple(to_keys), everything=True)
    return tuple(
        _from_rows(tx, keys, [tuple(r)[1:] for r in rows if r["side"] == i], max_keys)
        for i, keys in enumerate((from_keys, to_keys))
    )


def _from_rows(tx, keys, rows, max_keys) -> HotKeys:
    keys = tuple(keys)
    if not rows:
        return HotKeys(keys)
    if len(rows) > max_keys:
        return HotKeys(keys, everything=True)
    return HotKeys(keys, frame=tx.sparkSession.createDataFrame(rows, tx.select(*keys).schema))
