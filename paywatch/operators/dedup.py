"""One row per key."""

from pyspark.sql import DataFrame, functions as F

from paywatch.columns import KEYS


def dedupe_keys(df: DataFrame, keys=KEYS, tx_id="tx_id") -> DataFrame:
    """Keeps the row with the lowest id of each key (null keys group together).

    An aggregate rather than a ranking: copies collapse before the shuffle, so a key that holds
    much of the table does not fill one task.
    """
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), tx_id).alias("_row"))
    return kept.select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])
