"""Reproducible pseudo-random order: md5 of the payment id and a seed, independent of partitioning."""

from pyspark.sql import Column, functions as F


def hash_order(tx_id="tx_id", seed=42) -> Column:
    return F.md5(F.concat(F.col(tx_id).cast("string"), F.lit(f":{seed}")))


def below_fraction(fraction, tx_id="tx_id", seed=42) -> Column:
    """True for a stable `fraction` of the ids."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(hash_order(tx_id, seed), 1, 8) < F.lit("%08x" % int(fraction * 2**32))
