"""Column expressions on sorted arrays."""

from pyspark.sql import Column, functions as F


def count_not_above(sorted_array: Column, value: Column) -> Column:
    """How many elements are <= value, by binary search: 32 steps at most, whatever the length."""
    def halve(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        not_above = F.get(sorted_array, middle) <= value
        open_ = s["low"] < s["high"]
        return F.struct(F.when(open_ & not_above, middle + 1).otherwise(s["low"]).alias("low"),
                        F.when(open_ & ~not_above, middle).otherwise(s["high"]).alias("high"))

    steps = F.sequence(F.lit(1), F.floor(F.log2(F.size(sorted_array) + 1)).cast("int") + 1)
    span = F.struct(F.lit(0).alias("low"), F.size(sorted_array).alias("high"))
    return F.aggregate(steps, span, halve, lambda s: s["low"])
