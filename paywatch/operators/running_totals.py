"""Cumulative sums along a sorted column without sorting everything in one task."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from paywatch.functions.arrays import count_not_above

MOST_BUCKETS = 1024


def running_totals(df: DataFrame, order: str, values, by=(), descending=False, buckets=None) -> DataFrame:
    """Adds `cum_<v>` (sum up to and including the row) and `total_<v>` for each v in `values`.

    Needs one row per (by, order), so group first. Range buckets with about equally many rows come
    from approximate quantiles of `order` within each group; sums run inside each bucket in parallel and
    the sums of earlier buckets, at most `buckets` rows per group, are added. There are as many buckets as
    shuffle partitions unless told otherwise, but no more than MOST_BUCKETS: sketches, edges and sums stay small however
    many partitions there are, and a task sorts a thousandth of a group's different values. A column with one
    heavy stretch of values still splits evenly, since edges follow the rows. Groups in `by` must be few
    (models, windows).
    """
    by = list(by)
    buckets = buckets or min(MOST_BUCKETS, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    shares = [i / buckets for i in range(1, buckets)]
    sketch = F.percentile_approx(order, shares, 100 * buckets)
    if by:
        edges = df.groupBy(*by).agg(sketch.alias("_edges"))
        edges = edges.withColumnsRenamed({c: f"_of_{c}" for c in by})
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by])
        df = df.join(F.broadcast(edges), same).drop(*[f"_of_{c}" for c in by])
    else:
        df = df.withColumn("_edges", df.agg(sketch).scalar())
    # Never null: otherwise the join below would test the bucket of every input row for null.
    bucket = F.coalesce(count_not_above(F.col("_edges"), F.col(order)), F.lit(0))
    df = df.withColumn("_bucket", bucket).drop("_edges")

    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, "_bucket").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({f"cum_{v}": F.sum(v).over(inside) for v in values})

    sums = df.groupBy(*by, "_bucket").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    bucket = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({
        **{f"_before_{v}": F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)) for v in values},
        **{f"total_{v}": F.sum(f"_{v}").over(group) for v in values},
    }).drop(*[f"_{v}" for v in values])
    out = out.join(sums, [*by, "_bucket"])
    out = out.withColumns({f"cum_{v}": F.col(f"cum_{v}") + F.col(f"_before_{v}") for v in values})
    return out.drop("_bucket", *[f"_before_{v}" for v in values])
