"""Helpers shared by the text operators."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paywatch.session import package_on_workers


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


BATCH = 8 << 20  # bytes of rows sent to a worker at a time, about: the executor holds them several times


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder. Arrow batches are limited by their bytes, too, unless the session says how."""
    package_on_workers(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def buckets(spark: SparkSession, each: int, most: int = 4096) -> int:
    """How many buckets of a hash or range: `each` for a shuffle partition, but no more than `most`, for they are listed in one place."""
    return max(2, min(most, each * int(spark.conf.get("spark.sql.shuffle.partitions"))))


HOT_ROWS, HOT_BUCKETS = 20_000, 4096


def join_hot(rows: DataFrame, names: DataFrame, keys: list, copies: str = "copies", per_task: int = HOT_ROWS) -> DataFrame:
    """`rows` inner joined to `names` on `keys`, which are not null and say in `copies` how many rows each has, about.

    Keys with more than `per_task` rows are dealt over as many places as they need, so no key is one task's work. Which
    those are travels as a broadcast of one number for each of at most HOT_BUCKETS hash values of the keys. `names` is
    read twice, so it should be staged.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HOT_BUCKETS)).cast("int")
    hot = names.where(F.col(copies) > per_task).groupBy(bucket.alias("_bucket")).agg(
        F.max(F.ceil(F.col(copies) / per_task)).cast("int").alias("_parts"))
    dealt = lambda df: df.withColumn("_bucket", bucket).join(F.broadcast(hot), "_bucket", "left").withColumn(
        "_parts", F.coalesce("_parts", F.lit(1)))
    rows = dealt(rows).withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int"))
    names = dealt(names).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return rows.drop("_bucket", "_parts").join(names.drop("_bucket", "_parts"), [*keys, "_part"]).drop("_part")


def slices(batches, column: str, limit: int = 4 << 20):
    """Zero-copy pieces of record batches with at most `limit` bytes (of lists: elements) in `column` (one row at least), so that
    working memory doesn't depend on how many rows, or how long texts, a batch holds."""
    for batch in batches:
        values = batch.column(column)
        sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the row borders in them; null counts as empty."""
    column = pc.fill_null(column, "")
    borders = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[borders[0]:borders[-1]], (borders - borders[0]).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
