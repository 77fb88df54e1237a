"""Reading and writing tables by name or path."""

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from paywatch.columns import EVENT_DATE, TS

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet folder when the name holds a slash."""
    return spark.read.parquet(name) if is_folder(name) else spark.table(name)


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """SQL text over the given frames, e.g. run_sql(spark, 'select … from {tx}', tx=frame)."""
    return spark.sql(text, **views)


def is_folder(name: str) -> bool:
    return "/" in name


def overwrite_table(df: DataFrame, table: str, partition_by=(), path=None):
    """Replace a catalog table, or a parquet folder."""
    if is_folder(table):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(table)
        return
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def by_day(df: DataFrame, files_per_day=None, rows_per_file=2_000_000) -> DataFrame:
    """Rows with their day, spread over tasks so that a file holds about `rows_per_file` rows of one day (or a day has `files_per_day`
    files), sorted by time. A day's number of files follows its rows; days are few, their counts travel by broadcast."""
    out = df.withColumn(EVENT_DATE, F.to_date(TS))
    many = F.lit(files_per_day)
    if files_per_day is None:
        days = out.groupBy(EVENT_DATE).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_files"))
        days = days.withColumnRenamed(EVENT_DATE, "_day")
        out = out.join(F.broadcast(days), F.col(EVENT_DATE).eqNullSafe(F.col("_day"))).drop("_day")
        many = F.col("_files")
    out = out.withColumn("_part", F.pmod(F.xxhash64("tx_id"), many)).repartition(EVENT_DATE, "_part")
    return out.sortWithinPartitions(EVENT_DATE, TS).drop("_part", "_files")


def overwrite_features(df: DataFrame, table: str, path=None, files_per_day=None, rows_per_file=2_000_000):
    """Feature table partitioned by day and sorted by time inside its files, so time splits read little (see `by_day`)."""
    overwrite_table(by_day(df, files_per_day, rows_per_file), table, [EVENT_DATE], path)


def replace_version(df: DataFrame, table: str, path: str, partition_by=()) -> str:
    """Replaces what `table`, a view over the versions in `path`, shows, and returns the new version's folder.

    The new version is written beside the old one; only then the view is switched to it. A failed write leaves the old
    version, who reads it goes on with its files, and `df` may be made from `table` itself. `drop_versions` removes old ones.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(*partition_by).parquet(folder)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM parquet.`{folder}`")
    return folder


def drop_versions(spark: SparkSession, path: str, keep: str):
    """Removes all versions in `path` but `keep`; call it when no reader of an old one is left."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("version-") and name != keep.rstrip("/").rsplit("/", 1)[-1]:
            system.delete(status.getPath(), True)


def folder_schema(spark: SparkSession, folder: str):
    """Columns of all files of a folder, or None if it holds none."""
    try:
        return spark.read.option("mergeSchema", True).parquet(folder).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def create_if_absent(spark: SparkSession, table: str, schema, path=None):
    if is_folder(table):  # the first append makes it
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{location}")


def add_column_if_absent(spark: SparkSession, table: str, column: str, data_type: str) -> bool:
    """Whether the column was added. A folder's new files bring theirs, so there is nothing to do for one."""
    if is_folder(table):
        return False
    if column.lower() in {c.lower() for c in spark.table(table).columns}:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{column}` {data_type})")
    return True


def align_to(df: DataFrame, target) -> DataFrame:
    """Target's columns in its order: absent ones become null, extra ones are dropped and logged."""
    have = {c.lower(): c for c in df.columns}
    wanted = {f.name.lower() for f in target.fields}
    dropped = [c for key, c in have.items() if key not in wanted]
    if dropped:
        log.warning("columns the target lacks are dropped: %s", ", ".join(dropped))
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ])


def append_table(df: DataFrame, table: str, path=None):
    """Append rows, creating the table on first use and following its columns afterwards. Files of a folder also keep
    columns that earlier ones lack; read such a folder with `mergeSchema`."""
    spark = df.sparkSession
    if is_folder(table):
        have = folder_schema(spark, table)
        if have is not None:
            known = {f.name.lower() for f in have.fields}
            new = [f for f in df.schema.fields if f.name.lower() not in known]
            df = align_to(df, StructType([*have.fields, *new]))
        df.write.mode("append").parquet(table)
        return
    create_if_absent(spark, table, df.schema, path)
    align_to(df, spark.table(table).schema).write.mode("append").saveAsTable(table)


def append_once(df: DataFrame, table: str, batch="run_id", path=None):
    """Appends rows under the batch ids in their column `batch`; a repeated append of a batch replaces that batch only.

    Tables made by this function are partitioned by the batch, and dynamic partition overwrite puts a batch in place as a whole. In a
    table without such partitions a batch that is already there is left alone: its first append was committed whole.
    """
    spark = df.sparkSession
    if is_folder(table):
        have = folder_schema(spark, table)
        if have is not None:
            known = {f.name.lower() for f in have.fields}
            df = align_to(df, StructType([*have.fields, *[f for f in df.schema.fields if f.name.lower() not in known]]))
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(table)
        return
    if not spark.catalog.tableExists(table):
        rest = [f for f in df.schema.fields if f.name.lower() != batch.lower()]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*rest, df.schema[batch]])
        location = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{batch}`){location}")
    aligned = align_to(df, spark.table(table).schema)
    if batch.lower() in {c.name.lower() for c in spark.catalog.listColumns(table) if c.isPartition}:
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            aligned.write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(setting, before)
        return
    there = spark.table(table).select(batch).distinct()
    aligned.join(there, batch, "left_anti").select(*aligned.columns).write.mode("append").saveAsTable(table)
