"""Session helpers: a local session for tests, and staging in the shared folder of the cluster."""

import os
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores="*", partitions=8, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paywatch")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def package_on_workers(spark: SparkSession):
    """Lets Python workers import this package from the source tree that the driver runs, wherever it was started.
    A cluster whose nodes don't share that tree gets the package by --py-files."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


_local_folders = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only for local masters without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="paywatch-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/paywatch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def clear_staged(spark: SparkSession):
    """Removes what this application staged; call it when nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/paywatch/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


ROW_GROUP = 16 << 20  # bytes of a staged table's row groups: what a scan can be cut into
SCAN_TASKS = 3  # for each core
FOLDERS = "4"


@contextmanager
def _set(spark: SparkSession, key: str, value: str | None):
    """A setting for the actions inside; None leaves it as it is."""
    before = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if value is not None:
            spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def stage(df: DataFrame, name: str, shuffled: str | None = None, folders: str | None = None) -> DataFrame:
    """Write once and read back: cuts lineage, survives lost executors and keeps column pruning.

    Small row groups, and scans in several tasks for each core unless the session says otherwise: files that hold one row group each, a few
    more than there are cores, would leave most cores idle while the last ones are read. For the same reason `shuffled` limits the bytes
    that the tasks behind a shuffle get when small ones are put together.

    `folders` names a column of few values, each a folder, so that rows with one of them are read without the others. Up to FOLDERS of
    them are written side by side in a task, without a sort.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with (_set(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", shuffled),
          _set(spark, "spark.sql.maxConcurrentOutputFileWriters", FOLDERS if folders else None)):
        writer = df.write.option("parquet.block.size", ROW_GROUP)
        (writer.partitionBy(folders) if folders else writer).parquet(path)
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(SCAN_TASKS * spark.sparkContext.defaultParallelism))
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstage(*frames: DataFrame):
    """Removes tables that `stage` wrote and nothing reads any more, not even a frame made from them that is still to run."""
    for df in frames:
        path = getattr(df, "staged_path", None)
        if path is not None:
            folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
