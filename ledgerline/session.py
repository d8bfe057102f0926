"""Session settings the jobs rely on, and the shared folder for written state."""

from __future__ import annotations

import atexit
import shutil
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone; minute buckets are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for one stream, so the caller's settings stay untouched.

    The number of state partitions is fixed in a stream's checkpoint at its first
    start.  It defaults to the cores of the cluster, which is what a keyed stream can
    use at once; pass a multiple of it when the key set is expected to grow.
    """
    session = use_utc(spark.newSession())
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    session.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return session


@cache
def _own_folder(warehouse: str, application: str) -> str:
    """A folder in the warehouse, which all executors share too; removed with the driver."""
    folder = f"{warehouse.rstrip('/')}/_work-{application}"
    if folder.startswith(("file:", "/")):
        atexit.register(shutil.rmtree, "/" + folder.removeprefix("file:").lstrip("/"), True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for written state.

    In Spark's own order: what ``setCheckpointDir`` chose, else ``spark.checkpoint.dir``.  Where
    neither is set, a folder of this application in the warehouse.
    """
    chosen = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if chosen:
        return chosen.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return _own_folder(warehouse, spark.sparkContext.applicationId)


_made: list[str] = []


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def clear_folders(spark: SparkSession) -> None:
    """Delete every folder that this driver made; results that still read them are void."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


def release(*frames: DataFrame) -> None:
    """Delete the folders of results of :func:`kept` that nothing reads any more."""
    for df in frames:
        spark, folder = df.sparkSession, df.kept_folder
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _made.remove(folder)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def kept(df: DataFrame, label: str, by: str | None = None, batch: int | None = None) -> DataFrame:
    """Write a result that several steps read, and read it back.

    Folders stay until :func:`clear_folders` or :func:`release`.  Whatever comes after neither repeats the
    work before it nor depends on an executor that holds it in memory; nothing reads the write's own shuffle
    files again, so they are removed as soon as it is done.  ``by`` names a column with a folder for each
    value; ``batch`` is how many rows go to Python at a time, where these are large.
    """
    spark, path = df.sparkSession, fresh_folder(df.sparkSession, label)
    settings = {_DROP_SHUFFLES: "true"} | ({_BATCH: str(batch)} if batch else {})
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df.write.parquet(path, partitionBy=by)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_folder = path
    return out
