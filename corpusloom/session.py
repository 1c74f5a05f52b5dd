"""Session helpers: shared work folder, staged tables, read parallelism."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_work: dict[str, str] = {}


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Folder for staged tables and stream progress.

    A cluster names a shared one in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/corpusloom-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_work:
        _local_work[app] = tempfile.mkdtemp(prefix="corpusloom-")
    return _local_work[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the work folder and read it back.

    Cuts the lineage: an expensive column is computed once however often the
    table is read, and a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a table scan that has no more splits than there are cores.

    Spark cuts a table smaller than one full split per core into as many parts
    as there are cores, whether or not its row groups can fill them. A larger
    table has more splits than that and passes through without a shuffle. Meant
    for scans: counting the splits of an adaptive plan would run its shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() <= cores:
        return df.repartition(cores, *keys)
    return df


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A session setting for the duration of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_batch(spark: SparkSession, rows: int):
    """Small Arrow batches while a job handles large rows."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def publish_views(**frames: DataFrame) -> None:
    """Make frames known to SQL under the given names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def require_rows(df: DataFrame, message: str = "no rows") -> DataFrame:
    """The frame itself, or an error when it is empty."""
    if df.isEmpty():
        raise ValueError(message)
    return df
