"""Session settings and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# ANSI arithmetic, UTC wall clocks and adaptive execution are what the results and the plans
# depend on. Partition counts stay with the cluster; adaptive execution coalesces them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a generated method above 8,000 bytes of bytecode but interprets it for every row.
    # Wide projections make such methods; with this limit Spark generates them in parts instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Call sites in error messages cost several driver round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"
# Of these, what decides how fast wide rows are and can be set while a session runs.
TUNED = ["spark.sql.codegen.hugeMethodLimit"]


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Give a session that ``build_session`` has not made its ``TUNED`` settings; they stay set, as frames are lazy."""
    for key in TUNED:
        spark.conf.set(key, SETTINGS[key])
    return spark


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sabermill-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only where the whole application runs on this machine.
    """
    folder = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_FOLDER_SETTING} to a folder all executors share")
    return _local_folder()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    For results that several branches of one plan read with different columns: without it
    every branch would scan and aggregate the raw table again, as pruning makes their
    shuffles differ. The written table also survives lost executors and carries its size, so
    later joins can choose broadcast from a known number.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs that run inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def one_use(shuffle_partitions: int | None = None) -> dict[str, str]:
    """For ``settings``: a job's shuffle files go when it ends, not when the driver collects its garbage."""
    values = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    return values | ({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {})


def spread_out(df: DataFrame) -> DataFrame:
    """Rows of a scan in as many partitions as tasks can run, where they come in fewer (one large file)."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)
