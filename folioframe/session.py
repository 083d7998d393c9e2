"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(name: str, cores: int | str = "*", memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shared:
        builder = builder.config(SHARED_DIR, shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Without that setting the folder given to ``setCheckpointDir`` counts; without either, an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get(SHARED_DIR, None)
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        raise ValueError(f"set {SHARED_DIR} to a folder that the driver and every executor can reach")
    return current


def local_shared_dir(spark: SparkSession) -> None:
    """For one-machine sessions without a shared folder (tests, trial runs): name a temporary one.

    Sessions on any other master keep the error of ``shared_dir``.
    """
    unset = not spark.conf.get(SHARED_DIR, None) and spark.sparkContext.getCheckpointDir() is None
    if unset and spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="folioframe-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def cut(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a frame as Parquet in the shared folder; the frame read back, and its path.

    Lineage ends here, so a lost executor costs no more than the stages after it. The shuffle
    files of the write go when it has ended.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with settings(spark, {CLEAN_SHUFFLES: "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
