"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Settings the operators like on any cluster. Wide rows make long generated methods; the JVM does
# not compile methods above 8000 bytes, so Spark should split such stages instead.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: str | int = "*", app: str = "airgrain") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="airgrain-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before, removed when the session's JVM ends."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(jvm_path)
    return path


def compiled_apart(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions. Spark makes one method of all expressions up to the next sort or
    shuffle, and the JVM only interprets methods above 8000 bytes: between wide projections this ends a method.
    (A coalesce to more partitions than there are moves nothing.)"""
    return df.coalesce(1 << 20)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query of this session go when the query ends, and not when the driver
    happens to collect garbage. Those that persisted rows come from stay. The setting is put back afterwards."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and not again when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Let ``checkpoint()`` write to the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{checkpoint_root(spark)}/rdd")
