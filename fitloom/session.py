"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fitloom", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It comes from ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fitloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table below the shared folder."""
    return "/".join([shared_dir(spark), "fitloom", f"{name}-{uuid.uuid4().hex}"])


def write_table(df: DataFrame, name: str, **options: str) -> str:
    """Write ``df`` as an intermediate table and return its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return path


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table survives lost executors, ends the lineage, and gives the
    optimizer real sizes, so a later join can decide on a broadcast by itself.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, name, **options))


def clean_up(spark: SparkSession) -> None:
    """Delete all intermediate tables below the shared folder.

    For the end of a job: tables that are still to be computed from them would fail.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/fitloom")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def available_cores(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))
