"""Session settings and the two ways a plan may be cut: checkpoint or written table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str = "*", app: str = "gridloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Without call-site capture, plans of hundreds of columns build about a third faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is chosen only in local mode, where driver and executors share
    one disk; on a cluster a missing setting is an error, not a reason to guess.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="gridloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later branches read one and the same result."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table that a job writes and reads back."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
