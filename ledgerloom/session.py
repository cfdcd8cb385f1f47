"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_BASE: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "ledgerloom", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording a Python stack for every column expression slows plan building down.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Naive source timestamps are UTC, so every NTZ-to-timestamp cast must use UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_base(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may fall back to a folder of this machine; executors on other
    hosts could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_BASE[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below :func:`scratch_base`."""
    return f"{scratch_base(spark)}/{label}-{uuid.uuid4().hex[:12]}"
