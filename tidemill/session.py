"""Session helpers."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def local_session(app: str = "tidemill", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller's own
    session is used."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory below the shared folder named by
    ``spark.checkpoint.dir``.  Only a local session may fall back to a
    temporary folder: executors of a cluster would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch on its way to a worker; a longer row is a batch of its own.
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: ten thousand rows of text, Spark's bound by rows, are tens of megabytes, which the
    JVM and the worker hold several times over.  A smaller bound of the caller's stays."""
    now = spark.conf.get(ARROW_BYTES)
    if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def carry_code() -> None:
    """Send the Python functions of this package to the workers as code, for
    sessions whose workers do not have the package.  Not needed where it is
    installed or passed with ``--py-files``."""
    cloudpickle.register_pickle_by_value(sys.modules["tidemill"])
