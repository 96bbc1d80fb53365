"""Session helpers: a local session for tests/bench and checkpoint-dir resolution.

On a cluster the session is supplied by the caller; the library only reads
``spark.checkpoint.dir`` from it.  A private directory is created only when
that setting is absent (local tests), never on a cluster that names one.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}  # by application id

# Settings the library is tuned for; set them on a cluster session too.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The cleaning projections generate methods over 8000 bytes of bytecode, which the JVM
    # will not JIT-compile; at this limit Spark falls back to per-expression code for those
    # stages only, which runs about twice as fast here.  Neighbouring projections are merged by
    # the optimizer, so writing the cleaning as two of them changes nothing.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starmart") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local inputs are single files, read by one task; a cluster's many files need no dealing out
        .config("starmart.landing.partitions", os.environ.get("STARMART_LANDING_PARTITIONS", "16"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# While the library writes its tables: generated methods too large for the JVM's compiler give way to per-expression
# code, and a task keeps the files of a few partition values open instead of sorting its rows by them.
WRITE_CONF: dict[str, str] = {
    "spark.sql.codegen.hugeMethodLimit": RECOMMENDED_CONF["spark.sql.codegen.hugeMethodLimit"],
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


@contextmanager
def write_settings(spark: SparkSession) -> Iterator[None]:
    """``WRITE_CONF`` for the writes inside; the session's own settings are put back."""
    before = {k: spark.conf.get(k) for k in WRITE_CONF}
    for k, v in WRITE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory; only a local-mode session without one gets a private temp folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
        # a machine-local folder is not shared by executors: a cluster must name one
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (written tables and key files go there)")
    key = sc.applicationId
    if key not in _LOCAL_DIRS:
        _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="starmart-ckpt-")
    sc.setCheckpointDir(_LOCAL_DIRS[key])
    return sc.getCheckpointDir() or _LOCAL_DIRS[key]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint directory for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def drop_work(spark: SparkSession, *paths: str) -> None:
    """Remove folders that ``work_dir`` named, through the file system that holds them."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/"
    for path in paths:
        if not path.startswith(base):
            raise ValueError(f"{path} is not a work folder of this session")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
