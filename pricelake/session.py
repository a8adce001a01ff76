"""Session helpers.

Library code never creates its own session settings on a cluster: it reads
what the cluster provides.  ``local_session`` is for tests and the bench;
``checkpoint_dir`` returns the shared folder named by ``spark.checkpoint.dir``
and only invents one (under a fresh temp folder) when the setting is unset,
which is the local-test case.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pricelake") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: dict[str, str] = {}      # application id -> its folder (local master)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``; makes a fresh local one, once
    per application, only when it is unset and the master is local (tests).  On
    a cluster each machine would write to its own disk, so there it is an error.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver "
                             "and executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="pricelake-ckpt-")
        path = _LOCAL[app]
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# While a layer is written: shuffles begin with that many partitions at least,
# which AQE joins up to its advisory size, so what a task sorts grows later with
# the input (200 are the most that map tasks write without holding rows); and
# joins whose smaller side is small in every partition need no sort.
LAYER_PARTITIONS = 200
LAYER_HASH_JOIN = "64m"
# Shuffle files go with the query that made them, not when the driver next collects
# garbage, and layers are stored smaller.
LAYER_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def layer_settings(spark: SparkSession) -> Iterator[None]:
    """The session's settings, but for those of AQE and of disk that suit a large
    write; what the session sets itself is kept (if it is no fewer partitions)."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    local = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    old = {name: spark.conf.get(name, None) for name in (first, local, *LAYER_DISK)}
    n = int(old[first] or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(first, str(max(n, LAYER_PARTITIONS)))
    if old[local] in (None, "0", "0b"):
        spark.conf.set(local, LAYER_HASH_JOIN)
    for name, value in LAYER_DISK.items():
        if old[name] is None:
            spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
