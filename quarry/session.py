"""Session construction and the shared scratch location.

Iterative operators cut lineage by writing each round to the folder the
cluster names in ``spark.checkpoint.dir``.  That folder must be shared storage
(HDFS, S3, ...); only a local-mode session without one gets a private
temporary folder, which is what the tests use.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants, whatever the cluster size.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with adaptive execution switched on.

    ``shuffle_partitions`` is the *initial* shuffle width; AQE coalesces it at
    run time, so on a cluster set it generously (for example 4-8x the total
    executor cores) and let AQE shrink it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session; a folder of our own is set only when none is
    configured and the session runs in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a "
                "folder on shared storage")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/quarry/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in the Python workers of this application.

    Operators that run Python on the executors (pandas UDFs, mapInPandas)
    call this; the package is zipped once per application and distributed
    with ``addPyFile`` (Spark's own file distribution), so it works whatever
    the driver's working directory or the executors' environment.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)
