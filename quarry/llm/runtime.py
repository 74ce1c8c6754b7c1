"""Session settings of the operators that run Python on the executors."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quarry.session import ship_package

# Arrow batches of whole documents: bounded by rows and by bytes, since the
# default row count alone would let long texts fill an executor's memory
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package and tighten the Arrow batch limits that are wider."""
    ship_package(spark)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).lower()
        if not now.lstrip("-").rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
            spark.conf.set(key, str(most))
