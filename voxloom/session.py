"""Sessions with the settings that the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed joins and merges small partitions; kernels must not start their own threads.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
}


def session(app: str = "voxloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session; master is left to spark-submit unless given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    return b.config(map=SETTINGS | settings).getOrCreate()
