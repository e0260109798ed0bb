"""Session settings that the operators count on.

Only runtime SQL settings are touched, so ``tune`` also works on a session
somebody else built.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; fall back to a local one only if none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="loanloom-checkpoint-"))


def local_session(cpus: str | int = "*", app: str = "loanloom", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no call-site capture per expression: it dominates the time to build short plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
