"""Spark session settings the feature plans are written for.

The plans rely on adaptive query execution: shuffle-partition coalescing,
runtime broadcast of small aggregated feature tables (a size-checked
broadcast with sort-merge join beyond the threshold) and skew-join
splitting of hot target keys.  On a cluster pass your own session to
``tune_session``; ``get_spark`` is for local runs and tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings (all settable on a live session).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def tune_session(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def workers_import(spark: SparkSession) -> SparkSession:
    """Python workers started from now on find this package, also where it is not installed.

    A cluster ships the package with ``--py-files`` as usual; this serves local sessions that
    were started from another folder.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return spark


def get_spark(
    master: str | None = None,
    app_name: str = "adfeat",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests, the bench and the oracle check."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    n = shuffle_partitions or int(os.environ.get("ADFEAT_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ADFEAT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune_session(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only for local runs.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is.  Only a local-mode session without one gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) "
            "so checkpointed data survives executor loss"
        )
    path = tempfile.mkdtemp(prefix="adfeat-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
