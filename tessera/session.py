"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir``
(a shared filesystem path); we read it from the session and only fall
back to our own folder when it is unset (local runs and tests).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every run wants: adaptive execution (runtime broadcast choice,
# partition coalescing, skew-join splitting) and no UI server.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # key pools up to this size filter the scans of large tables (operators/scope.py);
    # a filter of Spark's largest size (8 MB) suits some four million keys
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    fallback_checkpoint_dir: str | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the pipeline's defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control
    on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark, fallback_checkpoint_dir)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the shared checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster names one; otherwise
    sets ``fallback`` (if given) as the checkpoint folder and returns it,
    which only a session with a local master may do.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if fallback:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
        os.makedirs(fallback, exist_ok=True)
        spark.sparkContext.setCheckpointDir(fallback)
        return fallback
    return None
