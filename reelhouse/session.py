"""SparkSession defaults the plans rely on.

Semantics that depend on configuration (time zone, ANSI casts) are pinned here;
sizing knobs (shuffle partitions, broadcast threshold) are only *defaulted* so
that a cluster's own settings win.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the results depend on: always applied.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only affect speed: applied when the cluster has not set them.
TUNING_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Advisory partition size after AQE coalescing; 128 MiB keeps a task's
    # shuffle read in memory on ordinary executors.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    # Spark only broadcasts a join side whose *estimated* size is under this
    # bound (and AQE re-checks it with real shuffle sizes).  Dimension tables
    # (movies, genre sets) fall under it; fact tables never do.
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.files.maxPartitionBytes": str(128 << 20),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = "local[*]", app_name: str = "reelhouse",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pinned semantics.

    ``master=None`` leaves the master to ``spark-submit``.  Tuning defaults are set
    only where the launch configuration (spark-defaults, ``--conf``) has no value,
    so a cluster's own sizing wins; ``extra`` and ``shuffle_partitions`` are applied
    as given.  The UI is off unless ``extra`` turns it on.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **SEMANTIC_CONF}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    launch = spark.sparkContext.getConf()
    for k, v in TUNING_DEFAULTS.items():
        if not launch.contains(k):
            spark.conf.set(k, v)
    apply_semantics(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Pin the settings results depend on, on an existing session."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage with ``checkpoint()``.

    On a cluster ``spark.checkpoint.dir`` must name a folder that the driver and all
    executors share; it is read from the session, and a missing setting raises.  Only
    a ``local`` master (tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="reelhouse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured
