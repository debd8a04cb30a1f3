"""Session settings shared by the jobs, the tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Values every job relies on. Zone-less timestamps are read as they are stored,
# and AQE re-plans joins, splits skewed partitions and merges small ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "ledgerloom",
    master: str | None = None,
    shared_dir: str | None = None,
    **settings: str,
) -> SparkSession:
    """Start (or get) a session. ``shared_dir`` becomes ``spark.checkpoint.dir``
    and must be reachable from every executor; leave it out on a cluster that
    names its own. Extra settings use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shared_dir:
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
