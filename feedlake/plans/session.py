"""Session settings that suit these plans; all can be overridden by the caller."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime plans: drop empty hot-key branches, split skewed joins, merge small partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A run has more distinct generated classes than the default cache keeps.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Do not record the Python call site of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def session(master: str, app_name: str = "feedlake", **settings: str) -> SparkSession:
    """A session with the settings above; on a cluster, set `spark.checkpoint.dir` and shuffle partitions too."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
