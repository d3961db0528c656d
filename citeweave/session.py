"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession

# Skewed keys are split at run time and joins re-planned from measured sizes; the same
# settings hold on one machine and on a cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rankings of the first thousands of a group are cut within each task, too.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "citeweave", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword arguments add or replace single ones."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
