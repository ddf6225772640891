"""Session settings the plans in this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot samples or classes on the row-keeping joins: split them at run time,
    # also when that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # No plan carries a broadcast hint on data that can grow. Spark compares each
    # side with this bound itself and sort-merges whatever is larger.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Campaign names that look like numbers or dates stay names.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Plans here are built from many small expressions; recording a call site for each costs
    # more than building them.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}

#: Cut tasks by bytes, so that what one task holds stays the same however large the tables are. The first number of partitions is an upper bound
#: that adaptive execution brings down to the advisory size; a hot key of a join is cut at twice that.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def bounded_tasks(spark: SparkSession) -> SparkSession:
    """Results are lazy and run later, so these stay set for the session."""
    for key, value in TASK_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "dotreef", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
