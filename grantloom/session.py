"""Session settings the jobs are designed for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key is split even where the join's result must then be dealt out once more
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # size-checked at run time; nothing in the package forces a broadcast of growing data
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
}


#: Adaptive execution merges small partitions, but never makes more than there were; this many
#: start, unless a number of shuffle partitions is asked for.
FIRST_PARTITIONS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000"}


def build_session(
    app: str = "grantloom", master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution on; ``conf`` overrides any default."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    given = dict(conf or {})
    first = {} if "spark.sql.shuffle.partitions" in given else FIRST_PARTITIONS
    for key, value in {**DEFAULTS, **first, **given}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
