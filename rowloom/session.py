"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def with_defaults(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings for a new session; a cluster's own values go on top."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot join partition even where the plan above needs one more shuffle for it.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Plans are built from many columns; recording the Python line of each takes most of that time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # One output directory may be replaced without touching its siblings.
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )


def use_utc(spark: SparkSession) -> None:
    """Dates are cut out of instants in several reports, so the zone is part of the result."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="rowloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
