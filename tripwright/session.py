"""Session settings, and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tripwright")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": "8", **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, where every executor can reach it.

    A session without that setting needs ``setCheckpointDir``; nothing else is taken.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/tripwright/{label}-{uuid.uuid4().hex}"
