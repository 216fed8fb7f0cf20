"""Session settings the table jobs are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # hot keys are split and small sides broadcast by measured size
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # digests are hexadecimal text, of which Spark's usual codec saves nothing and this one half
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def batch_folder(spark: SparkSession, name: str) -> str:
    """Where the stages of a batch are written: below the shared folder the cluster names.

    Only a local session without one, as in tests, gets a temporary folder: on a cluster
    every executor would write its part to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{named or tempfile.mkdtemp(prefix='careloom-')}/{name}"
