"""Session settings the engine expects; a cluster's own settings are left alone."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("corvid").config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they start: by path where they share this machine's files, as a ZIP elsewhere."""
    context, root = spark.sparkContext, str(Path(__file__).resolve().parent.parent)
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
        if not context.master.startswith("local"):
            made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="corvid-ship-"), "corvid"), "zip", root, "corvid")
            context.addPyFile(made)
