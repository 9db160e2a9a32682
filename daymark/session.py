"""Session settings the package relies on."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # only the partitions a run writes are replaced; history stays
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when that costs the stage above one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application, unless their path has it already."""
    name = spark.sparkContext.applicationId
    if name in _shipped or str(PACKAGE.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    # the driver serves this archive itself, so its own temporary folder will do
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='daymark-')}/daymark", "zip", PACKAGE.parent, PACKAGE.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(name)


def local_session(cores: int = 8, name: str = "daymark") -> SparkSession:
    """A single-machine session for tests and timings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
