"""Session helpers: tuned builder, code shipping and the shared folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app: str = "beaconframe", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings that the operators expect.

    On a cluster the deployment's own session is used as it is; only UTC as the
    session time zone is needed for equal results.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BEACONFRAME_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python once per Spark application."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_ROWS) == "10000":  # Spark's default: whole texts can be long
        spark.conf.set(_BATCH_ROWS, "1000")
    if sc.applicationId in _SHIPPED:
        return
    target = Path(tempfile.mkdtemp(prefix="beaconframe-")) / "beaconframe.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(_PACKAGE.rglob("*.py")):
            z.write(f, f"{_PACKAGE.name}/{f.relative_to(_PACKAGE)}")
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; one of our own only where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        found = Path(tempfile.mkdtemp(prefix="beaconframe-shared-")).as_uri()
        atexit.register(shutil.rmtree, found.removeprefix("file://"), ignore_errors=True)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path (not made yet) within the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows, reliably checkpointed in the shared folder, with lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark alone (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
