"""Session settings shared by tests, benchmarks and applications."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that the library's expressions rely on, whatever the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


#: Bytes of one Arrow batch on its way to Python, unless the session sets another bound.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows, so that a batch of long texts or files doesn't fill a worker."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "strataphon") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATAPHON_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver tables; only the columns used later reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; Spark serves the archive to them."""
    context = spark.sparkContext
    if getattr(context, "_strataphon_shipped", False):
        return
    root = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="strataphon-"), "strataphon.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, f"{root.name}/{path.relative_to(root)}")
    context.addPyFile(archive)
    context._strataphon_shipped = True


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only where all runs in one local JVM."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="strataphon-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found
