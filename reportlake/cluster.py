"""What a session needs before Python code of this package runs in its workers, and the folder that all of it shares."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def is_local(spark: SparkSession) -> bool:
    """Whether the driver is the only executor."""
    master = spark.sparkContext.master
    return master.startswith("local") and "cluster" not in master


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where that is unset a fresh local one, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        scala = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = scala.get() if scala.isDefined() else None
    if not found:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="reportlake-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once, unless they find it by PYTHONPATH or their folder anyway."""
    root, context = Path(__file__).resolve().parents[1], spark.sparkContext
    found = [Path(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if is_local(spark):
        found.append(Path.cwd())  # local workers start in the driver's folder
    if root in (p.resolve() for p in found) or getattr(context, "_reportlake_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="reportlake-"), "reportlake_code")
    context.addPyFile(shutil.make_archive(base, "zip", root, "reportlake"))
    context._reportlake_shipped = True
