"""What Python workers and executors share: the package's path, and a folder for tables between jobs."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Python workers that share this file's path can import the package; other clusters ship it with --py-files."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. Where it is unset a local session gets a folder of its own; on a cluster that is an error, since each executor would write to its own disk."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.seqloom.scratch", None)
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='seqloom-')}"
        spark.conf.set("spark.seqloom.scratch", where)
    return where.rstrip("/")
