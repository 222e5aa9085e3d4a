"""Session helpers: lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make one only in local mode.

    Raises ``RuntimeError`` on a cluster that names no shared folder: a
    machine-local folder there would be lost with its executor.
    """
    sc = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="parallaxis-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return it without its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, as a plain path: for files that the driver writes and executors read."""
    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()
    path = re.sub(r"^file:/*", "/", base)
    if "://" in path:
        raise RuntimeError(f"{base}: the binary files need a folder that is mounted")
    path = os.path.join(path, f"{name}-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path
