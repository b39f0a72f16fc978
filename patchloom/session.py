"""Session helpers shared by the whole library."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def prepare(spark: SparkSession | None = None) -> SparkSession:
    """Let Python workers import this package, wherever the driver was started; without a session, the active one's."""
    spark = spark or SparkSession.active()
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *(p for p in paths if p)])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, in ``spark.checkpoint.dir``, which all executors share.

    Only a local master may go without one (tests); a cluster may not.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the ``shared_folder`` and read it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(taken: Iterable[str], wish: str) -> str:
    """``wish``, with as many underscores after it as it takes to differ from all ``taken`` names, in any case."""
    low = {c.lower() for c in taken}
    while wish.lower() in low:
        wish += "_"
    return wish
