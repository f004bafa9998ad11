"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Recording the call site of every column expression makes plans with
    # hundreds of columns slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "formline", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults above; keyword arguments override them
    (dots in names written as double underscores)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    The folder named by ``spark.checkpoint.dir`` is used. Only a session in one
    process (``local``, ``local[n]``) without one gets a temporary folder, removed
    at its end; on a cluster, a local one too, it would not be shared by the
    executors, so it is an error there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="formline-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def reliable_checkpoint(df):
    """Cut the lineage with a checkpoint that survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
