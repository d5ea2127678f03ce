"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "ratingloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Nothing in the library depends on this helper: any session works. AQE (with
    skew-join splitting) is on by default in Spark 4; it is stated here because
    the fact-to-dimension joins rely on it for hot keys.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed."""
    package = Path(__file__).parent
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), package.name), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder of its own as checkpoint folder.
    """
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):  # not local-cluster, whose executors are processes of their own
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ratingloom-"))
    return spark.sparkContext.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), f"ratingloom-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared folder; nothing exists there yet."""
    return os.path.join(_scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application staged; call it when no result is left to be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpointing(spark: SparkSession) -> None:
    """Point ``checkpoint()`` and iterative MLlib jobs at the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
