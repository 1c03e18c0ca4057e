"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", memory: str = "16g", app: str = "matchlens") -> SparkSession:
    """A session for tests and the local bench. Clusters bring their own."""
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.driver.memory", memory)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            # Wide aggregates: methods beyond this size would never be compiled by the JVM.
            .config("spark.sql.codegen.hugeMethodLimit", "8000")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC")
            .getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset, as in a local run, a fresh temporary folder takes its place and
    becomes the session's checkpoint folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="matchlens-")
        context.setCheckpointDir(folder)
    return folder


def new_shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
