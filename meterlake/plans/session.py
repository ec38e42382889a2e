"""Session settings and the shared folder for tables written along the way."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_own_folder: tempfile.TemporaryDirectory | None = None


def build_session(name: str = "meterlake", master: str | None = None, **config) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts and memory are left to the cluster; adaptive execution
    merges small shuffle partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Do not record the calling line for every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        **config,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, in the shared folder of the session.

    A local session without spark.checkpoint.dir (a test) uses a temporary one,
    which is removed when the process ends.
    """
    global _own_folder
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        # "local-cluster" has executors of its own.
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        _own_folder = _own_folder or tempfile.TemporaryDirectory(prefix="meterlake-")
        shared = _own_folder.name
    return os.path.join(shared, f"{name}-{uuid.uuid4().hex}")
