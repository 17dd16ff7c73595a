"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on. Sizes (memory, executors, shuffle partitions) belong to the cluster, not here.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# What a query has shuffled is deleted when it ends, not when the driver happens to collect its plan, so that the disk holds one
# step's shuffle files at a time. A plan that is run again works out what is gone.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_local_scratch: dict[str, str] = {}


def build_session(app: str = "civiclake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the pinned settings; ``settings`` use ``__`` where the Spark name has a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**PINNED, **FREED}.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the pinned settings to a session somebody else made."""
    for name, value in {**PINNED, **FREED}.items():
        spark.conf.set(name, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written intermediate table, in the folder ``spark.checkpoint.dir`` names.

    Every executor must see the folder, so a cluster session without the setting is an error. Only a local session
    falls back to a temporary folder of its own. Nothing is deleted here: results read these tables lazily.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            _local_scratch[app] = tempfile.mkdtemp(prefix="civiclake-")
        folder = _local_scratch[app]
    return f"{folder.rstrip('/')}/civiclake/{label}-{uuid.uuid4().hex}"
