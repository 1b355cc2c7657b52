"""Session construction and the two places where a job may put working data."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    # Timestamps are instants; a fixed zone keeps day boundaries reproducible.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "eventloom", master: str | None = None, **conf: object) -> SparkSession:
    """Return a UTC session. ``master`` is for tests; on a cluster the submitter chooses it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false"
        )
    for key, value in {**SESSION_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="eventloom-")


def _shared_folder(spark: SparkSession) -> str:
    """The shared working folder of the cluster; in local mode, one fresh folder per process when none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably and continue from the stored rows, so lost executors cost no recomputation."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder in the shared working folder."""
    return f"{_shared_folder(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
