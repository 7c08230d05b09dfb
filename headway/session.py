"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# by application, in local mode without a shared folder
_TEMPORARY: dict[str, str] = {}

# Every instant in the tables is UTC, so time-zone dependent functions must be too.
SESSION_TIME_ZONE = "UTC"


def build_session(app: str = "headway", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": SESSION_TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # size of one output file after a rebalance before a write
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors can reach.

    The cluster names that folder in `spark.checkpoint.dir`. Only a local-mode
    session without the setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # "local-cluster" has executors of their own
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        # the setting cannot be changed while the session runs, so the folder is remembered
        if app not in _TEMPORARY:
            _TEMPORARY[app] = tempfile.mkdtemp(prefix="headway-")
        base = _TEMPORARY[app]
    return f"{base.rstrip('/')}/headway/{name}-{uuid.uuid4().hex}"
