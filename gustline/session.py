"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}


def build_session(app: str = "gustline", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. One of its own is made only in local mode, where none need be named."""
    named = spark.conf.get(CHECKPOINT_KEY, "") or spark.sparkContext.getConf().get(CHECKPOINT_KEY, "")
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return _OWN[app]


def write_stage(df: DataFrame, label: str) -> str:
    """Write a stage result to the shared folder; returns its path.

    A stage read by many later jobs is stored once; a lost executor then re-reads files instead
    of replaying the lineage.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return path
