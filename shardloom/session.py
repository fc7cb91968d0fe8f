"""Session and the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "shardloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI SQL, UTC and adaptive execution; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="shardloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that lost executors don't recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
