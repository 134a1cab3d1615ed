"""Session settings that the engine relies on."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are naive; epoch arithmetic on them needs the session to be in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_clusters(spark: SparkSession) -> SparkSession:
    """Let joins by (stay, time) use tables that lie in buckets of stays, without an exchange."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def build_session(name: str = "staygrid", **conf: str) -> SparkSession:
    """A session with adaptive execution (also for skewed joins) and UTC time."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        **conf,
    }
    return SparkSession.builder.appName(name).config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir); in local mode any will do.

    What is written there is deleted when the application ends: results that are read later may lie in it.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{(where or 'file://' + tempfile.mkdtemp(prefix='staygrid-')).rstrip('/')}/{name}-{uuid4().hex}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return path.toString()
