"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(master: str, app: str = "linkloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as ``spark.checkpoint.dir`` names it.

    Only a local session may go without: there, one temporary folder is made and remembered.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("linkloom.local.folder", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="linkloom-")
        spark.conf.set("linkloom.local.folder", folder)
    return folder.rstrip("/")


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_scratch.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """Intermediate tables written inside go to one folder, which is removed at the end. What is to stay has to be written
    elsewhere before."""
    folder = new_folder(spark, name)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts lineage so that lost executors cost no recomputation of earlier steps; unlike an RDD
    checkpoint, the readers still prune columns and push filters.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
