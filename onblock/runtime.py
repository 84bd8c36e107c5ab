"""Session defaults and the few decisions that need to know the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def session(app: str = "onblock", **conf: str) -> SparkSession:
    """A session with the settings the library relies on: UTC dates and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Root for intermediate tables: the folder the cluster names, a temporary one only on local masters."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="onblock-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: iterative fits keep short plans and survive executor loss."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, taken from file sizes; an upper guess for filtered frames."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def at_once(spark: SparkSession, work: Callable[[Any], Any], items: Iterable) -> list:
    """Results of `work` on each item, in order. Jobs of different items share the executors, so small ones do not wait for each other."""
    items = list(items)
    with ThreadPoolExecutor(max(1, len(items))) as threads:
        return [task.result() for task in [threads.submit(inheritable_thread_target(spark)(work), item) for item in items]]
