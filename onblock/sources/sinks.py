"""Exports and lookups: JSON, CSV, published tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from onblock.runtime import fresh_path


def write_json(df: DataFrame, path: str) -> None:
    """One JSON file; for small results such as a top-k route table or hub profiles."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_days(scored: DataFrame, path: str) -> None:
    """Scored days as JSON, one folder per day, all days in one job; only the days present are replaced."""
    (
        scored.hint("rebalance", "flight_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("flight_date")
        .json(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_lookup(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A small JSON lookup; Spark broadcasts it by its file size."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def publish(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Writes a new version of a table and points the view of that name to it once the write is complete.

    Every call has a folder of its own, so readers of the version before are not disturbed; old versions are the caller's to remove.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}" if root else fresh_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    stored.createOrReplaceTempView(name)
    return stored
