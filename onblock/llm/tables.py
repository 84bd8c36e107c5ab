"""Helpers of the text operators: written intermediate tables, quoting, carried rows, shipping of worker code."""

from __future__ import annotations

import sys
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.runtime import fresh_path


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def settle(df: DataFrame, label: str, group_rows: int | None = None) -> DataFrame:
    """Writes the rows below the shared folder and reads them again: lost executors cost only what they still had to do.

    Readers take up to 4,096 rows of a row group at once, whatever their size; group_rows bounds the row groups of large rows.
    """
    path = fresh_path(df.sparkSession, label)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """Like settle, as a table below the shared folder whose buckets are the shuffle partitions of key: joins on it leave these rows where they are."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def carried(df: DataFrame) -> Column:
    """All columns as one struct, so that working columns cannot clash with them."""
    return F.struct(*[quoted(c) for c in df.columns])


def unpacked(df: DataFrame, row: str, columns: list[str], results: dict[str, Column]) -> DataFrame:
    """The carried columns and the results; a result replaces a carried column of its name."""
    taken = {name.lower() for name in results}
    kept = [F.col(row).getField(c).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in results.items()])


def ship(module: str) -> None:
    """Sends a module's worker functions along with the tasks, so that executors need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def kept(name: str, make):
    """What make() returns, made once in a worker process; worker functions are unpickled anew for every task, this is not."""
    holder = sys.modules.setdefault("onblock_kept", ModuleType("onblock_kept"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


ship(__name__)
