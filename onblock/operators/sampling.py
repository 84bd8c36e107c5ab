"""Repeatable samples of a fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onblock.operators.ranks import running_totals


def sample_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def hash_sample(
    df: DataFrame, n: int, key: str, seed: int = 0, before_filter: Column | None = None, digits: int = 4
) -> DataFrame:
    """The `n` rows with the smallest key hash: the same rows for any partitioning.

    `before_filter` samples first and filters the sample afterwards, so fewer than `n` rows come back; leave it out
    and filter `df` to sample among the matching rows.

    Rows are not sorted as a whole. Counts per leading hash digits tell which prefixes are in entirely and which
    single prefix holds the n-th row; only the rows of that prefix are ranked.
    """
    hashed = df.withColumn("_hash", sample_hash(key, seed)).withColumn("_head", F.conv(F.substring("_hash", 1, digits), 16, 10).cast("long"))
    heads = running_totals(hashed.groupBy("_head").agg(F.count(F.lit(1)).alias("n")), "_head", ["n"])
    edge = heads.filter(F.col("cum_n") >= n).agg(
        F.min(F.struct("_head", (F.col("cum_n") - F.col("n")).alias("taken")))
    )
    marked = hashed.withColumn("_edge", edge.scalar())
    whole = marked.filter(F.col("_edge").isNull() | (F.col("_head") < F.col("_edge._head")))
    border = marked.filter(F.col("_head") == F.col("_edge._head"))
    rank = F.row_number().over(Window.partitionBy("_head").orderBy("_hash", key))
    border = border.withColumn("_rank", rank).filter(F.col("_rank") <= n - F.col("_edge.taken")).drop("_rank")
    sample = whole.unionByName(border).drop("_hash", "_head", "_edge")
    return sample if before_filter is None else sample.filter(before_filter)
