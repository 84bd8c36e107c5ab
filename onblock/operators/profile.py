"""Hub profiles: roll-up, clusters, silhouette, exports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onblock.operators.encode import standardised
from onblock.operators.kmeans import kmeans

# The profile columns, in their order.
PROFILE_FEATURES = ["n_flights", "delay_rate", "avg_delay", "cancel_rate", "avg_distance"]


def hub_profile(trips: DataFrame, airports: DataFrame, min_trips: int | Column = 5_000) -> DataFrame:
    """Traffic, punctuality and distance per origin with more than `min_trips` trips, cancelled ones included.

    Names and coordinates join after the roll-up, when one row per hub is left.
    """
    rolled = trips.groupBy(F.col("origin").alias("iata")).agg(
        F.count(F.lit(1)).alias("n_flights"),
        F.avg("arr_del15").alias("delay_rate"),
        F.avg(F.when(F.col("cancelled") == 0, F.col("arr_delay"))).alias("avg_delay"),
        F.avg("cancelled").alias("cancel_rate"),
        F.avg("distance").alias("avg_distance"),
    )
    kept = rolled.filter(F.col("n_flights") > min_trips)
    return kept.join(airports.select("iata", "name", "lat", "lon"), "iata", "left")


def cluster_hubs(profile: DataFrame, k: int = 4, restarts: int = 10, seed: int = 0) -> DataFrame:
    """k-means on the standardised profile, best of several starts; clusters numbered from large to small.

    All starts share their passes over the hubs. A hub with a null in its profile has no cluster.
    """
    z = [f"{c}_z" for c in PROFILE_FEATURES]
    ready = standardised(profile, PROFILE_FEATURES)
    labelled = kmeans(ready, z, "iata", k, restarts, seed).assign(ready, output="_cluster")
    sizes = labelled.filter("_cluster is not null").groupBy("_cluster").agg(F.count(F.lit(1)).alias("_size"), F.min("iata").alias("_first"))
    order = Window.orderBy(F.desc("_size"), "_first")  # k rows
    number = sizes.select("_cluster", (F.row_number().over(order) - 1).alias("cluster"))
    return labelled.join(F.broadcast(number), "_cluster", "left").drop("_cluster", *z)


def cluster_profile(clustered: DataFrame, digits: int = 2) -> DataFrame:
    return clustered.groupBy("cluster").agg(*[F.round(F.avg(c), digits).alias(c) for c in PROFILE_FEATURES])


def silhouette(df: DataFrame, columns: list[str], cluster: str, key: str, block_rows: int = 5_000) -> DataFrame:
    """Mean Euclidean silhouette, exact, as a one-row frame; `key` is unique.

    The measure needs the distance of every row to every other, so the work is quadratic and meant for profiles, not for trips. Rows are
    dealt to blocks by a hash of the key; every pair of blocks is one task that turns its distances into sums per row and cluster, and
    the sums are added up. Each row is sent to as many tasks as there are blocks, and a task holds two blocks.
    """
    sizes = {row[cluster]: row["n"] for row in df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(sizes)
    blocks = max(1, -(-sum(sizes.values()) // block_rows))
    rows = df.select(
        F.col(key).alias("_key"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("_at"),
        F.array_position(F.array(*[F.lit(c) for c in labels]), F.col(cluster)).cast("int").alias("_own"),
        F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("_block"),
    )
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    here = rows.withColumn("_other", others)
    there = rows.select(F.col("_at").alias("_to"), F.col("_own").alias("_cluster"), F.col("_block").alias("_other"), others.alias("_block"))

    def summed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, owner = np.stack(left["_at"]) if len(left) else np.empty((0, len(columns))), right["_cluster"].to_numpy()
        b = np.stack(right["_to"]) if len(right) else np.empty((0, len(columns)))
        out = np.zeros((len(a), len(labels)))
        for start in range(0, len(a), 256):
            gap = a[start : start + 256, None, :] - b[None, :, :]
            apart = np.sqrt((gap * gap).sum(axis=2))
            for i in range(len(labels)):
                out[start : start + 256, i] = apart[:, owner == i + 1].sum(axis=1)
        return pd.DataFrame({"_key": left["_key"], "_own": left["_own"], **{f"_s{i}": out[:, i] for i in range(len(labels))}})

    kind = f"_key {dict(df.dtypes)[key]}, _own int, " + ", ".join(f"_s{i} double" for i in range(len(labels)))
    parts = here.groupBy("_block", "_other").cogroup(there.groupBy("_block", "_other")).applyInPandas(summed, kind)
    sums = parts.groupBy("_key", "_own").agg(F.array(*[F.sum(f"_s{i}") for i in range(len(labels))]).alias("_sums"))

    means = F.array(*[F.try_divide(F.element_at("_sums", i + 1), F.lit(float(sizes[c]))) for i, c in enumerate(labels)])
    own = F.col("_own")
    own_size = F.element_at(F.array(*[F.lit(sizes[c]) for c in labels]), own)
    scored = sums.select(
        F.try_divide(F.element_at("_sums", own), own_size - 1).alias("a"),
        F.array_min(F.filter(means, lambda m, i: i != own - 1)).alias("b"),
    )
    value = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return scored.agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise(value)).alias("silhouette"))


def profile_export(profile: DataFrame, digits: int = 3) -> DataFrame:
    """Rows for the map: hubs with coordinates only, numbers rounded half-even."""
    doubles = [c for c, t in profile.dtypes if t == "double"]
    return profile.dropna(subset=["lat", "lon"]).withColumns({c: F.bround(c, digits) for c in doubles})
