"""Isolation forest (Liu, Ting and Zhou 2008) on DataFrames.

Each tree grows in its own task from a small hash sample, so trees depend on the seed and the row keys but not on
the partitioning. The grown forest is bounded by trees * samples nodes; rows are scored in vectorised batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onblock.operators.ranks import exact_quantiles

NODES = "tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, depth array<double>"


def _mean_path(n: int) -> float:
    """Expected length of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(points: np.ndarray, limit: int, rng: np.random.Generator) -> tuple[list, list, list, list, list]:
    feature, cut, left, right, depth = [], [], [], [], []
    todo = [(np.arange(len(points)), 0, -1, False)]
    while todo:
        rows, level, parent, is_right = todo.pop()
        node = len(feature)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        feature.append(-1), cut.append(0.0), left.append(-1), right.append(-1)
        depth.append(level + _mean_path(len(rows)))
        spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(points.shape[1])
        usable = np.flatnonzero(spread > 0)
        if level >= limit or len(rows) <= 1 or not len(usable):
            continue
        f = int(rng.choice(usable))
        values = points[rows, f]
        at = float(rng.uniform(values.min(), values.max()))
        feature[node], cut[node] = f, at
        todo.append((rows[values <= at], level + 1, node, False))
        todo.append((rows[values > at], level + 1, node, True))
    return feature, cut, left, right, depth


def tree_samples(df: DataFrame, columns: list[str], key: str, trees: int, sample: int, seed: int) -> DataFrame:
    """Up to `sample` rows per tree, those with the smallest hash of (tree, key).

    A hash threshold keeps about four times the wanted rows before anything is exploded, so the intermediate result
    does not grow with the table; then the rows are ranked per tree.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    share = F.try_divide(F.lit(4.0 * sample + 200), F.col("_total").cast("double"))
    unit = lambda t: F.pmod(F.xxhash64(F.lit(seed), t, F.col(key)), F.lit(1 << 40)) / float(1 << 40)
    drawn = df.withColumn("_total", total).select(
        key,
        *columns,
        F.explode(
            F.filter(
                F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), unit(t).alias("u"))),
                lambda d: d["u"] < share,
            )
        ).alias("draw"),
    )
    first = F.row_number().over(Window.partitionBy("draw.tree").orderBy("draw.u", key))
    return (
        drawn.withColumn("_rank", first)
        .filter(F.col("_rank") <= sample)
        .select(F.col("draw.tree").alias("tree"), "_rank", *columns)
    )


def isolation_scores(
    df: DataFrame, columns: list[str], key: str, trees: int = 100, sample: int = 256, seed: int = 0
) -> DataFrame:
    """Adds `anomaly_score` in (0, 1]; higher means easier to isolate."""
    complete = df.dropna(subset=columns)

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        points = part.sort_values("_rank")[columns].to_numpy(float)
        limit = max(1, math.ceil(math.log2(max(2, len(points)))))
        nodes = _grow(points, limit, np.random.default_rng([seed, tree]))
        return pd.DataFrame([[tree, *nodes]], columns=["tree", "feature", "cut", "left", "right", "depth"])

    samples = tree_samples(complete, columns, key, trees, sample, seed)
    forest = samples.groupBy("tree").applyInPandas(grow, NODES).orderBy("tree").collect()
    packed = [tuple(np.asarray(row[name]) for name in ("feature", "cut", "left", "right", "depth")) for row in forest]
    drawn = samples.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 2
    shared = df.sparkSession.sparkContext.broadcast((packed, _mean_path(int(drawn)) or 1.0))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        grown, expected = shared.value
        for batch in batches:
            x = batch.to_numpy(float)
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for feature, cut, left, right, depth in grown:
                at = np.zeros(len(x), dtype=int)
                moving = feature[at] >= 0
                while moving.any():
                    go_left = x[rows, np.maximum(feature[at], 0)] <= cut[at]
                    at = np.where(moving, np.where(go_left, left[at], right[at]), at)
                    moving = feature[at] >= 0
                total += depth[at]
            yield pd.Series(np.exp2(-total / max(1, len(grown)) / expected))

    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return df.withColumn("anomaly_score", F.when(known, score(F.struct(*columns))))


def isolation_flags(
    df: DataFrame,
    columns: list[str],
    key: str,
    trees: int = 100,
    sample: int = 256,
    contamination: float = 0.05,
    seed: int = 0,
) -> DataFrame:
    """Scores plus `anomaly` = 1 for rows beyond the contamination quantile of the scores."""
    scored = isolation_scores(df, columns, key, trees, sample, seed)
    cut = exact_quantiles(scored, "anomaly_score", {"cut": 1 - contamination}).scalar()
    return scored.withColumn("_cut", cut).withColumn(
        "anomaly", F.coalesce((F.col("anomaly_score") > F.col("_cut")).cast("int"), F.lit(0))
    ).drop("_cut")
