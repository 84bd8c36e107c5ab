"""k-means from many starts at once.

Every pass over the rows serves all starts: a row finds its nearest centre of each start, and one aggregate with a key per start and centre
brings sums, counts and costs. Only centres and candidate centres reach the driver, some multiples of k for each start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

# The usual settings of parallel seeding and of the steps after it.
SEEDING_ROUNDS, OVERSAMPLING = 2, 2.0
STEPS, TOLERANCE = 300, 1e-4


@dataclass(frozen=True)
class Starts:
    """Centres (starts x k x columns) and the cost of each start: the sum of squared distances to its nearest centres."""

    columns: list[str]
    centres: np.ndarray
    costs: np.ndarray

    @property
    def best(self) -> int:
        return int(np.argmin(self.costs))

    def assign(self, df: DataFrame, start: int | None = None, output: str = "cluster") -> DataFrame:
        """Adds the number of the nearest centre, from 0; of equally near ones the first. None takes the best start."""
        found = _nearest(self.columns, [self.centres[self.best if start is None else start]])
        return df.withColumn(output, found[0]["cluster"])


def _nearest(columns: list[str], centres: list[np.ndarray]) -> Column:
    """For each start a struct of its number, the nearest centre and the squared distance to it."""
    at = F.array(*[F.col(c).cast("double") for c in columns])

    def squared(centre: Column) -> Column:
        return F.aggregate(F.zip_with(at, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y)

    def of_start(number: int, of: np.ndarray) -> Column:
        gaps = F.transform(_literal(of), squared)
        least = F.array_min(gaps)
        return F.struct(F.lit(number).alias("start"), (F.array_position(gaps, least) - 1).cast("int").alias("cluster"), least.alias("gap"))

    return F.array(*[of_start(i, of) for i, of in enumerate(centres)])


def _literal(points: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in point]) for point in points])


def _per_start(df: DataFrame, columns: list[str], centres: list[np.ndarray], *kept: str) -> DataFrame:
    return df.select(*kept, *columns, F.inline(_nearest(columns, centres)))


def lloyd(df: DataFrame, columns: list[str], centres: np.ndarray, steps: int = STEPS, tolerance: float = TOLERANCE) -> Starts:
    """Moves the centres of all starts to the means of their rows until none moves by more than `tolerance`, or for `steps` steps.

    A centre without rows stays where it is. Rows with a null in a column take no part. One job a step; starts that stand still are
    not computed again, and one more job takes the costs.
    """
    rows = df.dropna(subset=columns)
    centres = np.array(centres, dtype=float)
    moving = list(range(len(centres)))
    for _ in range(steps):
        if not moving:
            break
        sums = _per_start(rows, columns, list(centres[moving])).groupBy("start", "cluster").agg(*[F.avg(c).alias(c) for c in columns])
        before = centres.copy()
        for found in sums.collect():  # a row for each start and centre
            centres[moving[found["start"]], found["cluster"]] = [found[c] for c in columns]
        shift = np.sqrt(((centres - before) ** 2).sum(axis=2)).max(axis=1)
        moving = [i for i in moving if shift[i] > tolerance]
    costs = np.zeros(len(centres))
    for found in _per_start(rows, columns, list(centres)).groupBy("start").agg(F.sum("gap").alias("cost")).collect():
        costs[found["start"]] = found["cost"]
    return Starts(columns, centres, costs)


def seeded(df: DataFrame, columns: list[str], key: str, k: int, starts: int, seed: int = 0) -> np.ndarray:
    """Centres by parallel seeding, all starts side by side: in each round a row becomes a candidate with a probability that grows with its
    distance from the candidates before; candidates weigh as many rows as are nearest to them, and k of them are drawn on the driver.

    Chance is a hash of the key, so the same rows give the same centres on any partitioning. `key` is unique.
    """
    rows = df.dropna(subset=columns)
    firsts = rows.select(*[F.min_by(F.array(*columns), F.xxhash64(key, F.lit(seed), F.lit(i))).alias(f"s{i}") for i in range(starts)]).first()
    if firsts[0] is None:
        raise ValueError("no rows to cluster")
    held = [np.array([list(map(float, firsts[i]))]) for i in range(starts)]
    for turn in range(SEEDING_ROUNDS):
        near = _per_start(rows, columns, held, key)
        costs = {r["start"]: r["cost"] for r in near.groupBy("start").agg(F.sum("gap").alias("cost")).collect()}
        total = F.element_at(F.array(*[F.lit(float(costs[i])) for i in range(starts)]), F.col("start") + 1)
        chance = F.pmod(F.xxhash64(key, F.lit(seed), "start", F.lit(turn)), F.lit(1 << 53)) / float(1 << 53)
        drawn = near.filter(chance * total < OVERSAMPLING * k * F.col("gap")).select("start", *columns)
        for found in drawn.orderBy("start", *columns).collect():  # about OVERSAMPLING * k rows a start
            held[found["start"]] = np.vstack([held[found["start"]], [float(found[c]) for c in columns]])
    weights = _per_start(rows, columns, held).groupBy("start", "cluster").agg(F.count(F.lit(1)).alias("n")).collect()
    drawn = []
    for i in range(starts):
        weight = np.zeros(len(held[i]))
        for found in weights:
            if found["start"] == i:
                weight[found["cluster"]] = found["n"]
        drawn.append(_drawn(held[i], weight, k, np.random.default_rng([seed, i])))
    return np.array(drawn)


def _drawn(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted points: each next one by its weight times the squared distance from those drawn before."""
    chosen = [rng.choice(len(points), p=weight / weight.sum())]
    while len(chosen) < k:
        gaps = ((points[:, None, :] - points[None, chosen, :]) ** 2).sum(axis=2).min(axis=1) * weight
        # Fewer distinct points than centres: the rest repeats one and stays without rows.
        chosen.append(rng.choice(len(points), p=gaps / gaps.sum()) if gaps.sum() > 0 else chosen[0])
    return points[chosen]


def kmeans(df: DataFrame, columns: list[str], key: str, k: int, starts: int = 10, seed: int = 0) -> Starts:
    """Seeding and steps for all starts; a pass over the rows for each step, whatever the number of starts."""
    rows = df.select(key, *columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return lloyd(rows, columns, seeded(rows, columns, key, k, starts, seed))
    finally:
        rows.unpersist()
