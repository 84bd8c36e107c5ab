import numpy as np
import pytest

from onblock.operators.kmeans import kmeans, lloyd, seeded

COLUMNS = ["x", "y"]


def groups(seed=0, n=60):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(at, 0.3, (n, 2)) for at in [(0, 0), (5, 0), (0, 5), (6, 6)]])


def frame(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "i long, x double, y double")


def plain(points, centres, steps):
    centres = np.array(centres, dtype=float)
    for _ in range(steps):
        near = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([points[near == j].mean(0) if (near == j).any() else c for j, c in enumerate(centres)])
    gaps = ((points[:, None] - centres[None]) ** 2).sum(2)
    return centres, gaps.min(1).sum(), gaps.argmin(1)


@pytest.mark.parametrize("steps", [0, 1, 4])
def test_steps_of_all_starts_equal_each_on_its_own(spark, steps):
    points = groups()
    begun = np.array([points[[0, 1, 2, 3]], points[[5, 70, 130, 200]], [[0, 0], [0, 0], [99, 99], [5, 5]]])
    found = lloyd(frame(spark, points), COLUMNS, begun, steps, 0.0)
    for i, start in enumerate(begun):
        centres, cost, near = plain(points, start, steps)
        assert found.centres[i] == pytest.approx(centres) and found.costs[i] == pytest.approx(cost)
        got = {r["i"]: r["cluster"] for r in found.assign(frame(spark, points), i).collect()}
        assert [got[j] for j in range(len(points))] == near.tolist()


def test_best_start_is_no_worse_than_separate_fits(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    df = frame(spark, groups(3))
    ready = VectorAssembler(inputCols=COLUMNS, outputCol="f").transform(df)
    separate = min(KMeans(k=4, seed=s, featuresCol="f").fit(ready).summary.trainingCost for s in range(3))
    found = kmeans(df, COLUMNS, "i", 4, starts=6)
    assert found.costs.min() <= separate * (1 + 1e-6)


def test_seeds_do_not_depend_on_partitions(spark):
    df = frame(spark, groups(4))
    assert seeded(df, COLUMNS, "i", 3, 2).tolist() == seeded(df.repartition(7), COLUMNS, "i", 3, 2).tolist()


def test_few_points_repeated_points_and_nulls(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, 1.0, 1.0), (2, None, 1.0), (3, 2.0, 2.0)], "i long, x double, y double")
    found = kmeans(df, COLUMNS, "i", 4, starts=3)
    assert found.costs.min() == 0.0
    near = {r["i"]: r["cluster"] for r in found.assign(df).collect()}
    assert near[0] == near[1] != near[3] and near[2] is None
    with pytest.raises(ValueError):
        kmeans(df.filter("i = 2"), COLUMNS, "i", 2)
