import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from onblock.operators.anomaly import isolation_flags
from onblock.operators.encode import fit_settled_encoding, fit_target_encoding, fold_of, standardised
from onblock.operators.profile import PROFILE_FEATURES, cluster_hubs, cluster_profile, profile_export, silhouette


def labelled(spark, n=400):
    rng = random.Random(8)
    rows = [(i, rng.choice("abcd"), rng.choice(["x", "y", None]), float(rng.randrange(2))) for i in range(n)]
    return spark.createDataFrame(rows, "k long, c string, d string, y double")


def shrink(ys, all_ys):
    if not len(ys):
        return np.mean(all_ys)
    down = np.var(ys) + len(ys) * np.var(all_ys)
    if down == 0:
        return np.mean(all_ys)
    w = len(ys) * np.var(all_ys) / down
    return w * np.mean(ys) + (1 - w) * np.mean(all_ys)


@pytest.mark.parametrize("fit", [fit_target_encoding, fit_settled_encoding])
def test_encodings_match_the_formula(spark, fit):
    train = labelled(spark)
    encoding = fit(train, ["c", "d"], "y", "k")
    pdf = train.withColumn("fold", fold_of("k")).toPandas()
    for row in encoding.transform(train.limit(20)).collect():
        assert row["c_enc"] == pytest.approx(shrink(pdf.y[pdf.c == row["c"]], pdf.y))
    for row in encoding.transform_training(train, "k").collect()[:40]:
        fold = pdf.fold[pdf.k == row["k"]].iloc[0]
        rest = pdf[pdf.fold != fold]
        assert row["c_enc"] == pytest.approx(shrink(rest.y[rest.c == row["c"]], rest.y))
    new = spark.createDataFrame([(1, "zz", None, 0.0)], "k long, c string, d string, y double")
    got = encoding.transform(new).first()
    assert got["c_enc"] == pytest.approx(pdf.y.mean())


def test_constant_label_encodes_to_itself(spark):
    train = labelled(spark, 50).withColumn("y", F.lit(1.0))
    assert {r["c_enc"] for r in fit_target_encoding(train, ["c"], "y", "k").transform(train).collect()} == {1.0}


def test_standardised_handles_flat_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in standardised(df, ["a", "b"]).select("a_z", "b_z").orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def hubs(spark, outliers=0):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        g = i % 3
        rows.append((f"H{i:03d}", 1000 + 3000 * g + rng.randrange(99), 0.1 * (g + 1) + rng.random() / 50, 5.0 * g, 0.01 * g, 500.0 + 400 * g, "n", 1.23456, 2.0))
    for i in range(outliers):
        rows.append((f"X{i}", 60_000 + 9000 * i, 0.95, 120.0 + 30 * i, 0.6, 9000.0, "n", None, None))
    return spark.createDataFrame(
        rows, "iata string, n_flights long, delay_rate double, avg_delay double, cancel_rate double, avg_distance double, name string, lat double, lon double"
    )


def test_clusters_find_planted_groups(spark):
    clustered = cluster_hubs(hubs(spark), k=3, restarts=3).persist()
    groups = {}
    for r in clustered.collect():
        groups.setdefault(r["cluster"], set()).add(int(r["iata"][1:]) % 3)
    assert set(groups) == {0, 1, 2} and all(len(g) == 1 for g in groups.values())
    assert cluster_profile(clustered).count() == 3


@pytest.mark.parametrize("block", [20_000, 37])
def test_silhouette_matches_all_pairs(spark, block):
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(90, 2)) + np.repeat([[0, 0], [3, 0], [0, 4]], 30, axis=0)
    lab = np.repeat([0, 1, 2], 30)
    df = spark.createDataFrame([(i, float(p[0]), float(p[1]), int(c)) for i, (p, c) in enumerate(zip(pts, lab))], "i long, x double, y double, c int")
    apart = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(2))
    want = []
    for i in range(90):
        a = apart[i, lab == lab[i]].sum() / 29
        b = min(apart[i, lab == c].mean() for c in {0, 1, 2} - {lab[i]})
        want.append((b - a) / max(a, b))
    assert silhouette(df, ["x", "y"], "c", "i", block).first()[0] == pytest.approx(np.mean(want))


def test_forest_flags_planted_outliers_on_any_partitioning(spark):
    df = standardised(hubs(spark, outliers=5), PROFILE_FEATURES)
    z = [f"{c}_z" for c in PROFILE_FEATURES]
    flags = isolation_flags(df, z, "iata", trees=60).filter("anomaly = 1")
    found = {r["iata"]: r["anomaly_score"] for r in flags.collect()}
    assert set(found) == {f"X{i}" for i in range(5)} or len(set(found) & {f"X{i}" for i in range(5)}) >= 4
    again = isolation_flags(df.repartition(6), z, "iata", trees=60).filter("anomaly = 1")
    assert {r["iata"] for r in again.collect()} == set(found)


def test_export_drops_hubs_without_coordinates(spark):
    rows = profile_export(hubs(spark, outliers=1)).collect()
    assert len(rows) == 120 and rows[0]["lat"] == 1.235
