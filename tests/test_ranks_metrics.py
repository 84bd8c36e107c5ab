import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from onblock.operators.metrics import (
    binary_metrics,
    calibration,
    confusion_matrix,
    performance_report,
    ranking_metrics,
    roc_curve,
    threshold_metrics,
)
from onblock.operators.ranks import exact_quantiles, running_totals, value_counts
from onblock.operators.sampling import hash_sample


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def scored(spark, rows, parts=3):
    return spark.createDataFrame(rows, "y int, s double").repartition(parts)


def test_quantiles_match_numpy(spark):
    rng = random.Random(1)
    values = [round(rng.gauss(0, 30), 1) for _ in range(777)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    row = exact_quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}).first()
    assert np.allclose(list(row), np.quantile(values, [0, 0.25, 0.5, 0.95, 1.0]))


def test_quantile_of_nothing_is_null(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", {"m": 0.5}).first()[0] is None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=200))
def test_running_totals(spark, values):
    hist = value_counts(spark.createDataFrame([(v,) for v in values], "v int"), "v")
    got = {r["value"]: (r["cum_n"], r["all_n"]) for r in running_totals(hist, "value", ["n"]).collect()}
    assert got == {v: (sum(w <= v for w in values), len(values)) for v in set(values)}


def test_auc_with_ties_equals_pair_counting(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), round(rng.random(), 1)) for _ in range(300)]
    row = ranking_metrics(scored(spark, rows), "y", "s").first()
    assert row["auc"] == pytest.approx(brute_auc(rows))
    turned = ranking_metrics(scored(spark, [(y, -s) for y, s in rows], 1), "y", "s").first()
    assert turned["auc"] == pytest.approx(1 - row["auc"])
    order = sorted(rows, key=lambda r: -r[1])
    groups, tp, seen, ap = {}, 0, 0, 0.0
    for y, s in order:
        groups.setdefault(s, []).append(y)
    for ys in groups.values():
        tp, seen = tp + sum(ys), seen + len(ys)
        ap += sum(ys) * tp / seen
    assert row["average_precision"] == pytest.approx(ap / tp)


def test_roc_area_is_the_auc(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(2), round(rng.random(), 2)) for _ in range(200)]
    points = [(0.0, 0.0)] + sorted((r["fpr"], r["tpr"]) for r in roc_curve(scored(spark, rows), "y", "s").collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(brute_auc(rows))


def test_f1_is_zero_without_hits_and_grid_is_full(spark):
    rows = [(1, 0.1), (0, 0.2)]
    assert tuple(threshold_metrics(scored(spark, rows), "y", "s", 0.9).first()) == (0.0, 0.5)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in confusion_matrix(scored(spark, rows), "y", "s", 0.9).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_constant_score_has_half_auc(spark):
    row = binary_metrics(scored(spark, [(1, 0.0), (0, 0.0), (0, 0.0)]), "y", "s", 0.3, "base").first()
    assert (row["auc"], row["f1"], row["accuracy"]) == (0.5, 0.0, 0.6667)


def test_calibration_bins_are_right_closed(spark):
    rows = [(0, 0.0), (1, 0.15), (0, 0.1500001), (1, 1.0), (1, 0.7)]
    got = {r["bin"]: r["n"] for r in calibration(scored(spark, rows), "y", "s").collect()}
    assert got == {0: 1, 1: 1, 4: 1, 5: 1}  # bins 2 and 3 are empty, score 0 is in none


def test_report_shape(spark):
    rows = [("2024-01-15", 1, 40, 0.9, 38), ("2024-01-15", 0, -5, 0.1, 2), ("2024-02-15", 0, 300, 0.2, 5)]
    replay = spark.createDataFrame(rows, "flight_date string, real int, delay int, drisk double, dpdelay int")
    row = performance_report(replay, 0.5).first()
    assert (row["n_trips"], row["n_days"], row["late_pct"], row["within_15_pct"]) == (3, 2, 33, 67)
    assert row["confusion"].asDict() == {"tp": 1, "tn": 2, "fp": 0, "fn": 0}
    assert [(b["band"], b["n"]) for b in row["calibration"]][:2] == [("0-15", 1), ("15-30", 1)]


def test_sample_is_repeatable_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    first = {r["k"] for r in hash_sample(df, 150, "k", seed=9).collect()}
    again = {r["k"] for r in hash_sample(df.repartition(7), 150, "k", seed=9, digits=1).collect()}
    assert len(first) == 150 and first == again
    assert hash_sample(df, 5000, "k").count() == 2000
    some = hash_sample(df, 150, "k", seed=9, before_filter=F.col("k") < 1000)
    assert {r["k"] for r in some.collect()} == {k for k in first if k < 1000}
