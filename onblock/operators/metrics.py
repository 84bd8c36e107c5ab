"""Evaluation of scores: exact ranking metrics, threshold metrics, calibration, minutes."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.functions.labels import clip_delay
from onblock.operators.ranks import running_totals

# Edges of the calibration table and of the report's risk bands.
CALIBRATION_EDGES = [0, 0.15, 0.25, 0.35, 0.5, 0.7, 1.01]
REPORT_BANDS = [(0.0, 0.15, "0-15"), (0.15, 0.30, "15-30"), (0.30, 0.50, "30-50"), (0.50, 0.75, "50-75"), (0.75, 1.01, "75-100")]
MINUTES_TOLERANCE = 15


def ranked_scores(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score, from high to low in meaning: `pos`, `neg` and running `cum_pos`, `cum_neg`."""
    y = F.col(label)
    hist = (
        scored.filter(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )
    return running_totals(hist, "score", ["pos", "neg"], descending=True)


def ranking_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """`auc` (ties count half) and `average_precision` (step sum), both exact, from one histogram."""
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    steps = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    positives, negatives = F.sum("pos"), F.sum("neg")
    return ranked_scores(scored, label, score).agg(
        F.try_divide(area, positives * negatives).alias("auc"),
        F.try_divide(steps, positives).alias("average_precision"),
    )


def roc_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """`score`, `fpr`, `tpr` at every distinct score."""
    return ranked_scores(scored, label, score).select(
        "score", F.try_divide("cum_neg", "all_neg").alias("fpr"), F.try_divide("cum_pos", "all_pos").alias("tpr")
    )


def confusion_counts(label: str, score: str, threshold: Column | float) -> list[Column]:
    hit, truth = F.col(score) >= threshold, F.col(label) == 1
    return [
        F.count_if(hit & truth).alias("tp"),
        F.count_if(~hit & ~truth).alias("tn"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
    ]


def threshold_metrics(scored: DataFrame, label: str, score: str, threshold: Column | float) -> DataFrame:
    """`f1` and `accuracy` when everything at or above the threshold is called late; F1 is 0 without any hit."""
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = known.withColumn("_t", threshold if isinstance(threshold, Column) else F.lit(threshold)).agg(
        *confusion_counts(label, score, F.col("_t"))
    )
    return counts.select(
        F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)).alias("f1"),
        F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("accuracy"),
    )


def confusion_matrix(scored: DataFrame, label: str, score: str, threshold: Column | float) -> DataFrame:
    """Rows (`actual`, `predicted`, `n`) of the full two by two grid."""
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = known.withColumn("_t", threshold if isinstance(threshold, Column) else F.lit(threshold)).agg(
        *confusion_counts(label, score, F.col("_t"))
    )
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    grid = F.array(
        *[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells]
    )
    return counts.select(F.explode(grid).alias("cell")).select("cell.*")


def right_closed_bin(score: Column, edges: list[float]) -> Column:
    """Number of the bin (lo, hi] a score falls into, from 0; null outside all bins."""
    bins = F.lit(None).cast("int")
    for i, (lo, hi) in reversed(list(enumerate(pairwise(edges)))):
        bins = F.when((score > lo) & (score <= hi), i).otherwise(bins)
    return bins


def calibration(scored: DataFrame, label: str, score: str, edges: list[float] | None = None) -> DataFrame:
    """Mean score and late share per right-closed score bin; empty bins are absent, a score of 0 is in none."""
    binned = scored.withColumn("bin", right_closed_bin(F.col(score), edges or CALIBRATION_EDGES))
    return (
        binned.filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.avg(score).alias("predicted"), F.avg(label).alias("actual"), F.count(F.lit(1)).alias("n"))
    )


def mean_calibration(scored: DataFrame, label: str, score: str) -> DataFrame:
    return scored.agg(F.avg(score).alias("mean_predicted"), F.avg(label).alias("mean_actual"))


def mae_minutes(scored: DataFrame, delay: str, minutes: str) -> DataFrame:
    """Mean absolute error against the bounded delay."""
    return scored.agg(F.avg(F.abs(clip_delay(delay) - F.col(minutes))).alias("mae"))


def base_rate(train: DataFrame, label: str) -> Column:
    """Late share of the training rows, which is the decision threshold."""
    return train.agg(F.avg(label)).scalar()


def binary_metrics(scored: DataFrame, label: str, score: str, threshold: Column | float, name: str) -> DataFrame:
    """One row of the model comparison: rounded AUC, PR-AUC, F1 and accuracy."""
    ranking = ranking_metrics(scored, label, score).select(F.struct("*")).scalar()
    return threshold_metrics(scored, label, score, threshold).withColumn("_r", ranking).select(
        F.lit(name).alias("model"),
        F.round("_r.auc", 4).alias("auc"),
        F.round("_r.average_precision", 4).alias("pr_auc"),
        F.round("f1", 4).alias("f1"),
        F.round("accuracy", 4).alias("accuracy"),
    )


def performance_report(
    replay: DataFrame, threshold: Column | float, risk: str = "drisk", minutes: str = "dpdelay"
) -> DataFrame:
    """Report over scored days in one pass: counts, percentages, confusion struct and the five risk bands."""
    near = F.abs(F.col(minutes) - clip_delay("delay")) <= MINUTES_TOLERANCE
    in_band = [(F.col(risk) >= lo) & (F.col(risk) < hi) for lo, hi, _ in REPORT_BANDS]
    counts = replay.withColumn("_t", threshold if isinstance(threshold, Column) else F.lit(threshold)).agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.count_distinct("flight_date").alias("n_days"),
        F.avg("real").alias("late"),
        F.avg(near.cast("int")).alias("near"),
        *confusion_counts("real", risk, F.col("_t")),
        *[F.count_if(b).alias(f"n_{i}") for i, b in enumerate(in_band)],
        *[F.avg(F.when(b, F.col("real"))).alias(f"late_{i}") for i, b in enumerate(in_band)],
    )

    def percent(share: Column) -> Column:
        return F.bround(share * 100).cast("int")

    bands = [
        F.struct(F.lit(name).alias("band"), percent(F.col(f"late_{i}")).alias("actual"), F.col(f"n_{i}").alias("n"))
        for i, (_, _, name) in enumerate(REPORT_BANDS)
    ]
    return counts.select(
        "n_trips",
        "n_days",
        percent(F.col("late")).alias("late_pct"),
        percent(F.col("near")).alias("within_15_pct"),
        percent(F.try_divide("tp", F.col("tp") + F.col("fp"))).alias("precision_pct"),
        percent(F.try_divide("tp", F.col("tp") + F.col("fn"))).alias("recall_pct"),
        F.struct("tp", "tn", "fp", "fn").alias("confusion"),
        F.array(*bands).alias("calibration"),
    )
