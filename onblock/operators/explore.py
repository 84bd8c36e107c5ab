"""Exploration aggregates: rates, overviews, correlations, distributions, universes of codes."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.operators.ranks import exact_quantiles

Threshold = int | Column


def flown(trips: DataFrame) -> DataFrame:
    """Trips that were not cancelled."""
    return trips.filter(F.col("cancelled") == 0)


def delay_rate(trips: DataFrame, key: str, min_trips: Threshold | None = None) -> DataFrame:
    """Share of late arrivals (`rate`) and number of flown trips (`n`) per key, keys with more than `min_trips` only."""
    rates = flown(trips).groupBy(key).agg(F.avg("arr_del15").alias("rate"), F.count(F.lit(1)).alias("n"))
    return rates if min_trips is None else rates.filter(F.col("n") > min_trips)


def rate_by_hour(trips: DataFrame) -> DataFrame:
    return delay_rate(trips, "dep_hour").orderBy("dep_hour")


def rate_by_weekday(trips: DataFrame) -> DataFrame:
    return delay_rate(trips, "day_of_week").drop("n").orderBy("day_of_week")


def rate_by_month(trips: DataFrame) -> DataFrame:
    return delay_rate(trips, "month").drop("n").orderBy("month")


def rate_by_airline(trips: DataFrame, min_trips: Threshold = 50_000) -> DataFrame:
    return delay_rate(trips, "airline", min_trips).orderBy(F.desc("rate"), "airline")


def volume_vs_rate(trips: DataFrame, min_trips: Threshold = 30_000) -> DataFrame:
    return delay_rate(trips, "origin", min_trips).orderBy(F.desc("n"), "origin")


def overview_rates(trips: DataFrame) -> DataFrame:
    """Late arrival, late departure, cancellation and diversion shares of the whole table."""
    return trips.agg(
        F.round(F.avg("arr_del15"), 3).alias("late_arrival"),
        F.round(F.avg("dep_del15"), 3).alias("late_departure"),
        F.round(F.avg("cancelled"), 4).alias("cancelled_share"),
        F.round(F.avg("diverted"), 4).alias("diverted_share"),
    )


def null_shares(df: DataFrame, columns: list[str] | None = None, digits: int = 3) -> DataFrame:
    """Share of missing values per column, one output column each."""
    return df.agg(
        *[F.round(F.avg(F.col(c).isNull().cast("int")), digits).alias(f"null_{c}") for c in columns or df.columns]
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("n_distinct"))


def preview(df: DataFrame, columns: list[str], order: list[str], n: int = 5) -> DataFrame:
    """The first rows in a fixed order."""
    return df.select(*columns).orderBy(*order).limit(n)


def correlation(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Pearson correlation per named pair, all in one pass."""
    return df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(n) for n, (a, b) in pairs.items()])


def correlation_matrix(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """Full matrix in long form (`a`, `b`, `r`), from one pass over pairwise complete rows."""
    names = {f"{a}|{b}": (a, b) for a, b in combinations(columns, 2)}
    names |= {f"{c}|{c}": (c, c) for c in columns}
    row = correlation(df, names)
    cells = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.round(F.col(f"`{name}`"), digits).alias("r"))
        for name, (a, b) in names.items()
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def describe(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a column."""
    quartiles = exact_quantiles(df, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    q = quartiles.select(F.struct("q25", "q50", "q75")).scalar()
    stats = df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ).withColumn("q", q)
    return stats.select(
        "count",
        *[F.round(c, digits).alias(c) for c in ("mean", "std", "min")],
        *[F.round(f"q.{c}", digits).alias(c) for c in ("q25", "q50", "q75")],
        F.round("max", digits).alias("max"),
    )


def histogram(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """Equal-width bins between the extremes; the last bin is closed on both sides; empty bins are absent.

    Equal extremes are widened by a half to both sides, so a constant column falls into the middle.
    """
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    apart = F.when(F.col("_e.lo") == F.col("_e.hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    bin_no = F.least(F.width_bucket(F.col(column), F.col("_e.lo") - apart, F.col("_e.hi") + apart, F.lit(bins)), F.lit(bins))
    return (
        df.filter(F.col(column).isNotNull())
        .withColumn("_e", ends)
        .groupBy(bin_no.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def delay_histogram(trips: DataFrame, low: float = -60, high: float = 180, bins: int = 60) -> DataFrame:
    return histogram(flown(trips).filter(F.col("arr_delay").between(low, high)), "arr_delay", bins)


def code_universe(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Sorted distinct codes found in any of the columns."""
    parts = [df.select(F.col(c).alias(name)).distinct() for c in columns]
    codes = reduce(DataFrame.union, parts)
    codes = codes.distinct() if len(parts) > 1 else codes
    return codes.filter(F.col(name).isNotNull()).orderBy(name)


def share_of_rows(df: DataFrame, per_mille: int) -> Column:
    """A threshold that grows with the table: `per_mille` thousandths of its rows."""
    return F.floor(df.agg(F.count(F.lit(1))).scalar() * per_mille / 1000)
