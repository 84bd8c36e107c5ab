"""Running totals and exact quantiles without a single-task sort.

Both start from a histogram (one row per distinct value, combined before the shuffle). The histogram is cut into
ranges at approximate quantiles; ranges are summed, the few range totals are accumulated, and each range then
accumulates its own rows from that offset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 64
SHARES = [repr(i / RANGES) for i in range(1, RANGES)]
# Binary search: how many of the RANGES - 1 sorted cuts lie below a value. Never null, or a null check would be
# derived for the join below and travel through the histogram down to the raw rows.
PLACE = "coalesce(aggregate(array(32, 16, 8, 4, 2, 1), 0, (at, step) -> if(_cuts[at + step - 1] < {0}, at + step, at)), 0)"


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Distinct non-null values of a column with their (weighted) number of rows, as `value` and `n`."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(n.alias("n"))


def running_totals(
    hist: DataFrame, order: str, sums: list[str], descending: bool = False, by: list[str] | None = None
) -> DataFrame:
    """Adds `cum_<name>` and `all_<name>` for every name in `sums`.

    Sums accumulate along `order`, which must be unique per `by` group; the groups are few and may have null keys.
    """
    by = by or []
    cuts = F.expr(f"percentile_approx({order}, array({', '.join(SHARES)}), 10000)").alias("at")
    overview = hist.agg(F.struct(cuts, *[F.sum(name).alias(name) for name in sums])).scalar()
    ranged = (
        hist.withColumn("_all", overview)
        .withColumn("_cuts", F.col("_all.at"))
        .withColumn("_range", F.expr(PLACE.format(order)))
        .drop("_cuts")
    )

    def along(name: str):
        return F.col(name).desc() if descending else F.col(name).asc()

    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(name).alias(f"_total_{name}") for name in sums])
    # At most RANGES rows per group, so one task accumulates them at once.
    before = Window.partitionBy(*by).orderBy(along("_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_total_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in sums],
        *[F.sum(f"_total_{name}").over(whole).alias(f"all_{name}") for name in sums],
    )
    within = Window.partitionBy(*by, "_range").orderBy(along(order)).rowsBetween(Window.unboundedPreceding, 0)
    keys = [*by, "_range"]
    sides = offsets.withColumnsRenamed({c: f"_of_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys])
    summed = ranged.join(F.broadcast(sides), same).select(
        *hist.columns,
        *[(F.col(f"_before_{name}") + F.sum(name).over(within)).alias(f"cum_{name}") for name in sums],
        *[f"all_{name}" for name in sums],
        "_all",
    )
    # True for any number, also negative or fractional, and for null. It makes each of the three uses of `hist` read every sum, so that
    # they stay the same plan and Spark computes the histogram once, whichever sums the caller selects.
    for name in sums:
        summed = summed.filter(F.coalesce(F.abs(F.col(f"cum_{name}") - F.col(f"_all.{name}")) >= 0, F.lit(True)))
    return summed.drop("_all")


def quantiles_of_counts(counts: DataFrame, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles, one column per entry of `probs`, from a `value`/`n` histogram.

    One row, or one row per `by` group; the groups are few.
    """
    by = by or []
    ranked = running_totals(counts, "value", ["n"], by=by)
    picks = []
    for name, p in probs.items():
        spot = f"((all_n - 1) * {float(p)!r}D)"
        at = "max(CASE WHEN cum_n - n <= {0} AND {0} < cum_n THEN value END)"
        picks.append(
            F.expr(
                f"{at.format(f'floor({spot})')} + ({at.format(f'ceil({spot})')} - {at.format(f'floor({spot})')})"
                f" * max({spot} - floor({spot}))"
            ).alias(name)
        )
    return ranked.groupBy(*by).agg(*picks)


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float]) -> DataFrame:
    return quantiles_of_counts(value_counts(df, column), probs)


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column `median`; use `.scalar()` to put it into an expression."""
    return exact_quantiles(df, column, {"median": 0.5})
