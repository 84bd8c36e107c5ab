"""`lag` inside groups of any size.

A window puts one group into one task. Vehicles without a registration share a single group per day, so a few
groups can hold a large part of the table. Those groups are cut into ranges of the sort order; each range gets
one extra row that carries the last values of the range before it, which makes the cut invisible to `lag`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Cut points travel in the plan, so their number is bounded whatever the size of the input; ranges get longer instead.
MOST_RANGES = 1_000


@dataclass(frozen=True)
class HeavyGroups:
    """A group is heavy from `min_rows` rows on. Groups are counted on their full key, whatever the size of the input."""

    min_rows: int = 2_000_000


def heavy_groups(df: DataFrame, by: list[str], spec: HeavyGroups) -> DataFrame:
    """The keys of groups that hold too many rows for one task, with their counts `n`; at most a `min_rows`-th of the rows."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= spec.min_rows)


def _position(order: list[str]) -> Column:
    """The sort key as one comparable struct, NULLS LAST."""
    return F.struct(*[part for c in order for part in (F.col(c).isNull(), F.col(c))])


def _cut_points(heavy: DataFrame, order: list[str], rows: int, ranges: int) -> list:
    sample = heavy.select(*order).sample(fraction=min(1.0, 16.0 * ranges / rows), seed=7)
    points = sample.orderBy(*[F.col(c).asc_nulls_last() for c in order]).collect()
    step = max(1, len(points) // ranges)
    return points[step::step]


def _place(points: list, order: list[str], types: dict[str, str]) -> Column:
    """How many of the sorted cut points are not above a row, by binary search."""
    cuts = F.array(
        *[
            F.struct(*[part for c, v in zip(order, p) for part in (F.lit(v is None), F.lit(v).cast(types[c]))])
            for p in points
        ]
    )
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(points).bit_length()))])
    here = _position(order)

    def narrow(at: Column, step: Column) -> Column:
        last = at + step
        return F.when((last <= len(points)) & (F.try_element_at(cuts, last) <= here), last).otherwise(at)

    return F.aggregate(steps, F.lit(0), narrow)


def lag_in_group(
    df: DataFrame, by: list[str], order: list[str], carry: dict[str, Column], heavy: HeavyGroups | None = HeavyGroups()
) -> DataFrame:
    """Adds each `carry` expression as seen on the previous row of the same `by` group in `order` (NULLS LAST).

    `order` has to be unique inside a group for a repeatable answer. All heavy groups share their cut points; there is one for every
    `min_rows` rows of theirs, so no range of a group is much larger than that, however its rows are spread. Beyond MOST_RANGES of them
    a range holds that share of the heavy rows, still sorted by Spark as a window of its own.
    """
    sort = [F.col(c).asc_nulls_last() for c in order]
    seen = F.struct(*[value.alias(name) for name, value in carry.items()])
    found = heavy_groups(df, by, heavy) if heavy else None
    rows = (found.agg(F.sum("n")).first()[0] or 0) if heavy else 0
    if not rows:
        previous = F.lag(seen).over(Window.partitionBy(*by).orderBy(*sort))
        return (
            df.withColumn("_prev", previous)
            .select("*", *[F.col(f"_prev.{name}").alias(name) for name in carry])
            .drop("_prev")
        )

    keys = found.select(*[F.col(c).alias(f"_heavy_{c}") for c in by], F.lit(True).alias("_is_heavy"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_heavy_{c}")) for c in by])
    marked = df.join(keys, same, "left").select(*df.columns, F.col("_is_heavy").isNotNull().alias("_is_heavy"))
    ranges = min(max(2, -(-rows // heavy.min_rows)), MOST_RANGES)
    points = _cut_points(marked.filter("_is_heavy"), order, rows, ranges)
    place = _place(points, order, dict(df.dtypes)) if points else F.lit(0)
    ranged = marked.withColumn("_range", F.when(F.col("_is_heavy"), place).otherwise(F.lit(0))).withColumn("_seen", seen)
    is_heavy = F.col("_is_heavy")

    last_of_range = ranged.filter(is_heavy).groupBy(*by, "_range").agg(F.max_by("_seen", _position(order)).alias("_seen"))
    before = F.lag("_seen").over(Window.partitionBy(*by).orderBy("_range"))
    guests = last_of_range.withColumn("_seen", before).filter(F.col("_seen").isNotNull()).withColumn("_guest", F.lit(True))

    everyone = ranged.withColumn("_guest", F.lit(False)).unionByName(guests, allowMissingColumns=True)
    window = Window.partitionBy(*by, "_range").orderBy(F.col("_guest").desc(), *sort)
    return (
        everyone.withColumn("_prev", F.lag("_seen").over(window))
        .filter(~F.col("_guest"))
        .select(*df.columns, *[F.col(f"_prev.{name}").alias(name) for name in carry])
    )
