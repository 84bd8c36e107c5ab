"""Route table and coordinate exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.operators.weather import MEASURES, fill_weather, medians
from onblock.plans.frames import completed, with_crosses

# The calendar a route is scored for.
ROUTE_MONTH, ROUTE_WEEKDAY = 7, 4
ROUTE_COLUMNS = ["origin", "dest", "ocity", "dcity", "olat", "olon", "dlat", "dlon", "distance", "crs_elapsed", "airline", "n"]


def with_endpoints(df: DataFrame, airports: DataFrame) -> DataFrame:
    """City and coordinates of both ends; rows with an unknown end are lost."""
    o = airports.select(F.col("iata").alias("_o"), F.col("city").alias("ocity"), F.col("lat").alias("olat"), F.col("lon").alias("olon"))
    d = airports.select(F.col("iata").alias("_d"), F.col("city").alias("dcity"), F.col("lat").alias("dlat"), F.col("lon").alias("dlon"))
    return df.join(o, F.col("origin") == F.col("_o")).join(d, F.col("dest") == F.col("_d")).drop("_o", "_d")


def route_rollup(trips: DataFrame, min_trips: int | Column = 800) -> DataFrame:
    """Trips, rounded means, median hour and most frequent carrier per busy route.

    Plain sums per route, carrier and hour combine before the shuffle; median and mode then read those few cells.
    """
    route = ["origin", "dest"]
    cells = completed(trips).groupBy(*route, "airline", "dep_hour").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{k}_{c}") for c in ("distance", "crs_elapsed") for k, f in (("s", F.sum), ("n", F.count))],
    )
    totals = cells.groupBy(*route).agg(
        F.sum("n").alias("n"),
        *[F.round(F.try_divide(F.sum(f"s_{c}"), F.sum(f"n_{c}"))).alias(c) for c in ("distance", "crs_elapsed")],
        F.bround(F.percentile("dep_hour", 0.5, F.col("n"))).cast("int").alias("dep_hour"),
    )
    shares = cells.groupBy(*route, "airline").agg(F.sum("n").alias("m"))
    carriers = shares.groupBy(*route).agg(
        F.min_by("airline", F.struct(F.col("airline").isNull(), -F.col("m"), "airline")).alias("airline")
    )
    return totals.filter(F.col("n") > min_trips).join(carriers, route)


def route_table(
    trips: DataFrame,
    airports: DataFrame,
    clim: DataFrame,
    min_trips: int | Column = 800,
    k: int = 700,
    month: int = ROUTE_MONTH,
) -> DataFrame:
    """The `k` busiest routes with their ends and the origin's climatology of one month."""
    typical = clim.filter(F.col("month") == month).select(F.col("iata").alias("_ci"), *MEASURES)
    ends = with_endpoints(route_rollup(trips, min_trips), airports)
    top = ends.orderBy(F.desc("n"), "origin", "dest").limit(k)
    return top.join(typical, F.col("origin") == F.col("_ci"), "left").drop("_ci")


def route_features(table: DataFrame, month: int = ROUTE_MONTH, weekday: int = ROUTE_WEEKDAY) -> DataFrame:
    """Routes as model input: constant calendar, crosses, weather gaps filled from the table itself."""
    filled = fill_weather(with_crosses(table), medians(table))
    return filled.withColumns({"month": F.lit(month), "day_of_week": F.lit(weekday)})


def coords_lookup(airports: DataFrame, known: DataFrame) -> DataFrame:
    """Coordinates as [lat, lon] to 4 places and [lon, lat] to 3, with the city, for airports among the known codes."""
    kept = airports.join(known.select("iata"), "iata", "left_semi")
    return kept.select(
        "iata",
        "city",
        F.array(F.bround("lat", 4), F.bround("lon", 4)).alias("lat_lon"),
        F.array(F.bround("lon", 3), F.bround("lat", 3)).alias("lon_lat"),
    )
