"""Daily weather: cleaning, climatology, enrichment of trips, imputation, forecast rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.operators.ranks import quantiles_of_counts

MEASURES = ["prcp", "snow", "wspd", "tavg"]
ZERO_FILLED = ["prcp", "snow"]
MEDIAN_FILLED = ["wspd", "tavg"]

# Climatology without any station, and what a missing or zero forecast becomes.
GLOBAL_FALLBACK = {"prcp": 0.0, "snow": 0.0, "wspd": 15.0, "tavg": 15.0}
ARCHIVE_AGE_DAYS = 5


def served_airports(airports: DataFrame, trips: DataFrame) -> DataFrame:
    """Airports that at least one trip leaves from."""
    return airports.join(trips.select(F.col("origin").alias("iata")).distinct(), "iata", "left_semi")


def medians(readings: DataFrame, weight: str | None = None) -> Column:
    """Struct of exact medians of the median-filled measures, as a scalar subquery.

    All measures share one histogram. `readings` is small when a weight stands for the rows of a big table behind it.
    """
    n = F.lit(1) if weight is None else F.col(weight)
    long = readings.select(n.alias("w"), F.explode(_by_name(MEDIAN_FILLED)).alias("name", "value"))
    counts = long.filter("value is not null").groupBy("name", "value").agg(F.sum("w").alias("n"))
    found = quantiles_of_counts(counts, {"median": 0.5}, by=["name"])
    return found.agg(F.struct(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(c) for c in MEDIAN_FILLED])).scalar()


def _by_name(columns: list[str]) -> Column:
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])


def fill_weather(df: DataFrame, middle: Column) -> DataFrame:
    """Missing rain and snow are zero; missing wind and temperature take the given medians."""
    filled = {c: F.coalesce(c, F.lit(0.0)) for c in ZERO_FILLED}
    filled |= {c: F.coalesce(F.col(c), F.col(f"_mid.{c}")) for c in MEDIAN_FILLED}
    return df.withColumn("_mid", middle).withColumns(filled).drop("_mid")


def clean_weather(
    raw: DataFrame, airports: DataFrame, trips: DataFrame, start: str = "2024-01-01", end: str = "2024-12-31"
) -> DataFrame:
    """Readings of served airports in a date range, gaps filled with zero or the median of those readings."""
    day = F.col("date")
    kept = raw.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    kept = kept.join(served_airports(airports, trips).select("iata"), "iata", "left_semi")
    return fill_weather(kept, medians(kept)).select("iata", "date", *MEASURES)


def climatology(weather: DataFrame) -> DataFrame:
    """Mean reading per airport and calendar month."""
    return weather.groupBy("iata", F.month("date").alias("month")).agg(*[F.avg(c).alias(c) for c in MEASURES])


def rounded_climatology(clim: DataFrame, digits: int = 2) -> DataFrame:
    """The exported climatology: means rounded half-even.

    Noise of the summation order is rounded away first, so ties fall the same way on any partitioning.
    """
    return clim.select("iata", "month", *[F.bround(F.round(c, 9), digits).alias(c) for c in MEASURES])


def climatology_map(clim: DataFrame) -> DataFrame:
    """One row per key `IATA_month` with its four rounded means."""
    r = rounded_climatology(clim)
    return r.select(
        F.concat_ws("_", "iata", F.col("month").cast("string")).alias("key"), F.array(*MEASURES).alias("means")
    )


def global_climatology(clim: DataFrame) -> DataFrame:
    """Unweighted mean over all rounded airport months; fixed values where there are none."""
    r = rounded_climatology(clim)
    return r.agg(*[F.coalesce(F.bround(F.round(F.avg(c), 9), 2), F.lit(GLOBAL_FALLBACK[c])).alias(c) for c in MEASURES])


def with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips with the readings of their origin on their day; trips without readings are kept."""
    side = weather.select(F.col("iata").alias("_iata"), F.col("date").alias("_date"), *MEASURES)
    match = (F.col("origin") == F.col("_iata")) & (F.col("flight_date") == F.col("_date"))
    return trips.join(side, match, "left").drop("_iata", "_date")


def frame_medians(trips: DataFrame, weather: DataFrame) -> Column:
    """Medians over the trips' own readings: trips are counted per origin and day before they meet the weather."""
    loads = trips.groupBy("origin", "flight_date").agg(F.count(F.lit(1)).alias("_trips"))
    return medians(with_weather(loads, weather), weight="_trips")


def with_imputed_weather(trips: DataFrame, weather: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Weather-enriched trips without gaps. Medians come from `reference` trips if given (e.g. the training part)."""
    middle = frame_medians(trips if reference is None else reference, weather)
    return fill_weather(with_weather(trips, weather), middle)


def forecast_normalised(raw: DataFrame) -> DataFrame:
    """Provider readings to model inputs: missing or zero wind and temperature become 15, snowfall cm become mm."""

    def known(c: str, default: float) -> Column:
        return F.when(F.col(c).isNull() | (F.col(c) == 0), F.lit(default)).otherwise(F.col(c))

    return raw.withColumns(
        {
            "prcp": known("prcp", 0.0),
            "snow": known("snow", 0.0) * 10,
            "wspd": known("wspd", GLOBAL_FALLBACK["wspd"]),
            "tavg": known("tavg", GLOBAL_FALLBACK["tavg"]),
        }
    )


def forecast_source(date: Column | str, reference_date: str | dt.date | Column) -> Column:
    """`archive` for days more than five days before the reference date, else `forecast`."""
    date = F.col(date) if isinstance(date, str) else date
    reference = reference_date if isinstance(reference_date, Column) else F.lit(reference_date).cast("date")
    return F.when(date < F.date_sub(reference, ARCHIVE_AGE_DAYS), "archive").when(date.isNotNull(), "forecast")


def request_weather(requests: DataFrame, weather: DataFrame, clim: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Readings for score requests: the dated ones, else the airport's month, else the overall mean.

    Dated readings are normalised as provider readings are, so a missing or zero wind or temperature becomes 15 and snowfall is in
    millimetres. With `airports`, a dated reading only counts for an origin with known coordinates.
    """
    if airports is not None:
        known = airports.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("iata")
        weather = weather.join(known, "iata", "left_semi")
    dated = forecast_normalised(weather).select(
        F.col("iata").alias("_wi"), F.col("date").alias("_wd"), F.struct(*MEASURES).alias("_dated")
    )
    typical = rounded_climatology(clim).select(
        F.col("iata").alias("_ci"), F.col("month").alias("_cm"), F.struct(*MEASURES).alias("_typical")
    )
    overall = global_climatology(clim).select(F.struct(*MEASURES)).scalar()
    joined = requests.join(dated, (F.col("origin") == F.col("_wi")) & (F.col("date") == F.col("_wd")), "left").join(
        typical, (F.col("origin") == F.col("_ci")) & (F.col("month") == F.col("_cm")), "left"
    )
    from onblock.functions.labels import WEATHER_REAL, WEATHER_TYPICAL

    return (
        joined.withColumn("meteo", F.coalesce("_dated", "_typical", overall))
        .withColumn(
            "meteo_source", F.when(F.col("_dated").isNotNull(), WEATHER_REAL).otherwise(WEATHER_TYPICAL)
        )
        .drop("_wi", "_wd", "_dated", "_ci", "_cm", "_typical")
    )
