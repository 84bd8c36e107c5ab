"""Shapes the generated star schema into the trip, airport, weather and request tables of the library.

Every column is a deterministic expression of one `events` or `nation` row, so the same tables can be written in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_DATE = "2024-01-25"
REFERENCE_DAY = 15


def _k() -> Column:
    """The number in `{"k": n}`. Filters repeat this expression per condition, so it avoids a JSON parse."""
    return F.expr("cast(rtrim('}', substr(props, 7)) as int)")


def trips_from_events(events: DataFrame) -> DataFrame:
    """One trip per event; works on batch and streaming frames alike."""
    hub = F.expr("cast(floor((event_id % 25) * (floor(event_id / 25) % 25) / 24) as int)")
    flown = ~F.col("k").isin(13, 14)
    return (
        events.withColumn("k", _k())
        .withColumn("hub", hub)
        .select(
            F.col("event_id").alias("flight_id"),
            F.to_date("ts").alias("flight_date"),
            F.month("ts").alias("month"),
            (F.weekday("ts") + 1).alias("day_of_week"),
            F.hour("ts").alias("dep_hour"),
            (F.hour("ts") * 60 + F.minute("ts")).alias("dep_min"),
            F.format_string("%02d00-%02d59", F.hour("ts"), F.hour("ts")).alias("dep_block"),
            F.col("event_type").alias("airline"),
            F.col("user_id").cast("string").alias("tail"),
            F.concat(F.lit("A"), F.lpad(F.col("hub").cast("string"), 2, "0")).alias("origin"),
            F.concat(F.lit("A"), F.lpad(((F.col("hub") + 1 + F.col("k") % 24) % 25).cast("string"), 2, "0")).alias("dest"),
            (200 + 20 * F.col("k")).alias("distance"),
            F.when(F.col("k") % 50 != 7, 40 + 2 * F.col("k")).alias("crs_elapsed"),
            (F.col("k") == 13).cast("int").alias("cancelled"),
            (F.col("k") == 14).cast("int").alias("diverted"),
            F.when(flown, F.col("value") - 35).alias("arr_delay"),
            F.when(flown, (F.col("value") - 35 >= 15).cast("int")).alias("arr_del15"),
            F.when(F.col("k") != 13, (F.col("value") - 38 >= 15).cast("int")).alias("dep_del15"),
        )
    )


def airports_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return (
        nation.filter(key != 24)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.concat(F.lit("A"), F.lpad(key.cast("string"), 2, "0")).alias("iata"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("city"),
            F.lit("US").alias("country"),
            (25 + (key * 7) % 24).cast("double").alias("lat"),
            (-120 + (key * 13) % 50).cast("double").alias("lon"),
        )
    )


def weather_from_airports(airports: DataFrame, trips: DataFrame) -> DataFrame:
    """Daily readings per airport over the trip period, with holes in rows and in columns."""
    span = trips.agg(F.struct(F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi")).alias("span")).scalar()
    n, d = F.col("n"), F.col("d")
    return (
        airports.select("iata", F.substring("iata", 2, 2).cast("int").alias("n"), span.alias("span"))
        .select("iata", "n", F.explode(F.sequence("span.lo", "span.hi")).alias("date"))
        .withColumn("d", F.dayofmonth("date"))
        .filter((n + d) % 11 != 0)
        .select(
            "iata",
            "date",
            F.when((n + d) % 17 != 0, ((31 * n + 17 * d) % 200) / 10).alias("prcp"),
            F.when((n + d) % 9 == 0, ((n + d) % 40) / 10).alias("snow"),
            F.when((3 * n + d) % 13 != 0, (5 + (5 * n + 3 * d) % 40).cast("double")).alias("wspd"),
            F.when((n + 2 * d) % 19 != 0, (-5 + (3 * n + d) % 30).cast("double")).alias("tavg"),
        )
    )


def requests_from_trips(trips: DataFrame) -> DataFrame:
    """Each trip asked again as a score request, with the optional fields left out in turn."""
    k = ((F.col("distance") - 200) / 20).cast("int")
    return trips.select(
        F.col("flight_id").alias("request_id"),
        "airline",
        "origin",
        "dest",
        "month",
        "day_of_week",
        "dep_hour",
        F.when(k % 3 != 0, F.col("distance")).alias("distance"),
        F.when(k % 4 != 0, F.col("crs_elapsed")).alias("crs_elapsed"),
        F.when(k % 2 == 0, F.col("arr_delay").cast("int")).alias("prev_arr_delay"),
        F.when(k % 5 != 0, F.col("flight_date")).alias("date"),
    )


def replay_from_trips(trips: DataFrame, airports: DataFrame) -> DataFrame:
    """Scored-trip rows with rule-made risks in place of model output, for checking the replay operators."""
    ends = airports.select("iata", "lat", "lon")
    a, b = ends.alias("a"), ends.alias("b")
    kept = trips.filter("cancelled = 0 and diverted = 0 and crs_elapsed is not null and arr_del15 is not null")
    return (
        kept.join(a, F.col("origin") == F.col("a.iata"))
        .join(b, F.col("dest") == F.col("b.iata"))
        .select(
            "flight_id",
            "flight_date",
            F.col("origin").alias("o"),
            F.col("dest").alias("d"),
            F.col("airline").alias("al"),
            F.col("a.lon").alias("ox"),
            F.col("a.lat").alias("oy"),
            F.col("b.lon").alias("dx"),
            F.col("b.lat").alias("dy"),
            F.col("dep_min").alias("dep"),
            F.col("crs_elapsed").alias("dur"),
            (((F.col("distance") / 20).cast("int") * 7 + F.col("dep_hour") * 13) % 101 / 100.0).alias("risk"),
            ((F.col("distance") / 20).cast("int") * 3 % 70 - 10).alias("pdelay"),
            (((F.col("distance") / 20).cast("int") * 11 + F.col("dep_min") * 3) % 101 / 100.0).alias("drisk"),
            ((F.col("distance") / 20).cast("int") * 5 % 80 - 10).alias("dpdelay"),
            F.col("arr_del15").alias("real"),
            F.col("arr_delay").cast("int").alias("delay"),
        )
    )


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def trips(self) -> DataFrame:
        return trips_from_events(self.raw("events"))

    @cached_property
    def airports(self) -> DataFrame:
        return airports_from_nations(self.raw("nation"), self.raw("region"))

    @cached_property
    def weather(self) -> DataFrame:
        return weather_from_airports(self.airports, self.trips)

    @cached_property
    def requests(self) -> DataFrame:
        return requests_from_trips(self.trips)

    @cached_property
    def replay(self) -> DataFrame:
        return replay_from_trips(self.trips, self.airports)
