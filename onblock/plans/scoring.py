"""Scoring of requests, routes and days with fitted models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.functions.labels import MODE_BOOKING, MODE_DAYOF, risk_factors
from onblock.operators.features import dayof_features
from onblock.operators.ranks import quantiles_of_counts
from onblock.operators.weather import MEASURES, MEDIAN_FILLED, _by_name, fill_weather, request_weather, with_weather
from onblock.plans.frames import day_slice, with_crosses
from onblock.plans.learn import DelayModel, Models
from onblock.plans.routes import ROUTE_COLUMNS, ROUTE_MONTH, ROUTE_WEEKDAY, route_features

# What an unknown route is assumed to be, and the day-of situation of a request.
DISTANCE_DEFAULT, ELAPSED_DEFAULT = 800, 120
REQUEST_DEFAULTS = {"month": 7, "day_of_week": 4, "dep_hour": 8}
CONGESTION_ASSUMED, TURNAROUND_ASSUMED, STATE_ASSUMED = 20, 50, 0.2


def with_route_defaults(requests: DataFrame, routes: DataFrame) -> DataFrame:
    """Distance and planned minutes of a request: its own, else the route table's, else a constant."""
    known = routes.select(
        F.col("origin").alias("_o"),
        F.col("dest").alias("_d"),
        F.col("distance").alias("_distance"),
        F.col("crs_elapsed").alias("_elapsed"),
    )
    joined = requests.join(known, (F.col("origin") == F.col("_o")) & (F.col("dest") == F.col("_d")), "left")
    return joined.withColumns(
        {
            "distance": F.coalesce(F.col("distance").cast("double"), "_distance", F.lit(float(DISTANCE_DEFAULT))),
            "crs_elapsed": F.coalesce(F.col("crs_elapsed").cast("double"), "_elapsed", F.lit(float(ELAPSED_DEFAULT))),
        }
    ).drop("_o", "_d", "_distance", "_elapsed")


def with_request_defaults(requests: DataFrame) -> DataFrame:
    """Month, weekday and hour of a request where it leaves them out."""
    return requests.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in REQUEST_DEFAULTS.items()})


def whole_minutes(minutes: Column | str) -> Column:
    """Predicted minutes as an integer, half to even."""
    return F.bround(minutes).cast("int")


def score_requests(
    requests: DataFrame, routes: DataFrame, weather: DataFrame, clim: DataFrame, airports: DataFrame, models: Models
) -> DataFrame:
    """Answers to ad-hoc requests, for a table or a stream of them.

    A known delay of the previous leg selects the day-of models, otherwise the booking models answer; a request meets only its own two.
    """
    facts = request_facts(requests, routes, weather, clim, airports)
    day, book = facts.filter("_dayof"), facts.filter("not _dayof")
    scored = _scored(day, models.dayof, models.dayof_minutes).unionByName(_scored(book, models.booking, models.booking_minutes))
    return scored.select(
        "request_id",
        F.bround("_p", 3).alias("proba"),
        whole_minutes("_m").alias("minutes"),
        "mode",
        "distance",
        "crs_elapsed",
        "meteo",
        "meteo_source",
        "factors",
    )


def _scored(facts: DataFrame, risk: DelayModel, minutes: DelayModel) -> DataFrame:
    scored = minutes.transform(risk.transform(facts, "_p"), "_m")
    return scored.select("request_id", "_p", "_m", "mode", "distance", "crs_elapsed", "meteo", "meteo_source", "factors")


def request_facts(requests: DataFrame, routes: DataFrame, weather: DataFrame, clim: DataFrame, airports: DataFrame) -> DataFrame:
    """What an answer states besides its scores (mode, distance, minutes of travel, weather, factors), and the model inputs."""
    asked = request_weather(with_route_defaults(with_request_defaults(requests), routes), weather, clim, airports)
    dayof = F.col("prev_arr_delay").isNotNull()
    ready = with_crosses(asked).withColumns(
        {
            **{c: F.col(f"meteo.{c}") for c in MEASURES},
            "_prev": F.col("prev_arr_delay"),
            "prev_arr_delay": F.coalesce("prev_arr_delay", F.lit(0)),
            "dep_congestion": F.lit(CONGESTION_ASSUMED),
            "turnaround": F.lit(TURNAROUND_ASSUMED),
            "airport_state": F.lit(STATE_ASSUMED),
            "_dayof": dayof,
        }
    )
    return ready.withColumns(
        {
            "mode": F.when(F.col("_dayof"), MODE_DAYOF).otherwise(MODE_BOOKING),
            "meteo": F.struct(*[F.bround(f"meteo.{c}", 1).alias(c) for c in MEASURES]),
            "factors": risk_factors("prcp", "snow", "wspd", "dep_hour", "_prev"),
        }
    )


def route_risk(table: DataFrame, booking: DelayModel, month: int = ROUTE_MONTH, weekday: int = ROUTE_WEEKDAY) -> DataFrame:
    """The route table with the booking risk of a typical departure, ready for export."""
    scored = booking.transform(route_features(table, month, weekday), "risk")
    doubles = [c for c, t in scored.select(*ROUTE_COLUMNS).dtypes if t == "double"]
    rounded = scored.withColumns({c: F.bround(c, 3) for c in [*doubles, "risk"]})
    return rounded.select(*ROUTE_COLUMNS, "risk")


def daily_medians(day: DataFrame, weather: DataFrame) -> DataFrame:
    """`_day` and the struct `_mid` of weather medians over the trips of each day; one row per scored day."""
    loads = day.groupBy("origin", "flight_date").agg(F.count(F.lit(1)).alias("w"))
    long = with_weather(loads, weather).select("flight_date", "w", F.explode(_by_name(MEDIAN_FILLED)).alias("name", "value"))
    counts = long.filter("value is not null").groupBy("flight_date", "name", "value").agg(F.sum("w").alias("n"))
    found = quantiles_of_counts(counts, {"median": 0.5}, by=["flight_date", "name"])
    mid = F.struct(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(c) for c in MEDIAN_FILLED])
    return found.groupBy(F.col("flight_date").alias("_day")).agg(mid.alias("_mid"))


def scored_days(
    trips: DataFrame, airports: DataFrame, weather: DataFrame, models: Models, dates: list[str] | None = None
) -> DataFrame:
    """All four scores for every completed trip of the given days, or of all days, in one job.

    The features of a day depend on that day only, so other days are cut off before the windows. Weather gaps take
    the median of the day.
    """
    from onblock.plans.routes import with_endpoints

    wanted = trips if dates is None else trips.filter(F.col("flight_date").isin(*[F.lit(d).cast("date") for d in dates]))
    day = with_endpoints(day_slice(dayof_features(wanted), dates), airports)
    middle = daily_medians(day, weather)
    enriched = with_weather(day, weather).join(F.broadcast(middle), F.col("flight_date") == F.col("_day"), "left")
    ready = with_crosses(fill_weather(enriched, F.col("_mid")))
    scored = models.booking.transform(ready, "_risk")
    scored = models.booking_minutes.transform(scored, "_minutes")
    scored = models.dayof.transform(scored, "_drisk")
    scored = models.dayof_minutes.transform(scored, "_dminutes")
    return scored.select(
        "flight_date",
        F.col("origin").alias("o"),
        F.col("dest").alias("d"),
        F.col("airline").alias("al"),
        F.bround("olon", 2).alias("ox"),
        F.bround("olat", 2).alias("oy"),
        F.bround("dlon", 2).alias("dx"),
        F.bround("dlat", 2).alias("dy"),
        F.col("dep_min").alias("dep"),
        F.col("crs_elapsed").alias("dur"),
        F.bround("_risk", 3).alias("risk"),
        whole_minutes("_minutes").alias("pdelay"),
        F.bround("_drisk", 3).alias("drisk"),
        whole_minutes("_dminutes").alias("dpdelay"),
        F.col("prev_arr_delay").cast("int").alias("prev"),
        F.col("arr_del15").alias("real"),
        F.col("arr_delay").cast("int").alias("delay"),
    )
