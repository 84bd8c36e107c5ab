"""Day-of features of a trip: previous leg, turnaround, hub congestion, recent hub state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onblock.operators.lagging import HeavyGroups, lag_in_group

# Fixed default values of the feature table.
PREVIOUS_DELAY_DEFAULT = 0.0
TURNAROUND_DEFAULT = 240
ELAPSED_DEFAULT = 120
STATE_DEFAULT = 0.2

HUB_HOUR = ["origin", "flight_date", "dep_hour"]


def leg_order(trips: DataFrame, tiebreak: list[str] | None = None) -> list[str]:
    """Departure minute, then keys that make equal minutes repeatable."""
    if tiebreak is None:
        tiebreak = ["flight_id"] if "flight_id" in trips.columns else ["origin", "dest", "airline", "crs_elapsed", "arr_delay"]
    return ["dep_min", *tiebreak]


def previous_leg(
    trips: DataFrame,
    prev_default: float = PREVIOUS_DELAY_DEFAULT,
    turn_default: int = TURNAROUND_DEFAULT,
    elapsed_default: int = ELAPSED_DEFAULT,
    tiebreak: list[str] | None = None,
    heavy: HeavyGroups | None = HeavyGroups(),
) -> DataFrame:
    """Delay of the vehicle's previous leg on the same day, and the minutes between its planned arrival and now.

    A cancelled predecessor has no delay and counts as the default; it is not skipped.
    """
    carried = {
        "_prev_delay": F.col("arr_delay"),
        "_prev_end": F.col("dep_min") + F.coalesce(F.col("crs_elapsed"), F.lit(elapsed_default)),
    }
    legs = lag_in_group(trips, ["tail", "flight_date"], leg_order(trips, tiebreak), carried, heavy)
    return legs.withColumns(
        {
            "prev_arr_delay": F.coalesce("_prev_delay", F.lit(prev_default)),
            "turnaround": F.coalesce(F.col("dep_min") - F.col("_prev_end"), F.lit(turn_default)),
        }
    ).drop("_prev_delay", "_prev_end")


def hub_hours(trips: DataFrame) -> DataFrame:
    """One row per hub, day and hour: departures (cancelled ones too) and the share that left late."""
    return trips.groupBy(*HUB_HOUR).agg(
        F.count(F.lit(1)).alias("dep_congestion"), F.avg("dep_del15").alias("dep_rate")
    )


def hub_state(hours: DataFrame, default: float | None = STATE_DEFAULT) -> DataFrame:
    """Adds the mean of the hourly late shares of the two hours before; at most 24 rows meet in a window group.

    An hour without any known departure delay has no state of its own and gets the default, as do unknown hubs.
    """
    before = Window.partitionBy("origin", "flight_date").orderBy("dep_hour").rangeBetween(-2, -1)
    known = F.col("dep_rate").isNotNull()
    for key in HUB_HOUR:
        known = known & F.col(key).isNotNull()
    state = F.when(known, F.avg("dep_rate").over(before))
    return hours.withColumn("airport_state", state if default is None else F.coalesce(state, F.lit(default)))


def hub_state_by_shift(hours: DataFrame) -> DataFrame:
    """The same state as a self-join: every hour is handed forward to the two hours that look back at it.

    Shifting turns the range condition into equal keys, so the join stays a plain hash or merge join.
    """
    rated = hours.filter(F.col("dep_rate").isNotNull()).select(*HUB_HOUR, "dep_rate")
    seen = rated.withColumn("dep_hour", F.explode(F.array(F.col("dep_hour") + 1, F.col("dep_hour") + 2)))
    seen = seen.groupBy(*HUB_HOUR).agg(F.avg("dep_rate").alias("airport_state"))
    return rated.select(*HUB_HOUR).join(seen, HUB_HOUR, "inner")


def with_hub_hours(trips: DataFrame, hours: DataFrame, columns: list[str]) -> DataFrame:
    """Brings hub-hour columns back to the trips; keys match null to null like a window group does."""
    side = hours.select(*[F.col(c).alias(f"_{c}") for c in HUB_HOUR], *columns)
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in HUB_HOUR]
    return trips.join(side, match, "left").drop(*[f"_{c}" for c in HUB_HOUR])


def dayof_features(
    trips: DataFrame,
    state_default: float = STATE_DEFAULT,
    prev_default: float = PREVIOUS_DELAY_DEFAULT,
    turn_default: int = TURNAROUND_DEFAULT,
    elapsed_default: int = ELAPSED_DEFAULT,
    tiebreak: list[str] | None = None,
    heavy: HeavyGroups | None = HeavyGroups(),
) -> DataFrame:
    """The feature table: previous leg and turnaround from one sort, congestion and state from one hub-hour roll-up.

    The roll-up combines before its shuffle and is small, so the wide rows are shuffled once for the legs and meet
    the hub-hours in a join that Spark broadcasts or splits by measured size.
    """
    legs = previous_leg(trips, prev_default, turn_default, elapsed_default, tiebreak, heavy)
    hours = hub_state(hub_hours(trips), state_default)
    return with_hub_hours(legs, hours, ["dep_congestion", "airport_state"])
