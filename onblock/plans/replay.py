"""Replay of scored days: who is in the air, who has landed, how good the scores were."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onblock.functions.clock import local_moment
from onblock.functions.geo import fraction_flown, gc_bearing, gc_point
from onblock.functions.labels import clip_delay, trip_uid
from onblock.operators.metrics import MINUTES_TOLERANCE


def landing() -> Column:
    return F.col("dep") + F.col("dur")


def with_uid(replay: DataFrame) -> DataFrame:
    return replay.withColumn("uid", trip_uid("o", "d", "dep", "al"))


def in_the_air(replay: DataFrame, minute: float, min_risk: float = 0.0, risk: str = "drisk") -> DataFrame:
    return replay.filter((F.col("dep") <= minute) & (landing() >= minute) & (F.col(risk) >= min_risk))


def active_at(
    replay: DataFrame, minute: float, min_risk: float = 0.0, k: int = 40, risk: str = "drisk", pinned: str | None = None
) -> DataFrame:
    """The latest `k` departures in the air; a pinned trip comes first if it is among the active ones."""
    shown = with_uid(in_the_air(replay, minute, min_risk, risk))
    first = F.col("uid") == F.lit(pinned) if pinned else F.lit(False)
    return shown.orderBy(first.desc(), F.desc("dep"), "flight_id").limit(k)


def landed_by(replay: DataFrame, minute: float) -> DataFrame:
    return replay.filter(landing() <= minute)


def landed_between(replay: DataFrame, low: float, high: float, k: int = 2) -> DataFrame:
    """The first `k` landings in (low, high], in order of departure."""
    return replay.filter((landing() > low) & (landing() <= high)).orderBy("dep", "flight_id").limit(k)


def landed_per_tick(replay: DataFrame, every: int, k: int = 2) -> DataFrame:
    """`landed_between` for all ticks of all days at once; tick t covers the `every` minutes up to t."""
    ticked = replay.withColumn("tick", (F.ceil(landing() / every) * every).cast("int"))
    first = F.row_number().over(Window.partitionBy("flight_date", "tick").orderBy("dep", "flight_id"))
    return ticked.withColumn("_rank", first).filter(F.col("_rank") <= k).drop("_rank")


def newest_landings(replay: DataFrame, minute: float, k: int = 10) -> DataFrame:
    """The `k` most recent landings, newest first."""
    landed = landed_by(replay, minute).withColumn("landed", landing())
    return landed.orderBy(F.desc("landed"), "flight_id").limit(k)


def score_aggregates(risk: str = "drisk", minutes: str = "dpdelay") -> list[Column]:
    near = F.abs(F.col(minutes) - clip_delay("delay")) <= MINUTES_TOLERANCE
    return [
        F.count(F.lit(1)).alias("landed"),
        F.avg(risk).alias("mean_risk"),
        F.avg("real").alias("late_share"),
        F.avg(near.cast("int")).alias("within_15_share"),
    ]


def scoreboard_at(replay: DataFrame, minute: float, risk: str = "drisk", minutes: str = "dpdelay") -> DataFrame:
    """Mean risk, late share and share of close predictions over everything landed by a minute."""
    return landed_by(replay, minute).agg(*score_aggregates(risk, minutes))


def with_landing_time(replay: DataFrame) -> DataFrame:
    return replay.withColumn("landed_at", local_moment("flight_date", landing()))


def scoreboard_windows(replay: DataFrame, risk: str = "drisk", minutes: str = "dpdelay") -> DataFrame:
    """The score board per hour of landing; the streaming board gives the same rows."""
    return (
        with_landing_time(replay)
        .groupBy(F.window("landed_at", "1 hour").alias("w"))
        .agg(*score_aggregates(risk, minutes))
        .withColumn("hour_start", F.col("w.start"))
        .drop("w")
    )


def day_summary(replay: DataFrame) -> DataFrame:
    """Trips, late share and both mean risks per scored day."""
    return replay.groupBy("flight_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("real").alias("late_share"),
        F.avg("risk").alias("mean_risk"),
        F.avg("drisk").alias("mean_drisk"),
    )


def active_profile(replay: DataFrame, every: int = 10, minutes_per_day: int = 1440) -> DataFrame:
    """Trips in the air and trips of the day at each tick of each day.

    A trip adds one at the first tick it is seen and takes one off after the last, so the running sum over at most
    `minutes_per_day / every` ticks per day replaces one row per trip and tick.
    """
    last = (minutes_per_day - 1) // every
    starts = F.greatest(F.ceil(F.col("dep") / every), F.lit(0)).cast("int")
    ends = F.least(F.floor(landing() / every), F.lit(last)).cast("int")
    seen = replay.select("flight_date", starts.alias("a"), ends.alias("b"))
    total = seen.groupBy("flight_date").agg(F.count(F.lit(1)).alias("total"))
    steps = (
        seen.filter(F.col("a") <= F.col("b"))
        .select("flight_date", F.explode(F.array(F.struct(F.col("a").alias("i"), F.lit(1).alias("s")), F.struct((F.col("b") + 1).alias("i"), F.lit(-1).alias("s")))).alias("e"))
        .groupBy("flight_date", F.col("e.i").alias("i"))
        .agg(F.sum("e.s").alias("s"))
    )
    grid = total.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(last))))
    running = Window.partitionBy("flight_date").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (
        grid.join(steps, ["flight_date", "i"], "left")
        .withColumn("active", F.coalesce(F.sum("s").over(running), F.lit(0)))
        .select("flight_date", (F.col("i") * every).alias("minute"), "active", "total")
    )


def positions_at(replay: DataFrame, minute: float, min_risk: float = 0.0, risk: str = "drisk") -> DataFrame:
    """Where each trip in the air is, and where it heads."""
    moving = in_the_air(replay, minute, min_risk, risk).withColumn(
        "fraction", fraction_flown(F.lit(float(minute)), "dep", "dur")
    )
    here = gc_point("ox", "oy", "dx", "dy", "fraction")
    ahead = gc_point("ox", "oy", "dx", "dy", F.least(F.lit(1.0), F.col("fraction") + 0.01))
    return (
        moving.withColumns({"_here": here, "_ahead": ahead})
        .withColumn("bearing", gc_bearing("_here.lon", "_here.lat", "_ahead.lon", "_ahead.lat"))
        .withColumns({"lon": F.col("_here.lon"), "lat": F.col("_here.lat")})
        .drop("_here", "_ahead")
    )


def monthly_reference_days(trips: DataFrame, day: int = 15) -> DataFrame:
    """The given day of each month present in the trips."""
    return trips.select("flight_date").filter(F.dayofmonth("flight_date") == day).distinct()
