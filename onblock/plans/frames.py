"""Model frames: which rows and columns a learner sees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onblock.functions.labels import clip_delay
from onblock.operators.features import dayof_features
from onblock.operators.weather import MEASURES, with_imputed_weather

# Feature lists of the four models, in order.
CATEGORIES = ["airline", "origin", "dest", "route", "orig_hour"]
ONE_HOT = ["airline", "origin", "dest"]
BOOKING_NUMBERS = ["month", "day_of_week", "dep_hour", "distance", "crs_elapsed", *MEASURES]
DAYOF_EXTRA = ["prev_arr_delay", "dep_congestion", "turnaround", "airport_state"]
DAYOF_NUMBERS = BOOKING_NUMBERS + DAYOF_EXTRA
MINUTE_CATEGORIES = ["airline", "origin", "dest"]

LABEL, MINUTES = "arr_del15", "minutes"
SPLIT = "2024-11-01"


def with_crosses(trips: DataFrame) -> DataFrame:
    """Adds the crossed codes `route` (origin_dest) and `orig_hour` (origin_hour)."""
    return trips.withColumns(
        {
            "route": F.concat_ws("_", "origin", "dest"),
            "orig_hour": F.concat_ws("_", "origin", F.col("dep_hour").cast("string")),
        }
    )


def completed(trips: DataFrame) -> DataFrame:
    return trips.filter("cancelled = 0 and diverted = 0 and crs_elapsed is not null")


def model_ready(trips: DataFrame, need_delay: bool = True) -> DataFrame:
    """Completed trips with a label; the booking and minutes sets also need the delay itself."""
    kept = completed(trips).filter(F.col(LABEL).isNotNull())
    return kept.filter(F.col("arr_delay").isNotNull()) if need_delay else kept


def temporal_split(df: DataFrame, cut: str = SPLIT) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut date and rows from it on."""
    at = F.lit(cut).cast("date")
    return df.filter(F.col("flight_date") < at), df.filter(F.col("flight_date") >= at)


def day_slice(trips: DataFrame, dates: list[str] | None) -> DataFrame:
    """Completed, labelled trips of the given days (of all days for None) that have a departure minute."""
    wanted = trips if dates is None else trips.filter(F.col("flight_date").isin(*[F.lit(d).cast("date") for d in dates]))
    return model_ready(wanted, need_delay=False).filter(F.col("dep_min").isNotNull())


def booking_frame(trips: DataFrame, weather: DataFrame, fill: str = "frame", cut: str = SPLIT) -> DataFrame:
    """Booking features and targets. `fill="train"` takes the weather medians from the training rows only."""
    ready = model_ready(trips)
    reference = temporal_split(ready, cut)[0] if fill == "train" else None
    framed = with_crosses(with_imputed_weather(ready, weather, reference))
    return framed.withColumn(MINUTES, clip_delay("arr_delay"))


def dayof_frame(trips: DataFrame, weather: DataFrame, fill: str = "frame", cut: str = SPLIT, featured: bool = False) -> DataFrame:
    """Booking features plus the day-of ones. The windows run before any filter, over cancelled trips too."""
    base = trips if featured else dayof_features(trips)
    ready = model_ready(base, need_delay=False)
    reference = temporal_split(model_ready(trips, need_delay=False), cut)[0] if fill == "train" else model_ready(trips, need_delay=False)
    framed = with_crosses(with_imputed_weather(ready, weather, reference))
    return framed.withColumn(MINUTES, clip_delay("arr_delay"))


def majority_baseline(train: DataFrame, test: DataFrame, label: str = LABEL) -> DataFrame:
    """Adds `baseline`: the most frequent training label (the smaller one on a tie) for every row."""
    top = (
        train.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.min_by(F.col(label).cast("double"), F.struct(-F.col("n"), F.col(label))))
    )
    return test.withColumn("baseline", top.scalar())
