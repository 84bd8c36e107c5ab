"""Hand-written trip rows."""

import datetime as dt

TRIP_SCHEMA = (
    "flight_id long, flight_date date, month int, day_of_week int, dep_hour int, dep_min int, airline string, tail string, "
    "origin string, dest string, distance int, crs_elapsed int, cancelled int, diverted int, arr_delay double, "
    "arr_del15 int, dep_del15 int"
)
DAY = dt.date(2024, 3, 4)


def trip(flight_id, dep_min=600, tail="N1", arr_delay=0.0, elapsed=60, origin="AAA", day=DAY, dep_late=0, cancelled=0, dest="BBB"):
    return (
        flight_id,
        day,
        day.month,
        day.isoweekday(),
        None if dep_min is None else dep_min // 60 % 24,
        dep_min,
        "AA",
        tail,
        origin,
        dest,
        500,
        elapsed,
        cancelled,
        0,
        arr_delay,
        None if arr_delay is None else int(arr_delay >= 15),
        dep_late,
    )


def trips(spark, rows):
    return spark.createDataFrame(rows, TRIP_SCHEMA)


def by_id(df, *columns):
    return {r["flight_id"]: tuple(r[c] for c in columns) for r in df.collect()}
