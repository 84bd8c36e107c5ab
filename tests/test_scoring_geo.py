import datetime as dt

import pytest
from pyspark.sql import functions as F

from onblock.functions import clock, geo, labels
from onblock.operators import weather as w
from onblock.plans.frames import booking_frame, majority_baseline
from onblock.plans.replay import active_at, active_profile, landed_between
from onblock.plans.routes import route_rollup
from onblock.plans.scoring import daily_medians, with_route_defaults
from tests.rows import DAY, trip, trips

READING = "iata string, date date, prcp double, snow double, wspd double, tavg double"


def factors(spark, prcp, snow, wspd, hour, prev):
    df = spark.createDataFrame([(prcp, snow, wspd, hour, prev)], "p double, s double, w double, h int, v int")
    return [tuple(f) for f in df.select(labels.risk_factors("p", "s", "w", "h", "v")).first()[0]]


def test_factor_rules(spark):
    assert factors(spark, 9.0, 2.0, 31.0, 17, 31) == [
        ("Avion précédent en retard de 31 min", "fort"), ("Neige au départ", "fort"), ("Vent fort", "moyen"), ("Départ en soirée", "moyen")
    ]
    assert factors(spark, 9.0, 1.0, 30.0, 8, 15) == [
        ("Avion précédent un peu en retard", "moyen"), ("Pluie au départ", "moyen"), ("Départ tôt le matin", "faible")
    ]
    assert factors(spark, 8.0, 1.0, 30.0, 12, 3) == [("Avion précédent à l'heure", "faible")]
    assert factors(spark, 8.0, 1.0, 30.0, 12, None) == [("Conditions favorables", "faible")]


def test_labels(spark):
    df = spark.createDataFrame([("AA", 0.2, 9, 601, None), ("Q?", 0.55, 10, 5, 300.0)], "c string, r double, m int, t int, d double")
    a, b = df.select(
        labels.named_code("c"), labels.risk_level("r"), labels.delay_text("m"), clock.hhmm_label("t"), labels.clip_delay("d")
    ).collect()
    assert tuple(a) == ("American (AA)", "Risque modéré", "à l'heure", "10:01", None)
    assert tuple(b) == ("Q?", "Risque très élevé", "+10 min", "00:05", 240.0)


def test_hhmm(spark):
    df = spark.createDataFrame([(2400,), (5,), (1559,)], "h int")
    got = [tuple(r) for r in df.select(clock.hour_of_hhmm("h"), clock.minute_of_hhmm("h")).collect()]
    assert got == [(0, 1440), (0, 5), (15, 959)]


def test_forecast_rules(spark):
    df = spark.createDataFrame([("A", DAY, None, 0.3, 0.0, 0.0), ("A", DAY, 1.0, None, None, -4.0)], READING)
    assert [tuple(r)[2:] for r in w.forecast_normalised(df).collect()] == [(0.0, 3.0, 15.0, 15.0), (1.0, 0.0, 15.0, -4.0)]


def test_request_weather_falls_back(spark):
    readings = spark.createDataFrame([("AAA", DAY, 1.0, 2.0, 3.0, 4.0), ("ZZZ", DAY, 9.0, 9.0, 9.0, 9.0)], READING)
    clim = spark.createDataFrame([("AAA", 3, 5.0, 5.0, 5.0, 5.0), ("BBB", 3, 7.0, 7.0, 7.0, 7.0)], "iata string, month int, prcp double, snow double, wspd double, tavg double")
    airports = spark.createDataFrame([("AAA", 1.0, 1.0)], "iata string, lat double, lon double")
    asked = spark.createDataFrame(
        [(1, "AAA", 3, DAY), (2, "AAA", 3, None), (3, "ZZZ", 3, DAY), (4, "BBB", 3, DAY)], "request_id int, origin string, month int, date date"
    )
    got = {r["request_id"]: (r["meteo"]["prcp"], r["meteo_source"]) for r in w.request_weather(asked, readings, clim, airports).collect()}
    assert got == {1: (1.0, "réelle"), 2: (5.0, "typique"), 3: (6.0, "typique"), 4: (7.0, "typique")}


def test_empty_climatology_has_fixed_values(spark):
    none = spark.createDataFrame([], "iata string, month int, prcp double, snow double, wspd double, tavg double")
    assert tuple(w.global_climatology(none).first()) == (0.0, 0.0, 15.0, 15.0)


def test_imputation_uses_the_median_of_the_frame(spark):
    rows = [trip(1), trip(2), trip(3, origin="CCC"), trip(4, origin="DDD")]
    readings = spark.createDataFrame([("AAA", DAY, None, None, 10.0, None), ("CCC", DAY, 1.0, 1.0, 30.0, 8.0)], READING)
    got = {r["flight_id"]: (r["prcp"], r["wspd"], r["tavg"]) for r in booking_frame(trips(spark, rows), readings).collect()}
    assert got[4] == (0.0, 10.0, 8.0) and got[1] == (0.0, 10.0, 8.0) and got[3] == (1.0, 30.0, 8.0)


def test_daily_medians_stay_within_the_day(spark):
    other = DAY + dt.timedelta(days=1)
    rows = [trip(1), trip(2, day=other)]
    readings = spark.createDataFrame([("AAA", DAY, 0.0, 0.0, 10.0, 1.0), ("AAA", other, 0.0, 0.0, 20.0, 2.0)], READING)
    got = {r["_day"]: r["_mid"]["wspd"] for r in daily_medians(trips(spark, rows), readings).collect()}
    assert got == {DAY: 10.0, other: 20.0}


def test_route_defaults_chain(spark):
    routes = spark.createDataFrame([("A", "B", 100.0, 50.0)], "origin string, dest string, distance double, crs_elapsed double")
    asked = spark.createDataFrame([(1, "A", "B", 7, None), (2, "B", "A", None, None)], "request_id int, origin string, dest string, distance int, crs_elapsed int")
    got = {r["request_id"]: (r["distance"], r["crs_elapsed"]) for r in with_route_defaults(asked, routes).collect()}
    assert got == {1: (7.0, 50.0), 2: (800.0, 120.0)}


def test_route_rollup_ties(spark):
    rows = [trip(i, 60 * h) for i, h in enumerate([8, 9, 8, 9])]  # median hour 8.5 goes to the even hour
    base = trips(spark, rows).withColumn("airline", F.when(F.col("flight_id") < 2, "ZZ").otherwise("AA"))
    row = route_rollup(base, 1).first()
    assert (row["n"], row["dep_hour"], row["airline"]) == (4, 8, "AA")


def test_majority_baseline_prefers_the_smaller_label_on_a_tie(spark):
    df = spark.createDataFrame([(0,), (1,)], "arr_del15 int")
    assert {r["baseline"] for r in majority_baseline(df, df).collect()} == {0.0}


def test_path_crosses_the_date_line(spark):
    df = spark.createDataFrame([(1, 170.0, 10.0, -170.0, 12.0), (2, 5.0, 5.0, 5.0, 5.0), (3, None, 1.0, 2.0, 2.0)], "i int, ox double, oy double, dx double, dy double")
    paths = {r["i"]: r["path"] for r in geo.route_paths(df).collect()}
    lons = [p["lon"] for p in paths[1]]
    assert len(lons) == 49 and lons[0] == pytest.approx(170) and lons[-1] == pytest.approx(190)
    assert all(abs(b - a) < 1 for a, b in zip(lons, lons[1:]))
    assert {(p["lon"], p["lat"]) for p in paths[2]} == {(5.0, 5.0)}
    assert paths[3] == []


REPLAY = "flight_id int, flight_date date, o string, d string, al string, dep int, dur int, drisk double"


def test_active_and_landed(spark):
    rows = [(1, DAY, "A", "B", "X", 100, 50, 0.5), (2, DAY, "A", "C", "X", 120, 50, 0.1), (3, DAY, "B", "C", "X", 110, 20, 0.5), (4, DAY, "B", "C", "Y", 1430, 60, 0.5)]
    df = spark.createDataFrame(rows, REPLAY)
    assert [r["flight_id"] for r in active_at(df, 125, pinned="A_B_100_X").collect()] == [1, 2, 3]
    assert [r["flight_id"] for r in active_at(df, 125, min_risk=0.2).collect()] == [3, 1]
    assert [r["flight_id"] for r in landed_between(df, 130, 170, k=2).collect()] == [1, 2]
    ticks = {r["minute"]: r["active"] for r in active_profile(df).collect()}
    assert len(ticks) == 144
    for minute in ticks:
        assert ticks[minute] == sum(dep <= minute <= dep + dur for *_, dep, dur, _ in rows)
