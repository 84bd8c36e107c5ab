import datetime as dt
import random

from pyspark.sql import functions as F

from onblock.operators.features import hub_hours, hub_state, previous_leg
from onblock.operators.lagging import HeavyGroups
from onblock.plans.replay import scoreboard_windows
from onblock.streaming import live
from tests.rows import DAY, trip, trips

REPLAY = "flight_id int, flight_date date, o string, d string, al string, dep int, dur int, drisk double, dpdelay int, real int, delay int"


def stream(spark, folder, frames):
    """One file per frame, delivered in this order."""
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def replay_rows(n):
    rng = random.Random(2)
    return [
        (i, DAY + dt.timedelta(days=i % 2), "A", "B", "X", rng.randrange(1300), rng.randrange(30, 300), rng.random(), rng.randrange(60), i % 2, rng.randrange(-60, 300))
        for i in range(n)
    ]


def rounded(df):
    return {(str(r["hour_start"]), r["landed"], round(r["mean_risk"], 9), round(r["within_15_share"], 9)) for r in df.collect()}


def test_scoreboard_equals_batch_over_shuffled_files(spark, tmp_path):
    rows = replay_rows(300)
    random.Random(1).shuffle(rows)
    parts = [spark.createDataFrame(rows[i::3], REPLAY) for i in range(3)]
    got = live.scoreboard_stream(stream(spark, tmp_path / "in", parts))
    assert rounded(got) == rounded(scoreboard_windows(spark.createDataFrame(rows, REPLAY)))


def test_landings_are_delivered_once(spark, tmp_path):
    rows = replay_rows(40)
    parts = [spark.createDataFrame(rows, REPLAY), spark.createDataFrame(rows[:10], REPLAY)]
    assert live.landings_stream(stream(spark, tmp_path / "in", parts)).count() == 40


def test_streams_go_on_from_their_root(spark, tmp_path):
    rows = replay_rows(90)
    first, rest = spark.createDataFrame(rows[:50], REPLAY), spark.createDataFrame(rows[40:], REPLAY)
    board, feed = str(tmp_path / "board"), str(tmp_path / "feed")
    begun = stream(spark, tmp_path / "in", [first])
    assert live.scoreboard_stream(begun, root=board).agg(F.sum("landed")).first()[0] == 50
    assert live.landings_stream(begun, root=feed).count() == 50
    further = stream(spark, tmp_path / "in", [rest])
    assert live.scoreboard_stream(further, root=board).agg(F.sum("landed")).first()[0] == 100  # the board counts deliveries
    assert live.landings_stream(further, root=feed).count() == 90


def legs(days, n=200):
    rng = random.Random(4)
    return [trip(i, rng.randrange(1440), tail=rng.choice(["N1", "N2", None]), arr_delay=float(rng.randrange(90)), day=DAY + dt.timedelta(days=rng.randrange(days))) for i in range(n)]


def values(df):
    return {(r["flight_id"], r["prev_arr_delay"], r["turnaround"]) for r in df.collect()}


def test_daily_legs_equal_batch_over_shuffled_files(spark, tmp_path):
    rows = legs(2)
    parts = [trips(spark, rows[i::3]) for i in range(3)]
    got = live.DailyLegs(spark, allowed_days=3).run(stream(spark, tmp_path / "in", parts))
    assert values(got) == values(previous_leg(trips(spark, rows)))


def test_stopped_daily_legs_go_on_with_a_day_of_both_runs(spark, tmp_path):
    rows = sorted(legs(3), key=lambda r: r[1])
    for start, end in [(0, 100), (100, 170), (170, 200)]:
        assert start == 0 or rows[start - 1][1] == rows[start][1]
        got = live.DailyLegs(spark, root=str(tmp_path / "legs")).run(stream(spark, tmp_path / "in", [trips(spark, rows[start:end])]))
        assert values(got) == values(previous_leg(trips(spark, rows[:end])))


def test_rows_for_closed_days_are_late(spark, tmp_path):
    first = [trip(1, 100), trip(2, 200)]
    later = [trip(3, 100, day=DAY + dt.timedelta(days=5))]
    late = [trip(4, 150)]
    for rows in [first, later, late]:
        feed = live.DailyLegs(spark, allowed_days=1, root=str(tmp_path / "legs"))
        got = feed.run(stream(spark, tmp_path / "in", [trips(spark, rows)]))
    assert sorted(r["flight_id"] for r in got.collect()) == [1, 2, 3]
    assert sorted(r["flight_id"] for r in spark.read.parquet(feed.out).collect()) == [1, 2]


def test_state_of_daily_legs_holds_open_days_only(spark, tmp_path):
    rows = sorted(legs(6), key=lambda r: r[1])
    feed = live.DailyLegs(spark, root=str(tmp_path / "legs"), slices=3, heavy=HeavyGroups(min_rows=10))
    got = feed.run(stream(spark, tmp_path / "in", [trips(spark, rows[i : i + 50]) for i in range(0, 200, 50)]))
    assert values(got) == values(previous_leg(trips(spark, rows)))
    newest = rows[-1][1]
    assert {r["flight_date"] for r in feed._open().select("flight_date").distinct().collect()} == {newest}
    assert spark.read.parquet(feed.out).filter(F.col("flight_date") == newest).isEmpty()


def test_state_of_daily_legs_takes_a_value_a_key_and_batch(spark, tmp_path):
    rows = legs(1)
    feed = live.DailyLegs(spark, root=str(tmp_path / "legs"), slices=2)
    got = feed.run(stream(spark, tmp_path / "in", [trips(spark, rows)]))
    assert live._state(spark, feed.checkpoint, stateVarName=live.OPEN_ROWS).count() <= 2
    assert values(got) == values(previous_leg(trips(spark, rows)))


def test_hub_state_stream_equals_batch(spark, tmp_path):
    rows = legs(2)
    parts = [trips(spark, rows[i::2]) for i in range(2)]
    keys = ["origin", "flight_date", "dep_hour"]
    got = live.hub_state_stream(stream(spark, tmp_path / "in", parts)).select(*keys, F.round("airport_state", 9))
    want = hub_state(hub_hours(trips(spark, rows))).select(*keys, F.round("airport_state", 9))
    assert set(got.collect()) == set(want.collect())


def test_hub_state_stream_goes_on_and_keeps_two_hours(spark, tmp_path):
    rows = sorted(legs(5), key=lambda r: (r[1], r[5]))
    rows = [(*r[:-1], None if r[0] % 7 == 0 else r[0] % 2) for r in rows]
    keys = ["origin", "flight_date", "dep_hour"]
    for start, end in [(0, 90), (90, 150), (150, 200)]:
        begun = stream(spark, tmp_path / "in", [trips(spark, rows[start:end])])
        got = live.hub_state_stream(begun, "3 hours", root=str(tmp_path / "hubs"))
        want = hub_state(hub_hours(trips(spark, rows[:end])))
        columns = [*keys, "dep_congestion", F.round("dep_rate", 9), F.round("airport_state", 9)]
        assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    checkpoint = str(tmp_path / "hubs" / "checkpoint")
    assert live._state(spark, checkpoint, operatorId=0, stateVarName="ring").count() <= 2
    assert live._state(spark, checkpoint, operatorId=1).count() < want.count() / 4


def test_requests_score_as_a_stream(spark, tmp_path):
    from onblock.operators.weather import request_weather
    from onblock.plans.scoring import with_route_defaults

    routes = spark.createDataFrame([("A", "B", 100.0, 50.0)], "origin string, dest string, distance double, crs_elapsed double")
    readings = spark.createDataFrame([("A", DAY, 1.0, 2.0, 3.0, 4.0)], "iata string, date date, prcp double, snow double, wspd double, tavg double")
    clim = spark.createDataFrame([("A", 3, 5.0, 5.0, 5.0, 5.0)], "iata string, month int, prcp double, snow double, wspd double, tavg double")
    asked = spark.createDataFrame([(1, "A", "B", 3, DAY, None, None), (2, "Q", "B", 3, None, 1, 2)], "request_id int, origin string, dest string, month int, date date, distance int, crs_elapsed int")
    answered = request_weather(with_route_defaults(stream(spark, tmp_path / "in", [asked]), routes), readings, clim)
    answered.writeStream.format("memory").queryName("answers").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    got = {r["request_id"]: (r["distance"], r["meteo"]["prcp"]) for r in spark.table("answers").collect()}
    assert got == {1: (100.0, 1.0), 2: (1.0, 5.0)}
