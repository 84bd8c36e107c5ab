import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from onblock.operators import lagging
from onblock.operators.features import dayof_features, hub_hours, hub_state, hub_state_by_shift, previous_leg
from onblock.operators.lagging import HeavyGroups, heavy_groups
from tests.rows import DAY, by_id, trip, trips


def test_previous_leg_rules(spark):
    rows = [
        trip(1, 480, arr_delay=22.0),
        trip(2, 600, arr_delay=5.0, elapsed=None),
        trip(3, 700),
        trip(4, 0, day=DAY + dt.timedelta(days=1)),
    ]
    got = by_id(previous_leg(trips(spark, rows)), "prev_arr_delay", "turnaround")
    assert got[1] == (0.0, 240)
    assert got[2] == (22.0, 600 - 480 - 60)
    assert got[3] == (5.0, 700 - 600 - 120)  # missing duration counts as 120
    assert got[4] == (0.0, 240)  # first leg of a day looks at no other day


def test_cancelled_predecessor_is_not_skipped(spark):
    rows = [trip(1, 480, arr_delay=50.0), trip(2, 600, arr_delay=None, cancelled=1), trip(3, 700)]
    assert by_id(previous_leg(trips(spark, rows)), "prev_arr_delay")[3] == (0.0,)


def test_overlapping_legs_have_negative_turnaround(spark):
    rows = [trip(1, 480, elapsed=300), trip(2, 500)]
    assert by_id(previous_leg(trips(spark, rows)), "turnaround")[2] == (500 - 780,)


def test_equal_minutes_follow_the_key_and_missing_minutes_come_last(spark):
    rows = [trip(2, 480, arr_delay=2.0), trip(1, 480, arr_delay=1.0), trip(3, None, arr_delay=3.0), trip(4, 500, arr_delay=4.0)]
    got = by_id(previous_leg(trips(spark, rows)), "prev_arr_delay")
    assert got == {1: (0.0,), 2: (1.0,), 4: (2.0,), 3: (4.0,)}


def test_trips_without_registration_share_a_group(spark):
    rows = [trip(1, 480, tail=None, arr_delay=9.0), trip(2, 500, tail=None), trip(3, 490, tail="N2", arr_delay=7.0)]
    assert by_id(previous_leg(trips(spark, rows)), "prev_arr_delay")[2] == (9.0,)


@pytest.mark.parametrize("ties", [False, True])
def test_cut_groups_give_the_same_lag(spark, ties):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        tail = None if i % 3 else f"N{rng.randrange(40)}"
        minute = 600 if ties and tail is None else rng.choice([None, *range(0, 1440, 7)])
        delay = None if rng.random() < 0.1 else float(rng.randrange(-30, 200))
        rows.append(trip(i, minute, tail=tail, arr_delay=delay, elapsed=rng.choice([None, 50, 90]), day=DAY + dt.timedelta(days=i % 2)))
    frame = trips(spark, rows)
    cut = HeavyGroups(min_rows=100)
    assert {r["tail"] for r in heavy_groups(frame, ["tail", "flight_date"], cut).collect()} == {None}
    columns = ["flight_id", "prev_arr_delay", "turnaround"]
    plain = {tuple(r) for r in previous_leg(frame, heavy=None).select(columns).collect()}
    ranged = [tuple(r) for r in previous_leg(frame.repartition(7), heavy=cut).select(columns).collect()]
    assert len(ranged) == 3000 and set(ranged) == plain


def test_the_number_of_cut_points_is_bounded(spark, monkeypatch):
    rows = trips(spark, [trip(i, (i * 37) % 1440, tail=None, arr_delay=float(i % 90)) for i in range(400)])
    found, inner = [], lagging._cut_points
    monkeypatch.setattr(lagging, "MOST_RANGES", 8)
    monkeypatch.setattr(lagging, "_cut_points", lambda *a: found.append(inner(*a)) or found[-1])
    keep = ["flight_id", "prev_arr_delay", "turnaround"]
    cut = previous_leg(rows, heavy=HeavyGroups(min_rows=2)).select(keep).collect()
    assert sorted(cut) == sorted(previous_leg(rows, heavy=None).select(keep).collect())
    assert 1 <= len(found[0]) <= 16


def test_a_hot_group_in_well_compressed_files_is_found(spark, tmp_path):
    """Constant keys compress best, so the size of the files says nothing about the size of a group."""
    path = str(tmp_path / "hot")
    spark.range(4_000_000).select(F.lit(None).cast("string").alias("tail"), F.lit(DAY).alias("flight_date"), "id").write.parquet(path)
    found = heavy_groups(spark.read.parquet(path), ["tail", "flight_date"], HeavyGroups()).collect()
    assert [(r["tail"], r["n"]) for r in found] == [(None, 4_000_000)]


def test_congestion_counts_cancelled_and_unknown_hours(spark):
    rows = [trip(1, 600), trip(2, 610, cancelled=1, arr_delay=None), trip(3, 700), trip(4, None), trip(5, None)]
    got = by_id(dayof_features(trips(spark, rows)), "dep_congestion", "airport_state")
    assert [got[i][0] for i in (1, 2, 3, 4, 5)] == [2, 2, 1, 2, 2]
    assert got[4][1] == 0.2


def test_state_is_the_mean_of_hourly_means(spark):
    rows = (
        [trip(i, 480 + i, dep_late=int(i == 0)) for i in range(4)]  # 08h: 0.25
        + [trip(10, 540, dep_late=1)]  # 09h: 1.0
        + [trip(20, 600, dep_late=0)]  # 10h: sees 08h and 09h
        + [trip(30, 720, dep_late=0)]  # 12h: sees 10h only
        + [trip(40, 1000, dep_late=0)]  # 16h: gap, default
        + [trip(50, 660, dep_late=None, cancelled=1, arr_delay=None)]  # 11h without any known departure: default
        + [trip(60, 10)]  # hour 0: default
    )
    got = by_id(dayof_features(trips(spark, rows)), "airport_state")
    assert got[20] == (0.625,) and got[30] == (0.0,) and got[40] == (0.2,) and got[50] == (0.2,) and got[60] == (0.2,)


def test_shifted_join_equals_window(spark):
    rng = random.Random(5)
    rows = [
        trip(i, rng.randrange(1440), origin=rng.choice(["AAA", "BBB"]), dep_late=rng.choice([0, 1, None])) for i in range(400)
    ]
    hours = hub_hours(trips(spark, rows))
    keys = ["origin", "flight_date", "dep_hour"]
    rounded = F.round("airport_state", 9)
    window = hub_state(hours, default=None).filter("airport_state is not null").select(*keys, rounded)
    assert set(window.collect()) == set(hub_state_by_shift(hours).select(*keys, rounded).collect())
