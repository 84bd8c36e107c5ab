import datetime as dt
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from onblock.operators.features import dayof_features
from onblock.operators.lagging import HeavyGroups
from onblock.plans.refresh import FeatureTable
from tests.rows import DAY, trip, trips

COLUMNS = ["flight_id", "flight_date", "tail", "prev_arr_delay", "turnaround", "dep_congestion", "airport_state"]


def rows_of(df):
    return sorted(map(str, df.withColumn("airport_state", F.round("airport_state", 9)).select(*COLUMNS).collect()))


def some_trips(n, days, seed):
    rng = random.Random(seed)
    return [
        trip(
            i,
            rng.choice([None, *range(0, 1440, 7)]),
            tail=rng.choice(["N1", "N2", "N3", None]),
            origin=rng.choice(["AAA", "CCC", None]),
            arr_delay=rng.choice([None, 5.0, 50.0]),
            dep_late=rng.choice([None, 0, 1]),
            day=DAY + dt.timedelta(days=rng.randrange(days)),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("heavy", [HeavyGroups(), HeavyGroups(min_rows=8)])
def test_three_landings_equal_the_full_build(spark, tmp_path, heavy):
    rows = some_trips(240, 6, 1)
    late = [r for r in rows if r[0] % 11 == 0 and r[1] < DAY + dt.timedelta(days=2)]
    rest = [r for r in rows if r not in late]
    first = [r for r in rest if r[1] < DAY + dt.timedelta(days=4)]
    second = [r for r in rest if r not in first]
    table, so_far = FeatureTable(spark, str(tmp_path), heavy=heavy), []
    for number, part in enumerate([first, second, late]):
        so_far += part
        got = table.land(trips(spark, part), number)
        assert rows_of(got) == rows_of(dayof_features(trips(spark, so_far)))
    written = {p.name for p in (Path(tmp_path) / "features" / "landing=2").glob("flight_date=*")}
    assert written == {f"flight_date={r[1]}" for r in late}
    assert rows_of(table.land(trips(spark, late), 2)) == rows_of(dayof_features(trips(spark, rows)))  # the same landing again


def test_a_landing_reads_its_own_days_only(spark, tmp_path):
    table = FeatureTable(spark, str(tmp_path))
    table.land(trips(spark, some_trips(80, 5, 2)), 0)
    part = table.read(days=[DAY])
    files = {Path(r[0]).parent.name for r in part.select("_metadata.file_path").distinct().collect()}
    assert files == {f"flight_date={DAY}"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*flight_date", plan)


def test_a_landing_broken_off_before_its_list_of_days_does_not_count(spark, tmp_path):
    table = FeatureTable(spark, str(tmp_path))
    kept = rows_of(table.land(trips(spark, some_trips(60, 2, 3)), 0))
    table.read().write.partitionBy("flight_date").parquet(f"{table.features}/landing=1")
    assert rows_of(table.read()) == kept


def test_empty_landings(spark, tmp_path):
    table = FeatureTable(spark, str(tmp_path))
    assert table.land(trips(spark, []), 0) is None
    kept = rows_of(table.land(trips(spark, some_trips(20, 2, 4)), 1))
    assert rows_of(table.land(trips(spark, []), 2)) == kept
