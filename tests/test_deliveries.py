import os

from onblock.sources.deliveries import TripDeliveries
from tests.test_sources import line, write


def rows(df):
    return sorted((r["year"], r["month"], r["origin"], r["arr_delay"]) for r in df.collect())


def test_copies_late_files_and_corrections(spark, tmp_path):
    landing, glob = tmp_path / "raw", f"{tmp_path}/raw/*.csv"
    landing.mkdir()
    table = TripDeliveries(spark, f"{tmp_path}/table")
    february = line(FlightDate="2024-02-01", Origin="SFO")
    write(landing, "m_01.csv", [line(), line(Origin="BOS"), "2024-01-05,1,5", line(Distance="far")])
    write(landing, "m_02.csv", [february])
    first = [(2024, 1, "BOS", -12.0), (2024, 1, "JFK", -12.0), (2024, 2, "SFO", -12.0)]
    assert rows(table.land(glob, 0)) == first

    write(landing, "m_02_copy.csv", [february])  # the same content under another name
    assert rows(table.land(glob, 1)) == first

    write(landing, "m_01_late.csv", [line(Origin="ORD"), line(Origin="ORD")])  # a late file of a landed month; its own equal rows stay
    later = sorted([*first, (2024, 1, "ORD", -12.0), (2024, 1, "ORD", -12.0)])
    assert rows(table.land(glob, 2)) == later

    write(landing, "m_01.csv", [line(ArrDelay="7.00"), line(FlightDate="2024-03-01", Origin="BOS")])  # corrected: one row moves to March
    os.remove(landing / "m_02.csv")  # archived files keep their rows
    os.remove(landing / "m_02_copy.csv")
    corrected = [(2024, 1, "JFK", 7.0), (2024, 1, "ORD", -12.0), (2024, 1, "ORD", -12.0), (2024, 2, "SFO", -12.0), (2024, 3, "BOS", -12.0)]
    assert rows(table.land(glob, 3)) == corrected
    assert rows(table.land(glob, 3)) == corrected  # the same landing again
    assert sorted(os.listdir(f"{table.trips}/landing=3/year=2024"))[-2:] == ["month=1", "month=3"]

    write(landing, "m_01.csv", [line(FlightDate="2024-03-02", Origin="BOS")])  # January keeps the late file only
    assert rows(table.land(glob, 4)) == [(2024, 1, "ORD", -12.0), (2024, 1, "ORD", -12.0), (2024, 2, "SFO", -12.0), (2024, 3, "BOS", -12.0)]


def test_a_month_can_become_empty(spark, tmp_path):
    landing, glob = tmp_path / "raw", f"{tmp_path}/raw/*.csv"
    landing.mkdir()
    table = TripDeliveries(spark, f"{tmp_path}/table")
    write(landing, "a.csv", [line()])
    table.land(glob, 0)
    write(landing, "a.csv", [line(FlightDate="2024-02-01", Origin="SFO")])
    assert rows(table.land(glob, 1)) == [(2024, 2, "SFO", -12.0)]
