import datetime as dt
import os

from onblock.sources import ingest, sinks

HEADER = list(ingest.TRIP_COLUMNS) + ["DepDelay", "Extra"]


def line(**fields):
    base = dict(
        FlightDate="2024-01-05", Month="1", DayOfWeek="5", CRSDepTime="2400", DepTimeBlk="0001-0559", Reporting_Airline="AA",
        Tail_Number="N1", Origin="JFK", Dest="LAX", Distance="2475.00", CRSElapsedTime="330.00", Cancelled="0.00",
        Diverted="0.00", ArrDelay="-12.00", ArrDel15="0.00", DepDel15="0.00", DepDelay="1.00", Extra="",
    )
    return ",".join({**base, **fields}[c] for c in HEADER)


def write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("\n".join([",".join(HEADER), *lines]) + "\n")
    return path


def test_trip_files(spark, tmp_path):
    write(tmp_path, "m_01.csv", [
        line(),
        line(CRSDepTime="0915", ArrDelay="", ArrDel15="", CRSElapsedTime="", Tail_Number="", Cancelled="1.00"),
        line(Distance="far"),  # filled but not a number: dropped
        "2024-01-05,1,5",  # ragged: dropped
        line() + ",more",  # ragged: dropped
    ])
    raw = ingest.read_trip_files(spark, f"{tmp_path}/m_*.csv")
    shape = ingest.raw_shape(raw).first()
    assert (shape["n_rows"], shape["n_columns"]) == (3, len(HEADER))
    a, b = ingest.typed_trips(raw).orderBy("dep_min", ascending=False).collect()
    assert (a["flight_date"], a["dep_hour"], a["dep_min"]) == (dt.date(2024, 1, 5), 0, 1440)
    assert (a["distance"], a["crs_elapsed"], a["arr_delay"], a["arr_del15"]) == (2475, 330, -12.0, 0)
    assert (b["dep_hour"], b["dep_min"], b["tail"], b["crs_elapsed"], b["arr_delay"], b["cancelled"]) == (9, 555, None, None, None, 1)


def test_months_land_once(spark, tmp_path):
    target = f"{tmp_path}/trips"
    landing = tmp_path / "raw"
    landing.mkdir()
    write(landing, "m_01.csv", [line(), line(Origin="BOS")])
    assert ingest.ingest_new_months(spark, f"{landing}/*.csv", target, 2024).count() == 2
    write(landing, "m_02.csv", [line(FlightDate="2024-02-01", Month="2")])
    write(landing, "m_03.csv", [line(FlightDate="2024-03-01", Month="3")])
    got = ingest.ingest_new_months(spark, f"{landing}/*.csv", target, 2024, 1, 2)
    assert sorted((r["month"], r["origin"]) for r in got.collect()) == [(1, "BOS"), (1, "JFK"), (2, "JFK")]
    assert ingest.ingest_new_months(spark, f"{landing}/*.csv", target, 2024, 1, 2).count() == 3


def test_airport_file(spark, tmp_path):
    path = tmp_path / "airports.dat"
    path.write_text(
        '1,"Kennedy, Intl","New York","United States","JFK","KJFK",40.63,-73.77,13,-5,"A","x","airport","y"\n'
        '2,"No code","Town","Land",\\N,"XXXX",1.0,2.0,13,-5,"A","x","airport","y"\n'
        '3,"Long","Town","Land","LONG","XXXX",1.0,2.0,13,-5,"A","x","airport","y"\n'
    )
    rows = ingest.read_airports(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("JFK", "Kennedy, Intl", "New York", "United States", 40.63, -73.77)]


def test_sinks_read_back(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-15", "a", 1), ("2024-02-15", "b", 2)], "flight_date string, o string, n int")
    sinks.write_days(df, f"{tmp_path}/days")
    assert sorted(os.listdir(tmp_path / "days"))[-2:] == ["flight_date=2024-01-15", "flight_date=2024-02-15"]
    sinks.write_days(df.filter("n = 2").withColumn("n", df.n * 10), f"{tmp_path}/days")
    assert sorted(r["n"] for r in spark.read.json(f"{tmp_path}/days").collect()) == [1, 20]
    sinks.write_csv(df, f"{tmp_path}/csv")
    assert sinks.read_csv(spark, f"{tmp_path}/csv", "flight_date string, o string, n int").count() == 2
    sinks.write_json(df, f"{tmp_path}/json")
    assert sinks.read_lookup(spark, f"{tmp_path}/json").count() == 2
    sinks.publish(df, "shown", str(tmp_path))
    sinks.publish(df.filter("n = 1"), "shown", str(tmp_path))
    assert spark.table("shown").count() == 1
