"""Reading monthly trip files and airport files, and landing new months."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sixteen source columns in use, with the type each text is read as.
TRIP_COLUMNS = {
    "FlightDate": "date",
    "Month": "int",
    "DayOfWeek": "int",
    "CRSDepTime": "int",
    "DepTimeBlk": "string",
    "Reporting_Airline": "string",
    "Tail_Number": "string",
    "Origin": "string",
    "Dest": "string",
    "Distance": "int",
    "CRSElapsedTime": "int",
    "Cancelled": "int",
    "Diverted": "int",
    "ArrDelay": "double",
    "ArrDel15": "int",
    "DepDel15": "int",
}
# Positions in the headerless airport file, and its mark for a missing code.
AIRPORT_POSITIONS = {1: "name", 2: "city", 3: "country", 4: "iata", 6: "lat", 7: "lon"}
AIRPORT_WIDTH = 14
MISSING_CODE = r"\N"


def read_trip_files(spark: SparkSession, glob: str | list[str], path_as: str | None = None) -> DataFrame:
    """All columns as text, named by the header line of their own file; rows with too few or too many fields are dropped.

    Files may order their columns differently: those with the same header are read together and the groups are joined by name.
    Column pruning is off for this read, because a pruned parse no longer notices ragged rows. `path_as` adds the path of the file.
    """
    by_header: dict[str, list[str]] = {}
    for row in header_lines(spark, glob).collect():  # a row a file
        by_header.setdefault(row["header"], []).append(row["path"])
    reader = spark.read.options(header=True, mode="DROPMALFORMED", columnPruning=False)
    parts = [reader.csv(paths) for paths in by_header.values()]
    if path_as:
        parts = [part.select("*", F.col("_metadata.file_path").alias(path_as)) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def header_lines(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """path and header, the first line, of every file that has one; all files are looked at in one job."""
    lines = spark.read.text(glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("at")
    )
    return lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header")).orderBy("path")


def _value(name: str, kind: str) -> Column:
    text = F.nullif(F.trim(F.col(name)), F.lit(""))
    if kind == "string":
        return text
    if kind == "int":
        return F.bround(text.try_cast("double")).try_cast("int")
    return text.try_cast(kind)


def typed_trips(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The trip table from text columns and those to `keep`; rows with a filled field that does not parse are dropped."""
    from onblock.functions.clock import hour_of_hhmm, minute_of_hhmm

    parsed = raw.select(
        *[_value(c, kind).alias(c) for c, kind in TRIP_COLUMNS.items()],
        *[(F.trim(F.col(c)) != "").alias(f"_{c}") for c in TRIP_COLUMNS],
        *keep,
    )
    sound = F.lit(True)
    for c in TRIP_COLUMNS:
        sound = sound & (F.col(c).isNotNull() | ~F.coalesce(F.col(f"_{c}"), F.lit(False)))
    return parsed.filter(sound).select(
        F.col("FlightDate").alias("flight_date"),
        F.col("Month").alias("month"),
        F.col("DayOfWeek").alias("day_of_week"),
        hour_of_hhmm("CRSDepTime").alias("dep_hour"),
        minute_of_hhmm("CRSDepTime").alias("dep_min"),
        F.col("DepTimeBlk").alias("dep_block"),
        F.col("Reporting_Airline").alias("airline"),
        F.col("Tail_Number").alias("tail"),
        F.col("Origin").alias("origin"),
        F.col("Dest").alias("dest"),
        F.col("Distance").alias("distance"),
        F.col("CRSElapsedTime").alias("crs_elapsed"),
        F.col("Cancelled").alias("cancelled"),
        F.col("Diverted").alias("diverted"),
        F.col("ArrDelay").alias("arr_delay"),
        F.col("ArrDel15").alias("arr_del15"),
        F.col("DepDel15").alias("dep_del15"),
        *keep,
    )


def valid_code(code: Column | str) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    return (F.length(code) == 3) & (code != MISSING_CODE)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """The headerless airport file: text by position, rows with a three-letter code only, one per code.

    Of several rows with one code the first by name, city, country and position stays.
    """
    schema = ", ".join(f"c{i} string" for i in range(AIRPORT_WIDTH))
    raw = spark.read.options(header=False, escape="\\").schema(schema).csv(path)
    named = raw.select(*[F.col(f"c{i}").alias(name) for i, name in AIRPORT_POSITIONS.items()])
    kept = named.filter(valid_code("iata")).withColumns(
        {c: F.col(c).try_cast("double") for c in ("lat", "lon")}
    )
    rest = ["name", "city", "country", "lat", "lon"]
    one = kept.groupBy("iata").agg(F.min(F.struct(*rest)).alias("row"))
    return one.select("iata", *[f"row.{c}" for c in rest])


def raw_shape(raw: DataFrame) -> DataFrame:
    """Rows and columns of a raw file."""
    return raw.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(raw.columns)))


def only_new_months(raw: DataFrame, landed: DataFrame, year: int, first: int = 1, last: int = 12) -> DataFrame:
    """Rows of the wanted months that are not landed yet; `landed` may hold any number of rows per month."""
    wanted = raw.filter((F.col("year") == year) & F.col("month").between(first, last))
    return wanted.join(landed.select("year", "month").distinct(), ["year", "month"], "left_anti")


def ingest_new_months(
    spark: SparkSession, landing_glob: str, target: str, year: int, first: int = 1, last: int = 12
) -> DataFrame:
    """Lands the missing months of a year as typed Parquet, partitioned by year and month, and reads the target back.

    Only months that are not in the target are written, each into its own partition, so a repeated run is harmless.
    """
    trips = typed_trips(read_trip_files(spark, landing_glob)).withColumn("year", F.year("flight_date"))
    if target_exists(spark, target):
        trips = only_new_months(trips, spark.read.parquet(target), year, first, last)
    else:
        trips = trips.filter((F.col("year") == year) & F.col("month").between(first, last))
    # Rebalancing lets adaptive execution cut big months and join small ones into files of the advisory size.
    (
        trips.hint("rebalance", "year", "month")
        .sortWithinPartitions("year", "month", "origin")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(target)
    )
    return spark.read.parquet(target)


def target_exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
