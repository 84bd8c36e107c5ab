"""Monthly trip files that may come twice, late or corrected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onblock.sources.ingest import read_trip_files, target_exists, typed_trips

FILE = "source_file"
LEDGER = "path string, size long, digest string, year int, month int"


def file_digests(spark: SparkSession, glob: str) -> DataFrame:
    """path, size and digest of every file with a line. The digest adds up hashes of the lines, so files of any size are read in splits and
    combined before the shuffle; it does not depend on the order of lines."""
    lines = spark.read.text(glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.xxhash64("value").alias("h")
    )
    again = F.xxhash64(F.col("h"), F.lit(1))
    digest = F.concat_ws(":", F.count(F.lit(1)), *[F.sum(h.cast("decimal(28,0)")) for h in (F.col("h"), again)])
    return lines.groupBy("path", "size").agg(digest.alias("digest"))


class TripDeliveries:
    """The typed trips of all files delivered so far, in folders per landing, year and month below `root`.

    A file counts as known by its size and digest, whatever its path: copies bring nothing. A known path with other content replaces what the file
    brought before. A landing reads the files that are new or changed, and builds only the months again that they hold or held, from stored rows of the other
    files and the new rows; files that are gone keep their rows. The ledger of files and months is written last and makes a landing count, so one
    broken off or given again under its number replaces itself. Landings are numbered from 0. Rows without a date are left out. A row per file
    and per month passes through the driver.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.parsed, self.trips, self.ledger = (f"{root.rstrip('/')}/{part}" for part in ("parsed", "trips", "ledger"))

    def _ledger(self, before: int | None) -> DataFrame:
        if not target_exists(self.spark, self.ledger):
            return self.spark.createDataFrame([], LEDGER + ", landing int")
        kept = self.spark.read.schema(LEDGER + ", landing int").parquet(self.ledger)
        return kept if before is None else kept.filter(F.col("landing") < before)

    def files(self, before: int | None = None) -> DataFrame:
        """The present version of every file."""
        known = self._ledger(before).filter("path is not null")
        return known.groupBy("path").agg(F.max_by(F.struct("size", "digest"), "landing").alias("v")).select("path", "v.*")

    def land(self, glob: str, number: int) -> DataFrame | None:
        """Takes in what is new below `glob` and returns the table with it."""
        known = self.files(number)
        fresh = file_digests(self.spark, glob).join(known.select("size", "digest"), ["size", "digest"], "left_anti")
        changed = fresh.groupBy("size", "digest").agg(F.min("path").alias("path")).select("path", "size", "digest").collect()
        months: set[tuple[int, int]] = set()
        if changed:
            paths = [row["path"] for row in changed]
            replaced = self.spark.createDataFrame([(path,) for path in paths], f"{FILE} string")
            raw = read_trip_files(self.spark, paths, path_as=FILE)
            read = typed_trips(raw, (FILE,)).filter("flight_date is not null").drop("month")
            place = f"{self.parsed}/landing={number}"
            read.withColumns({"year": F.year("flight_date"), "month": F.month("flight_date")}).write.mode("overwrite").parquet(place)
            new = self.spark.read.parquet(place)
            stored = self.read(before=number)
            held = [new] if stored is None else [new, stored.join(replaced, FILE, "left_semi")]
            for part in held:
                months |= {tuple(row) for row in part.select("year", "month").distinct().collect()}
            rest = self.read(before=number, months=months)
            if rest is not None:
                new = rest.join(replaced, FILE, "left_anti").unionByName(new)
            spread = new.hint("rebalance", "year", "month")
            spread.write.mode("overwrite").partitionBy("year", "month").parquet(f"{self.trips}/landing={number}")
        entries = [(*row, None, None) for row in changed] + [(None, None, None, *of) for of in sorted(months)]
        self.spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{self.ledger}/landing={number}")
        return self.read(before=number + 1)

    def read(self, before: int | None = None, months: set[tuple[int, int]] | None = None) -> DataFrame | None:
        """The trips as of the landings under number `before`, of all months or of those given; None where there are none."""
        listed = self._ledger(before).filter("month is not null").groupBy("year", "month").agg(F.max("landing").alias("landing"))
        last = [row for row in listed.collect() if months is None or (row["year"], row["month"]) in months]
        if not last:
            return None
        # Conditions on partition columns, so that no other folder is read.
        parts = [(F.col("landing") == row["landing"]) & (F.col("year") == row["year"]) & (F.col("month") == row["month"]) for row in last]
        return self.spark.read.parquet(self.trips).filter(reduce(lambda a, b: a | b, parts)).drop("landing")
