"""The day-of feature table kept up to date as trips land."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onblock.operators.features import HUB_HOUR, dayof_features, hub_hours, hub_state, previous_leg, with_hub_hours
from onblock.operators.lagging import HeavyGroups
from onblock.sources.ingest import target_exists

LEG_FEATURES, HUB_FEATURES = ["prev_arr_delay", "turnaround"], ["dep_congestion", "airport_state"]


class FeatureTable:
    """Features of all trips landed so far, in folders per landing and day below `root`.

    No feature looks beyond its day, so a landing reads and writes the days of its own trips only. Within them just the vehicles, and the hub hours with the
    two hours after, that got new trips are computed again; all other rows keep their values. A day's rows are those of the last landing that
    wrote it. The list of days is written last and makes a landing count, so one that was broken off or is given again under its number replaces
    itself; readers of the versions before are not disturbed, and old versions are the caller's to remove. Landings are numbered from 0 and bring new trips;
    trips without a day are left out. What passes through the driver is one value for each day.
    """

    def __init__(self, spark: SparkSession, root: str, tiebreak: list[str] | None = None, heavy: HeavyGroups | None = HeavyGroups()):
        self.spark, self.tiebreak, self.heavy = spark, tiebreak, heavy
        self.landed, self.features, self.days = (f"{root.rstrip('/')}/{part}" for part in ("landed", "features", "days"))

    def land(self, trips: DataFrame, number: int) -> DataFrame:
        """Takes the new trips in and returns the table with them."""
        path = f"{self.landed}/landing={number}"
        trips.filter("flight_date is not null").write.mode("overwrite").parquet(path)
        new = self.spark.read.parquet(path)
        days = [row[0] for row in new.select("flight_date").distinct().collect()]
        known = self.read(before=number, days=days)
        fresh = dayof_features(new, tiebreak=self.tiebreak, heavy=self.heavy) if known is None else self._refreshed(known, new)
        spread = fresh.hint("rebalance", "flight_date")
        spread.write.mode("overwrite").partitionBy("flight_date").parquet(f"{self.features}/landing={number}")
        listed = self.spark.createDataFrame([(day,) for day in days], "flight_date date")
        listed.write.mode("overwrite").parquet(f"{self.days}/landing={number}")
        return self.read(before=number + 1)

    def _refreshed(self, known: DataFrame, new: DataFrame) -> DataFrame:
        vehicles = new.select("tail", "flight_date").distinct()
        moved = _matching(known, vehicles, "left_semi").drop(*LEG_FEATURES).unionByName(new, allowMissingColumns=True)
        legs = previous_leg(moved, tiebreak=self.tiebreak, heavy=self.heavy).unionByName(_matching(known, vehicles, "left_anti"))

        hubs = new.select("origin", "flight_date").distinct()
        counted = [*HUB_HOUR, "dep_del15"]
        at_hubs = _matching(known.select(*counted), hubs, "left_semi").unionByName(new.select(*counted))
        later = F.explode(F.array(*[F.col("dep_hour") + i for i in range(3)]))
        touched = new.select("origin", "flight_date", later.alias("dep_hour")).distinct()
        hours = _matching(hub_state(hub_hours(at_hubs)), touched, "left_semi")
        renewed = hours.select(*HUB_HOUR, *[F.col(c).alias(f"_{c}") for c in HUB_FEATURES])
        joined = with_hub_hours(legs, renewed, [f"_{c}" for c in HUB_FEATURES])
        # A renewed hour has a count and a state; trips of other hours keep theirs.
        return joined.withColumns({c: F.coalesce(f"_{c}", c) for c in HUB_FEATURES}).drop(*[f"_{c}" for c in HUB_FEATURES])

    def read(self, before: int | None = None, days: Iterable[dt.date] | None = None) -> DataFrame | None:
        """The features as of the landings under number `before`, of all days or of those given; None where there are none."""
        if not target_exists(self.spark, self.days):
            return None
        listed = self.spark.read.parquet(self.days)
        if before is not None:
            listed = listed.filter(F.col("landing") < before)
        wanted, last = None if days is None else set(days), {}
        for row in listed.groupBy("flight_date").agg(F.max("landing").alias("landing")).collect():  # a row a day
            if wanted is None or row["flight_date"] in wanted:
                last.setdefault(row["landing"], []).append(row["flight_date"])
        if not last:
            return None
        # Conditions on partition columns, so that no other folder is read.
        parts = [(F.col("landing") == number) & F.col("flight_date").isin(sorted(of)) for number, of in last.items()]
        return self.spark.read.parquet(self.features).filter(reduce(lambda a, b: a | b, parts)).drop("landing")


def _matching(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of `df` with (left_semi) or without (left_anti) a row of `keys`; null matches null."""
    side = keys.select(*[F.col(c).alias(f"_key_{c}") for c in keys.columns])
    same: Column = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys.columns])
    return df.join(side, same, how)
