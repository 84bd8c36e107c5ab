"""Streaming forms of the replay and of the causal features.

Sources are file streams. Every query stops when the available files are read; results are read back as tables. State and results lie in
the `root` that the caller gives: a later run with the same root goes on where the last one stopped. Without one, a run has a
folder of its own below the shared folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.storagelevel import StorageLevel

from onblock.operators.features import HUB_HOUR, STATE_DEFAULT, hub_state, leg_order, previous_leg
from onblock.operators.lagging import HeavyGroups
from onblock.plans.replay import score_aggregates, with_landing_time, with_uid
from onblock.runtime import fresh_path
from onblock.sources.ingest import target_exists

STATE_STORE, PARTITIONS = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"
OPEN_ROWS, RING = "rows", "ring"
RING_HOURS = "flight_date date, dep_hour int, dep_rate double"
PACKED = "flight_date date, _slice int, _day timestamp, packed binary"
PACK_ROWS = 500_000  # rows that a task holds before it packs them by key


def file_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1) -> DataFrame:
    """A Parquet table of a folder as a stream of its files."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).options(pathGlobFilter=name, maxFilesPerTrigger=files_per_batch).parquet(folder)


def _run(writer: DataStreamWriter, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _run_updates(df: DataFrame, keys: list[str], label: str, root: str | None = None) -> DataFrame:
    """Runs an aggregation in update mode and returns the last version of every key.

    Each batch writes its own folder, so a repeated batch replaces itself.
    """
    spark = df.sparkSession
    base = root or fresh_path(spark, label)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/rows/batch={number}")

    _run(df.writeStream.outputMode("update").foreachBatch(store), f"{base}/checkpoint")
    stored = spark.read.parquet(f"{base}/rows")
    values = [c for c in df.columns if c not in keys]
    latest = stored.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return latest.select(*keys, "v.*")


def scoreboard_stream(
    replay: DataFrame, lateness: str = "2 days", risk: str = "drisk", minutes: str = "dpdelay", root: str | None = None
) -> DataFrame:
    """Hourly score board over a stream of scored trips; equals the batch board while nothing is later than allowed."""
    board = (
        with_landing_time(replay)
        .withWatermark("landed_at", lateness)
        .groupBy(F.window("landed_at", "1 hour").alias("w"))
        .agg(*score_aggregates(risk, minutes))
        .withColumn("hour_start", F.col("w.start"))
        .drop("w")
    )
    return _run_updates(board, ["hour_start"], "scoreboard", root)


def landings_stream(replay: DataFrame, lateness: str = "2 days", root: str | None = None) -> DataFrame:
    """Landing feed: every trip once, repeated deliveries within the watermark are dropped."""
    spark = replay.sparkSession
    base = root or fresh_path(spark, "landings")
    feed = (
        with_uid(with_landing_time(replay))
        .withWatermark("landed_at", lateness)
        .dropDuplicatesWithinWatermark(["flight_id"])
        .select("flight_id", "uid", "landed_at", "real", "delay", "drisk")
    )
    _run(feed.writeStream.outputMode("append").format("parquet").option("path", f"{base}/rows"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows")


class _RecentHours(StatefulProcessor):
    """Adds to each closed hour of a hub the mean late share of the two hours before; keeps the rated hours of the last two.

    Hours close in the order of time, so those of one batch are later than all that the hub has seen.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState(RING, RING_HOURS)

    def handleInputRows(self, key, rows, timerValues):
        closed: dict[tuple, dict] = {}
        for row in rows:
            closed.setdefault((row["flight_date"], row["dep_hour"]), {})[row["dep_del15"]] = row["n"]
        ring = list(self.ring.get())
        for (day, hour), counts in sorted(closed.items()):
            ring = [held for held in ring if held[0] == day and held[1] >= hour - 2]
            rated = sum(n for late, n in counts.items() if late is not None)
            rate = sum(late * n for late, n in counts.items() if late is not None) / rated if rated else None
            state = None
            if key[0] is not None and rated:
                state = sum(held[2] for held in ring) / len(ring) if ring else None
                ring.append((day, hour, rate))
            yield Row(origin=key[0], flight_date=day, dep_hour=hour, dep_congestion=sum(counts.values()), dep_rate=rate, airport_state=state)
            ring = [held for held in ring if held[1] >= hour - 1]
        self.ring.put(ring) if ring else self.ring.clear()


def hub_state_stream(trips: DataFrame, lateness: str = "2 days", root: str | None = None, default: float = STATE_DEFAULT) -> DataFrame:
    """Congestion and recent state of every hub hour; trips without a day or an hour are left out.

    A watermarked aggregation counts the hours. An hour that closes meets the last two hours of its hub, which are all that is kept of
    closed hours, and is appended to the results once. Hours still open are read from the state and returned, but not stored.
    """
    spark = trips.sparkSession
    base = root or fresh_path(spark, "hub-hours")
    rows, checkpoint = f"{base}/rows", f"{base}/checkpoint"
    key = [*HUB_HOUR, "dep_del15"]
    counted = (
        trips.withColumn("at", F.timestamp_add("HOUR", F.col("dep_hour"), F.col("flight_date").cast("timestamp")))
        .filter("at is not null")
        .withWatermark("at", lateness)
        .groupBy(F.window("at", "1 hour"), *key)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kinds = dict(counted.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in HUB_HOUR) + ", dep_congestion long, dep_rate double, airport_state double"
    closed = counted.select(*key, "n").groupBy("origin").transformWithState(_RecentHours(), schema, "append", "none")
    with _keyed_state(spark):
        _run(closed.writeStream.outputMode("append").format("parquet").option("path", rows), checkpoint)
        # Stateful operators are numbered from the end of the plan.
        counts = _state(spark, checkpoint, operatorId=1).select("key.*", F.col("value.count").alias("n"))
        ring = _state(spark, checkpoint, operatorId=0, stateVarName=RING)
    rated = F.when(F.col("dep_del15").isNotNull(), F.col("n"))
    still = counts.groupBy(*HUB_HOUR).agg(
        F.sum("n").alias("dep_congestion"), F.try_divide(F.sum(F.col("dep_del15") * F.col("n")), F.sum(rated)).alias("dep_rate")
    )
    before = ring.select("key.origin", "list_element.*").select(*HUB_HOUR, "dep_rate").withColumn("_closed", F.lit(True))
    present = hub_state(still.unionByName(before, allowMissingColumns=True), None).filter("_closed is null").drop("_closed")
    both = spark.read.schema(schema).parquet(rows).unionByName(present)
    return both.withColumn("airport_state", F.coalesce("airport_state", F.lit(default)))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each day and slice as one Arrow stream, so that state handles few values, typed as they came."""
    held: list[pa.RecordBatch] = []

    def pack() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().sort_by([("flight_date", "ascending"), ("_slice", "ascending")])
        held.clear()
        key = rows.select(["flight_date", "_slice", "_day"])
        ends = key.append_column("at", pa.array(range(len(key)), pa.int64())).group_by(["flight_date", "_slice", "_day"], use_threads=False)
        firsts = ends.aggregate([("at", "min"), ("at", "count")])
        values = rows.drop_columns(["_slice", "_day"])
        parts = []
        for at, n in zip(firsts["at_min"].to_pylist(), firsts["at_count"].to_pylist(), strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, values.schema) as stream:
                stream.write_table(values.slice(at, n))
            parts.append(sink.getvalue().to_pybytes())
        columns = [firsts[c].combine_chunks() for c in key.column_names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())], [*key.column_names, "packed"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= PACK_ROWS:
            yield from _few(pack())
    if sum(b.num_rows for b in held):
        yield from _few(pack())


def _few(batch: pa.RecordBatch, rows: int = 64) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch.column(0):
            yield from pa.ipc.open_stream(part.as_buffer())


class _OpenDay(StatefulProcessor):
    """Holds the packed rows of one key of a day until the watermark reaches the day, hands them on and forgets them.

    Every key of a day has the same timer, so a day leaves the state whole, in one batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.rows = handle, handle.getListState(OPEN_ROWS, "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        if not self.rows.exists():
            midnight = dt.datetime.combine(key[0], dt.time(), dt.timezone.utc)
            self.handle.registerTimer(int(midnight.timestamp() * 1000))
        for row in rows:
            self.rows.appendValue((bytes(row["packed"]),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for (packed,) in self.rows.get():
            yield Row(packed=bytes(packed))
        self.rows.clear()


class DailyLegs:
    """Previous-leg features for a stream of trips, emitted day by day.

    Rows of open days are keyed state: `slices` lists a day, vehicles dealt to them by hash and unregistered ones row by row, so none holds the whole of
    a heavy group. Tasks pack the rows of a batch by key before they meet the state, which so takes one value a key and task. A day is due as soon as the watermark, `allowed_days` behind the newest day, reaches it: its rows leave the state together and the batch
    operator runs over them, so groups of any size stay cut into ranges. State is bounded by the watermark, landed rows are never read again, and rows of a
    day that is closed are late and dropped, as are rows without a day. Results are keyed by day: a repeated batch rewrites the same files.
    The number of slices may change between runs.
    """

    def __init__(
        self,
        spark: SparkSession,
        allowed_days: int = 1,
        heavy: HeavyGroups | None = HeavyGroups(),
        root: str | None = None,
        slices: int = 128,
    ):
        self.spark, self.allowed, self.heavy, self.slices = spark, allowed_days, heavy, slices
        base = root or fresh_path(spark, "legs")
        self.out, self.checkpoint = f"{base}/out", f"{base}/checkpoint"

    def _due(self, trips: DataFrame) -> DataFrame:
        """The packed rows of closed days, as they close."""
        place = F.when(F.col("tail").isNull(), F.xxhash64(*leg_order(trips))).otherwise(F.xxhash64("tail"))
        keyed = (
            trips.filter("flight_date is not null")
            .withColumn("_slice", F.pmod(place, F.lit(self.slices)).cast("int"))
            .withColumn("_day", F.col("flight_date").cast("timestamp"))
        )
        return (
            keyed.repartition("flight_date", "_slice")
            .mapInArrow(_packed, PACKED)
            .withWatermark("_day", f"{self.allowed} days")
            .groupBy("flight_date", "_slice")
            .transformWithState(_OpenDay(), "packed binary", "append", "eventTime")
        )

    def _store(self, packed: DataFrame, number: int) -> None:
        due = packed.mapInArrow(_unpacked, self.schema).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not due.isEmpty():
                _overwrite_partitions(previous_leg(due, heavy=self.heavy), ["flight_date"], self.out)
        finally:
            due.unpersist()

    def _open(self) -> DataFrame:
        """The rows of open days, read from the state."""
        return _state(self.spark, self.checkpoint, stateVarName=OPEN_ROWS).select("list_element.packed").mapInArrow(_unpacked, self.schema)

    def run(self, trips: DataFrame) -> DataFrame:
        """Reads the stream to its present end and returns the features of all days.

        Days within the allowance stay open for the next run on the same root: their features are computed from the rows so far and
        returned, but not stored.
        """
        self.schema = trips.schema
        with _keyed_state(self.spark):
            _run(self._due(trips).writeStream.foreachBatch(self._store), self.checkpoint)
            present = previous_leg(self._open(), heavy=self.heavy)
        if not target_exists(self.spark, self.out):
            return present
        return self.spark.read.parquet(self.out).unionByName(present)


def _state(spark: SparkSession, checkpoint: str, **options: str | int) -> DataFrame:
    """What a stopped stream holds in its state."""
    return spark.read.format("statestore").options(path=checkpoint, **options).load()


@contextmanager
def _keyed_state(spark: SparkSession):
    """Streams begun inside keep their state in RocksDB, which keyed processors need, in one partition for each core: every partition starts a
    Python worker in every batch. A stream keeps the number that it began with."""
    settings = {
        STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        PARTITIONS: str(spark.sparkContext.defaultParallelism),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _overwrite_partitions(df: DataFrame, by: list[str], path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
