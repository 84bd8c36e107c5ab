"""Shards of near equal bytes by a histogram sort: count, refine the splitters, exchange once.

Rows are ordered by the hash of their text, so equal texts lie together, then by the hash of their id, then by the hash of a number
that each row got when it was written, which tells repeated rows apart. The order is a line of 2**192 places. The first round counts the exact bytes in 2**TOP_BITS cells of that line; every later round opens the cells that
still hold a splitter, until every splitter is within the tolerance. Rounds read written keys and sizes only; texts move once.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onblock.llm.tables import carried, quoted, settle, unpacked

LAW = "bytes"
TOP_BITS = 12
COUNTS_PER_ROUND = 1 << 20
RANGE_BYTES = 1 << 30
PARTS = ("text_hash", "id_hash", "row_hash")
LINE = 1 << 192
ROW_IN_TASK = (1 << 33) - 1


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, plus 8 for the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _longs(place: int) -> tuple[int, int, int]:
    """The three signed hashes at a place of the line."""
    low, half = (1 << 64) - 1, 1 << 63
    return (place >> 128) - half, (place >> 64 & low) - half, (place & low) - half


def _bucket(place: int) -> int:
    return _longs(place)[0] >> (64 - TOP_BITS)


def _row_bucket() -> Column:
    return F.shiftright("text_hash", 64 - TOP_BITS)


def _reached(place: list[Column]) -> Column:
    """Whether a row lies at or behind a place given as three hashes."""
    text, key, row = (F.col(p) for p in PARTS)
    a, b, c = place
    return (text > a) | ((text == a) & ((key > b) | ((key == b) & (row >= c))))


def _opened(keys: DataFrame, cells: list[tuple[int, int]], step: int) -> DataFrame:
    """Bytes in the parts of the cells (start, log2 of the width); a cell is cut into parts of 2**step places of one of the hashes."""
    rows = []
    for number, (start, width) in enumerate(cells):
        rows.append((number, _bucket(start), _longs(start), _longs(start + (1 << width) - 1)))
    place = "struct<a: long, b: long, c: long>"
    table = keys.sparkSession.createDataFrame(rows, f"cell int, bucket long, first {place}, last {place}")
    met = keys.withColumn("bucket", _row_bucket()).join(F.broadcast(table), "bucket").filter(_reached([F.col(f"first.{x}") for x in "abc"]))
    behind = [F.col("text_hash") == F.col("last.a"), F.col("id_hash") == F.col("last.b"), F.col("row_hash") <= F.col("last.c")]
    before = [F.col("text_hash") < F.col("last.a"), F.col("id_hash") < F.col("last.b")]
    inside = met.filter(before[0] | (behind[0] & (before[1] | (behind[1] & behind[2]))))
    level = 2 - step // 64
    part = F.shiftright(PARTS[level], step % 64) - F.shiftright(f"first.{'abc'[level]}", step % 64)
    return inside.groupBy("cell", part.alias("part")).agg(F.sum("size").alias("n"), F.count("*").alias("rows"))


def splitters(keys: DataFrame, targets: list[int], tolerance: int) -> list[int]:
    """For each target a place of the line with that many bytes before it, within the tolerance or as near as rows allow.

    keys: text_hash, id_hash, row_hash and size, all long. A round is one aggregate and brings at most COUNTS_PER_ROUND counts, or four a
    target, to the driver; the number of rounds is bounded by the 192 bits of the line.
    """
    places: dict[int, int] = {}
    width = 192 - TOP_BITS
    top = keys.groupBy(_row_bucket().alias("bucket")).agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    sums = {None: sorted((row["bucket"] + (1 << (TOP_BITS - 1)), row["n"], row["rows"]) for row in top)}
    at: dict[int, tuple[int | None, int, int]] = {i: (None, 0, 0) for i in range(len(targets))}
    while at:
        later: dict[int, tuple[int, int]] = {}
        for i, (cell, origin, before) in at.items():
            parts = sums.get(cell, [])
            starts = list(accumulate((n for _, n, _ in parts), initial=before))
            p = bisect_right(starts, targets[i]) - 1
            if not parts or p >= len(parts):
                places[i] = LINE - 1
                continue
            low, high = starts[p], starts[p + 1]
            start = origin + (parts[p][0] << width)
            nearest, place = min((targets[i] - low, start), (high - targets[i], start + (1 << width)))
            if nearest <= tolerance or width == 0 or parts[p][2] == 1:
                places[i] = min(place, LINE - 1)
            else:
                later[i] = (start, low)
        if not later:
            break
        cells = sorted({start for start, _ in later.values()})
        number = {start: k for k, start in enumerate(cells)}
        bits = max(2, (COUNTS_PER_ROUND // len(cells)).bit_length() - 1)
        step = width - min(bits, 12, (width - 1) % 64 + 1)
        sums = {k: [] for k in number.values()}
        for row in _opened(keys, [(start, width) for start in cells], step).collect():
            sums[row["cell"]].append((row["part"], row["n"], row["rows"]))
        sums = {k: sorted(parts) for k, parts in sums.items()}
        at = {i: (number[start], start, before) for i, (start, before) in later.items()}
        width = step
    return [places[i] for i in range(len(targets))]


def _cells(spark: SparkSession, places: list[int]) -> DataFrame:
    """For every bucket of the line: how many places lie in buckets before it, and those within it."""
    within: dict[int, list[tuple[int, int, int]]] = {}
    for place in places:
        within.setdefault(_bucket(place), []).append(_longs(place))
    half, rows, before = 1 << (TOP_BITS - 1), [], 0
    for bucket in range(-half, half):
        rows.append((bucket, before, within.get(bucket, [])))
        before += len(rows[-1][2])
    return spark.createDataFrame(rows, "bucket long, before int, places array<struct<a: long, b: long, c: long>>")


def _placed(df: DataFrame, cells: DataFrame) -> DataFrame:
    """Adds cell, the number of places that the row has reached. cells has 2**TOP_BITS rows and one entry a place."""
    reached = F.size(F.filter("places", lambda p: _reached([p["a"], p["b"], p["c"]])))
    found = df.withColumn("bucket", _row_bucket()).join(F.broadcast(cells), "bucket", "left")
    return found.withColumn("cell", F.col("before") + reached).drop("bucket", "before", "places")


def shard(
    docs: DataFrame, shards: int = 24, text: str = "text", key: str = "doc_id", tolerance: float = 0.001, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Adds size, text_crc32, law, shard, slot and grown_shard to every row.

    law is `bytes`: every splitter is within half the tolerance (a share of one shard) of its exact place, or at the nearest row
    where a row is larger. Equal texts share a shard unless a splitter has to cut their group. slot counts from 0 in every shard, in
    the order of the keys. grown_shard is null under this law. Null and empty texts count 8 bytes; null ids are hashed like any
    value. Rows alike in text and id are told apart by the number they get when they are written, so they too are spread. With fewer rows than shards some shards are
    empty; an empty table gives an empty result. Columns of docs named like a result are replaced.

    Shards consist of ranges of about range_bytes, each sorted in one task, so no task grows with a shard. The driver holds one number
    per range, and broadcast are one place per range and 2**TOP_BITS bucket rows. The rows are written once with their keys, so that every
    round and the exchange see the same numbers, and move once, by `repartitionById`.
    """
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(quoted(text), F.lit("")).cast("binary"))
    hashes = {"text_hash": F.xxhash64(quoted(text)), "id_hash": F.xxhash64(quoted(key)), "size": size_of(quoted(text)), "crc": crc}
    numbered = docs.select(carried(docs).alias("row"), *[value.alias(name) for name, value in hashes.items()])
    rows = settle(numbered.withColumn("row_hash", F.xxhash64(F.monotonically_increasing_id())), "shard-rows")
    keys = rows.select(*PARTS, "size")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = max(1, -(-total // (shards * range_bytes)))
    cuts = shards * ranges
    places = splitters(keys, [total * i // cuts for i in range(1, cuts)], int(tolerance * total / shards / 2))
    cells = _cells(spark, sorted(places))

    rows_in = {row["cell"]: row["n"] for row in _placed(keys, cells).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    starts: list[tuple[int, int]] = []
    for cell in range(cuts):
        first = starts[-1][1] + rows_in.get(cell - 1, 0) if cell % ranges else 0
        starts.append((cell, first))
    offsets = spark.createDataFrame(starts, "first_cell int, first_slot long")

    moved = _placed(rows, cells).repartitionById(cuts, "cell").sortWithinPartitions(*PARTS)
    numbered = moved.withColumn("in_range", F.monotonically_increasing_id().bitwiseAND(ROW_IN_TASK))
    placed = numbered.join(F.broadcast(offsets), F.col("cell") == F.col("first_cell"))
    return unpacked(
        placed,
        "row",
        docs.columns,
        {
            "size": F.col("size"),
            "text_crc32": F.col("crc"),
            "law": F.lit(LAW),
            "shard": F.floor(F.col("cell") / ranges).cast("int"),
            "slot": F.col("first_slot") + F.col("in_range"),
            "grown_shard": F.lit(None).cast("int"),
        },
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file; rows are not moved again."""
    sharded.write.partitionBy("shard").parquet(path)
