"""Repeated byte strings by suffix arrays of two-stage sorting.

Every string of LENGTH bytes is dealt to the least hash among its GRAM-byte pieces, so equal strings meet under one key. Consecutive
strings with the same key travel as one stretch of text, and only stretches whose key occurs again are cut out at all. Hashes that
very many stretches hold come last in the order: a string is dealt to one of them only if it consists of nothing else.

A task puts whole keys together to blocks of text and sorts their suffixes in two stages: suffixes smaller than their successors
are sorted directly, the rest are induced from them by a scan over the buckets of first bytes. Neighbours with a common prefix of
LENGTH bytes are repeats. Order and prefixes are compared byte by byte, so hashes decide where strings meet and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.llm.tables import carried, quoted, settle, settle_by, ship, unpacked

LENGTH = 200
GRAM = 64
#: Strings in a stretch at most; more stretches than this under a key, or than a share of all, make its hash come last.
STRETCH, CROWD, CROWDS = 512, 1_000, 1_000_000
BYTES_AT_ONCE = 1 << 19
BLOCK = 1 << 20
WORD = 8
BASE = 0x9E3779B97F4A7C15
TABLE = np.array([(0xD1B54A32D192ED03 * (2 * b + 1) ^ (0x94D049BB133111EB * (b + 7))) % (1 << 64) for b in range(256)], np.uint64)
LAST = np.uint64(1 << 63)

ship(__name__)


def gram_hashes(text: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 63-bit hash of every gram (a power of two) of bytes."""
    h, reach = TABLE[text], 1
    while reach < gram:
        h = h[:-reach] * np.uint64(pow(BASE, reach, 1 << 64)) + h[reach:]
        reach *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h >> np.uint64(1)


def least_of(h: np.ndarray, window: int) -> np.ndarray:
    """The least of every window of neighbours."""
    reach = 1
    while reach * 2 <= window:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    return np.minimum(h[: len(h) - (window - reach)], h[window - reach :]) if window > reach else h


class Crowds:
    """Hashes that come last in the order."""

    def __init__(self, hashes: list[int]):
        self.hashes = np.sort(np.array(hashes, np.uint64))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def put_last(self, h: np.ndarray) -> np.ndarray:
        if len(self.hashes):
            maybe = np.flatnonzero(self.seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            h[maybe[self.hashes[at] == h[maybe]]] |= LAST
        return h


def stretches(ends: np.ndarray, text: np.ndarray, crowds: Crowds) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first, strings, key, again) of all stretches of the texts that end at `ends` of the joined bytes.

    again says whether the least hash occurs at two places of a stretch, without which no string can repeat in it.
    """
    starts = np.concatenate([[0], ends[:-1]])
    window = LENGTH - GRAM + 1
    at = 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + BYTES_AT_ONCE, side="right")))
        for low in range(int(starts[at]), max(int(ends[upto - 1]) - LENGTH + 1, int(starts[at])), BYTES_AT_ONCE if upto == at + 1 else 1 << 62):
            high = int(ends[upto - 1]) if upto > at + 1 else min(low + BYTES_AT_ONCE + LENGTH - 1, int(ends[at]))
            if high - low < LENGTH:
                continue
            h = crowds.put_last(gram_hashes(text[low:high]))
            least = least_of(h, window)
            inside = np.ones(len(least), bool)
            if upto > at + 1:
                for end in (ends[at : upto - 1] - low).tolist():
                    inside[max(end - LENGTH + 1, 0) : end] = False
            first = np.flatnonzero(inside & np.concatenate([[True], (least[1:] != least[:-1]) | ~inside[:-1]]))
            if not len(first):
                continue
            stop = np.append(first[1:], len(least))
            gaps = np.concatenate([[0], np.cumsum(~inside)])
            stop = stop - (gaps[stop] - gaps[first])
            pieces = -(-(stop - first) // STRETCH)
            if pieces.max() > 1:
                number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                limit = np.repeat(stop, pieces)
                first = np.repeat(first, pieces) + number * STRETCH
                stop = np.minimum(first + STRETCH, limit)
            key = least[first]
            views = np.lib.stride_tricks.sliding_window_view(h, window)
            leftmost = first + np.argmax(views[first] == key[:, None], axis=1)
            rightmost = stop - 1 + window - 1 - np.argmax(views[stop - 1][:, ::-1] == key[:, None], axis=1)
            owner = np.searchsorted(ends, first + low, side="right")
            yield owner, first + low - starts[owner], stop - first, key, leftmost != rightmost
        at = upto


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends and joined bytes of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    joined = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return offsets[1:] - offsets[0], joined


def _least_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = Crowds([])
    for batch in batches:
        ends, joined = _bytes_of(batch.column(0))
        for _, _, _, key, _ in stretches(ends, joined, none):
            hashes, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["key", "n"])


def crowded(texts: DataFrame) -> list[int]:
    """Hashes under which more stretches than CROWD, and than a CROWDS-th of all, would meet: at most CROWDS of them."""
    counts = texts.select("bytes").mapInArrow(_least_hashes, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = counts.filter(F.col("n") > 1)
    counts = settle(counts, "hash-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [row["key"] for row in counts.filter(F.col("n") > max(CROWD, total // CROWDS)).select("key").collect()]


def _dealt(hashes: list[int]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowds = Crowds(hashes)
        for batch in batches:
            ends, joined = _bytes_of(batch.column(1))
            for owner, first, strings, key, again in stretches(ends, joined, crowds):
                columns = [key.view(np.int64), first.astype(np.int64), strings.astype(np.int32), again]
                arrays = [batch.column(0).take(pa.array(owner)), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "key", "first", "strings", "again"])

    return deal


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """For every suffix whether it is smaller than the one that starts a byte later; the last one is not."""
    rises = np.zeros(len(text), np.int8)
    rises[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    rises[-1:] = -1
    decided = np.flatnonzero(rises)
    return rises[decided[np.searchsorted(decided, np.arange(len(text)))]] > 0


def sorted_suffixes(block: bytes, wanted: np.ndarray) -> np.ndarray:
    """The wanted suffixes (a mask of starts) in the order of their first LENGTH bytes, by two-stage sorting."""
    text = np.frombuffer(block, np.uint8)
    n = len(text)
    small = smaller_than_successor(text)
    # The others are induced from the next small suffix, so everything up to it is needed.
    needed = wanted.copy()
    stops = np.append(np.flatnonzero(small), n)
    edges = np.flatnonzero(wanted & ~np.append(wanted[1:], False) & ~small)
    for start, stop in zip(edges.tolist(), stops[np.searchsorted(stops, edges)].tolist(), strict=True):
        needed[start : stop + 1] = True
    direct = np.flatnonzero(needed & small).tolist()
    direct.sort(key=lambda p: block[p : p + LENGTH])
    direct = np.array(direct, np.int64)
    heads = np.searchsorted(np.sort(text[direct]), np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(scanned: np.ndarray) -> None:
        """Puts the predecessors of scanned suffixes that are induced from them into their buckets, in scanning order."""
        before = scanned[scanned > 0] - 1
        before = before[needed[before] & ~small[before]]
        first = text[before]
        order = np.argsort(first, kind="stable")
        bounds = np.searchsorted(first[order], np.arange(257))
        for byte in np.flatnonzero(np.diff(bounds)).tolist():
            waiting[byte].append(before[order[bounds[byte] : bounds[byte + 1]]])

    if n and needed[n - 1] and not small[n - 1]:
        induce(np.array([n]))
    done = []
    for byte in range(256):
        while waiting[byte]:  # equal bytes in a row come back to their own bucket
            wave = np.concatenate(waiting[byte])
            waiting[byte] = []
            done.append(wave)
            induce(wave)
        mine = direct[heads[byte] : heads[byte + 1]]
        if len(mine):
            done.append(mine)
            induce(mine)
    found = np.concatenate(done) if done else np.empty(0, np.int64)
    return found[wanted[found]]


def common_words(block: bytes, order: np.ndarray) -> np.ndarray:
    """How many words of eight bytes neighbours of the order share at their starts, up to LENGTH bytes."""
    padded = block + bytes(LENGTH + WORD)
    words = np.ndarray((len(block) + LENGTH + 1,), "<u8", buffer=padded, strides=(1,))
    left, right = order[:-1], order[1:]
    shared = np.zeros(len(left), np.int32)
    alive = np.arange(len(left))
    for i in range(0, LENGTH, WORD):
        alive = alive[words[left[alive] + i] == words[right[alive] + i]]
        shared[alive] += 1
    return shared


def repeated_strings(pieces: list[bytes]) -> list[np.ndarray]:
    """For each piece a mask of its LENGTH-byte strings that also start elsewhere in the pieces."""
    block = b"".join(pieces)
    wanted = np.zeros(len(block), bool)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        wanted[start : max(start, stop - LENGTH + 1)] = True
    order = sorted_suffixes(block, wanted)
    equal = common_words(block, order) == LENGTH // WORD
    found = np.zeros(len(block), bool)
    found[order[:-1][equal]] = True
    found[order[1:][equal]] = True
    return [found[a : max(a, b - LENGTH + 1)] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def _marked(digests: list[bytes], copies: list[int], pieces: list[bytes]) -> pa.RecordBatch:
    rows, firsts, lasts = [], [], []
    for digest, n, mask in zip(digests, copies, repeated_strings(pieces), strict=True):
        if n > 1:
            mask = np.ones(len(mask), bool)
        turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        if len(turns):
            rows.append(digest)
            firsts.append(turns[::2])
            lasts.append(turns[1::2])
    int_lists = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(firsts, int_lists), pa.array(lasts, int_lists)], ["digest", "firsts", "lasts"])


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole keys from rows sorted by key."""
    held: tuple[list, list, list] = ([], [], [])
    size, last = 0, None
    for batch in batches:
        for key, digest, copies, piece in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if size >= BLOCK and key != last:
                yield _marked(*held)
                held, size = ([], [], []), 0
            for values, value in zip(held, (digest, copies, piece), strict=True):
                values.append(value)
            size, last = size + len(piece), key
    yield _marked(*held)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the marks of a text to spans of bytes and cuts them out."""
    names = ["digest", "n_removed", "n_spans", "spans", "kept"]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = [pa.string(), pa.int64(), pa.int64(), pa.list_(span), pa.binary()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for digest, text, marks in zip(*(batch.column(i) for i in range(3)), strict=True):
            digest, text = digest.as_py(), text.as_buffer().to_pybytes()
            values = marks.values
            first, last = (values.field(i).to_numpy() for i in range(2))
            order = np.argsort(first, kind="stable")
            first, last = first[order], np.maximum.accumulate(last[order] + LENGTH - 1)
            new = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1]]))
            first, last = first[new], last[np.append(new[1:], len(last)) - 1]
            keep = zip(np.concatenate([[0], last]).tolist(), np.append(first, len(text)).tolist(), strict=True)
            spans = [{"start": a, "end": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            for values, value in zip(out, (digest, int((last - first).sum()), len(first), spans, b"".join(text[a:b] for a, b in keep)), strict=True):
                values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names)


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def repeats(texts: DataFrame) -> DataFrame:
    """digest, n_removed, n_spans, spans, kept (binary) of every distinct text in column text that loses bytes.

    A text that occurs twice and has LENGTH bytes loses all of them. Every table between the steps is written to the shared folder.
    """
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    long = texts.select(F.unhex(F.md5(whole)).alias("id"), whole.alias("bytes")).filter(F.octet_length("bytes") >= LENGTH)
    distinct = settle_by(long.groupBy("id").agg(F.count("*").alias("copies"), F.first("bytes").alias("bytes")), "distinct-texts", "id")

    schema = "id binary, key long, first long, strings int, again boolean"
    dealt = settle(distinct.select("id", "bytes").mapInArrow(_dealt(crowded(distinct)), schema), "stretches")
    met = dealt.groupBy("key").agg(F.count("*").alias("n"), F.max("again").alias("again")).filter("n > 1 or again").select("key")
    shared = dealt.drop("again").join(met, "key").groupBy("id").agg(F.collect_list(F.struct("key", "first", "strings")).alias("stretches"))
    cut = distinct.select("id", "bytes").join(shared, "id").select("id", "bytes", F.explode("stretches").alias("s"))
    piece = F.expr(f"substring(bytes, cast(s.first as int) + 1, s.strings + {LENGTH - 1})")
    pieces = cut.select("id", "s.key", "s.first", piece.alias("piece")).withColumn("digest", F.unhex(F.md5("piece")))
    pieces = settle(pieces, "pieces")

    one = pieces.groupBy("key", "digest").agg(F.count("*").alias("copies"), F.first("piece").alias("piece"))
    sorted_rows = one.select("key", "digest", "copies", "piece").repartition("key").sortWithinPartitions("key")
    marks = settle(sorted_rows.mapInArrow(_sorted_blocks, "digest binary, firsts array<int>, lasts array<int>"), "marks")
    found = pieces.select("id", "first", "digest").join(marks, "digest")
    placed = F.transform(F.arrays_zip("firsts", "lasts"), lambda m: F.struct((F.col("first") + m["firsts"]).alias("a"), (F.col("first") + m["lasts"]).alias("b")))
    spans = found.select("id", placed.alias("marks")).groupBy("id").agg(F.flatten(F.collect_list("marks")).alias("marks"))

    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.octet_length("bytes") - (LENGTH - 1)).cast("long").alias("b")))
    losing = distinct.join(spans, "id", "left").filter("copies > 1 or marks is not null")
    losing = losing.select(F.sha2("bytes", 256).alias("digest"), "bytes", F.when(F.col("copies") > 1, all_of_it).otherwise(F.col("marks")).alias("marks"))
    return settle(losing.mapInArrow(_removed, "digest string, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary"), "repeats")


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_bytes, n_removed, n_spans, spans (byte offsets, end exclusive) and kept (binary, what is left of the UTF-8 bytes).

    A byte goes if a string of LENGTH bytes over it starts a second time anywhere in the column, in the same text included. Null texts
    count as empty; texts shorter than LENGTH lose nothing; repeated rows are repeats of each other; an empty table stays empty.
    Columns of docs named like a result are replaced. Memory is bounded by a batch of texts and, while sorting, by the stretches
    under one key, which CROWD bounds unless strings consist of crowded hashes only.
    """
    bare = docs.select(quoted(text).alias("text"))
    found = repeats(bare)
    rows = docs.select(carried(docs).alias("row"), F.coalesce(quoted(text), F.lit("")).cast("binary").alias("own"), text_digest(quoted(text)).alias("digest"))
    joined = rows.join(found, "digest", "left")
    results = {
        "n_bytes": F.octet_length("own").cast("long"),
        "n_removed": F.coalesce("n_removed", F.lit(0)).cast("long"),
        "n_spans": F.coalesce("n_spans", F.lit(0)).cast("long"),
        "spans": F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")),
        "kept": F.coalesce("kept", "own"),
    }
    return unpacked(joined, "row", docs.columns, results)


def repeat_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The key, n_bytes, n_removed, n_spans and kept_sha256 of `without_repeats`, without moving the texts a second time."""
    found = repeats(docs.select(quoted(text).alias("text")))
    short = found.select("digest", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    rows = docs.select(quoted(key).alias("key"), F.octet_length(F.coalesce(quoted(text), F.lit(""))).cast("long").alias("n_bytes"), text_digest(quoted(text)).alias("digest"))
    joined = rows.join(short, "digest", "left")
    zero = F.lit(0).cast("long")
    results = [F.coalesce(n, zero).alias(n) for n in ("n_removed", "n_spans")]
    return joined.select(F.col("key").alias(key), "n_bytes", *results, F.coalesce("kept_sha256", "digest").alias("kept_sha256"))
