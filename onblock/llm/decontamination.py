"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle similarity.

A window is as many words as an item has. Only windows that could reach the similarity are fingerprinted: they need a number of shingles
that occur in the benchmark, which a running count tells. Fingerprints are looked up by their bytes: within RADIUS bits over eight
bytes, some byte differs in at most RADIUS // 8 bits, and every item is entered under all such bytes, so no fingerprint within the radius is
missed. What is found within the radius is verified on the shingles themselves, weighted by how often they occur.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onblock.llm.tables import quoted, ship

SHINGLE = 5
SIMILAR = 0.8
RADIUS = 23
WORDS = re.compile(r"\w+")
SEGMENT = 50_000
MOST_BYTES = 256 << 20
FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("start_word", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("differing_bits", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    ),
    False,
)

ship(__name__)


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode(), 1)


def shingles(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of word runs; columns[i] holds the hash of the i-th word of every run."""
    total = np.zeros_like(columns[0])
    with np.errstate(over="ignore"):
        for column in columns:
            total = (total ^ column) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        total = (total ^ np.uint64(len(columns))) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def runs(words: np.ndarray, length: int) -> list[np.ndarray]:
    """The columns of all runs of so many words."""
    return [words[i : max(len(words) - length + 1 + i, i)] for i in range(length)]


def running_bits(hashes: np.ndarray) -> np.ndarray:
    """Row i: for each of 64 bits, set minus unset in the first i hashes."""
    bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).astype(np.int32) * 2 - 1
    return np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Eight bytes for each row of 64 sums."""
    return np.packbits(sums > 0, axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard: each shingle weighs as often as it occurs."""
    left, right = Counter(a.tolist()), Counter(b.tolist())
    both = sum(min(n, right[s]) for s, n in left.items())
    return both / max(len(a) + len(b) - both, 1)


class Index:
    """Items by their number of words; per number, byte tables that name the items near a fingerprint.

    Items with fewer words than a shingle are one shingle of their own length, so `known` holds the benchmark's shingles by length.
    """

    def __init__(self, items: list[tuple[int, str]]):
        near = [[x for x in range(256) if (x ^ byte).bit_count() <= RADIUS // 8] for byte in range(256)]
        self.codes: dict[str, int] = {}
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, text in items:
            words = WORDS.findall(text.lower())
            if words:
                self.codes.update((w, word_hash(w)) for w in words)
                own = shingles(runs(np.array([self.codes[w] for w in words], np.uint64), min(SHINGLE, len(words))))
                by_size.setdefault(len(words), []).append((item, own))
        lengths = {min(SHINGLE, size) for size in by_size}
        self.known = {
            k: np.unique(np.concatenate([own for size, group in by_size.items() if min(SHINGLE, size) == k for _, own in group])) for k in lengths
        }
        self.sizes: list[tuple[int, list[tuple[int, np.ndarray]], np.ndarray, np.ndarray]] = []
        for size, group in sorted(by_size.items()):
            prints = fingerprints(np.array([running_bits(s)[-1] for _, s in group]))
            table = np.zeros((8, 256, len(group)), np.bool_)
            for i, own in enumerate(prints):
                for block, byte in enumerate(own):
                    table[block, near[byte], i] = True
            self.sizes.append((size, group, prints, table))

    def matches(self, text: str) -> list[dict]:
        """The best window of every item found in the text."""
        words = WORDS.findall(text.lower())
        known = np.fromiter(map(self.codes.get, words, repeat(0)), np.uint64, len(words))
        if not any(self._shared(known, k).any() for k in self.known):
            return []
        code = self.codes.get
        hashed = np.array([code(w) or word_hash(w) for w in words], np.uint64)
        best: dict[int, dict] = {}
        overlap = max(size for size, *_ in self.sizes)
        for start in range(0, len(hashed), SEGMENT):
            for found in self._windows(hashed[start : start + SEGMENT + overlap], start):
                old = best.get(found["item_id"])
                if old is None or (-found["similarity"], found["start_word"]) < (-old["similarity"], old["start_word"]):
                    best[found["item_id"]] = found
        return [best[item] for item in sorted(best)]

    def _shared(self, words: np.ndarray, length: int) -> np.ndarray:
        """Which runs of so many words occur in the benchmark; only runs of its words are hashed and looked up."""
        columns, known = runs(words, length), self.known[length]
        shared = columns[0] != 0
        for column in columns[1:]:
            shared &= column != 0
        at = np.flatnonzero(shared)
        if len(at):
            own = shingles([column[at] for column in columns])
            shared[at] = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
        return shared

    def _windows(self, words: np.ndarray, offset: int) -> Iterator[dict]:
        by_length = {}
        for k in self.known:
            own = shingles(runs(words, k))
            by_length[k] = own, np.concatenate([[0], np.cumsum(self._shared(words, k))]), running_bits(own)
        for size, group, prints, table in self.sizes:
            k, n = min(SHINGLE, size), min(size, len(words))
            own, shared, sums = by_length[k]
            width, full = n - k + 1, size - k + 1
            if width < 1:
                continue
            need = SIMILAR * (width + full) / (1 + SIMILAR)
            starts = np.flatnonzero(shared[width:] - shared[:-width] >= need - 1e-9)
            if not len(starts):
                continue
            made = fingerprints(sums[starts + width] - sums[starts])
            near = table[0, made[:, 0]]
            for block in range(1, 8):
                near = near | table[block, made[:, block]]
            for w, i in zip(*np.nonzero(near), strict=True):
                differ = int(np.bitwise_count(made[w] ^ prints[i]).sum())
                if differ <= RADIUS:
                    at = int(starts[w])
                    alike = similarity(own[at : at + width], group[i][1])
                    if alike >= SIMILAR:
                        yield {
                            "item_id": group[i][0],
                            "start_word": offset + at,
                            "n_words": n,
                            "differing_bits": differ,
                            "similarity": alike,
                        }


def leaks(text: Column, benchmark: DataFrame, item_text: str = "text", item_id: str = "item_id") -> Column:
    """The benchmark items found in a whole text: item_id, first word and length of the best window, differing bits, similarity.

    Words are runs of letters, digits and underscores in lower case. Items with nulls or without words match nothing, items of fewer words
    than a shingle match where their whole sequence occurs; documents shorter than an item are compared as a whole. Null
    and empty texts have no matches. Several items with one id count as that item.

    The benchmark travels with the tasks, so it is measured first; one above MOST_BYTES has to be given in parts.
    """
    items = benchmark.select(quoted(item_id).cast("long").alias("i"), quoted(item_text).alias("t")).filter("i is not null and t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"the benchmark has {size} bytes; pass it in parts of at most {MOST_BYTES}")
    index = Index([tuple(row) for row in items.collect()])

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("differing_bits", pa.int64()), ("similarity", pa.float64())]))
        for texts in batches:
            yield pa.array([index.matches(t) for t in texts.to_pylist()], kind)

    return found(F.coalesce(text, F.lit("")))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for every document and benchmark item found in it."""
    found = docs.select(quoted(key).alias("doc_id"), F.explode(leaks(quoted(text), benchmark)).alias("found"))
    return found.select("doc_id", "found.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no benchmark item is found; rows and columns stay as they are."""
    return docs.filter(F.size(leaks(quoted(text), benchmark)) == 0)
