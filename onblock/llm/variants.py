"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols. Every word generates the full one-edit neighbourhood of its reduced form (itself, all deletions,
replacements and insertions over the symbols), which meets the reduced forms of the vocabulary in an equi-join. Words that meet are
verified on their letters. A reduced word travels as its hash, so a neighbour costs eight bytes whatever its length: a collision, like
a clash of letters in one symbol, only adds a pair that the verification drops. Neighbours that no word has are dropped where they are
made, by a bit map of the vocabulary's hashes that has FILTER_BITS bits whatever the vocabulary; the more bits are set, the more it lets by.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onblock.llm.tables import quoted, settle, ship

# The letters of a word, and how many code points and occurrences make it count.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
SYMBOLS = 8
WORDS_HELD = 200_000
CHARACTERS_AT_ONCE = 1 << 22
CELLS_AT_ONCE = 1 << 16
FILTER_BITS = 1 << 26
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
VALUES = np.array([(0xD1B54A32D192ED03 * (2 * i + 1)) % (1 << 64) for i in range(256)], np.uint64)

ship(__name__)


def runs_in(text: str) -> Iterator[list[str]]:
    """Lower-cased (A-Z only) runs of letters, list by list; a long text is cut where a letter is not followed by one."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    find, gap = re.compile(RUN).findall, re.compile("[^A-Za-zÀ-ÿ]")
    start = 0
    while len(text) - start > CHARACTERS_AT_ONCE and (found := gap.search(text, start + CHARACTERS_AT_ONCE)):
        yield find(text, start, found.start())
        start = found.start()
    yield find(text, start)


def misspelt(run: str, salt: int, noise: int) -> str:
    """The run without one code point if noise divides its checksum, else the run."""
    h = zlib.crc32(run.encode(), salt)
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, text: str, key: str, noise: int | None, least: int) -> DataFrame:
    """(word, n) with partial counts: at most WORDS_HELD words and those of one text are held in a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def held() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])
            words.clear()
            return out

        words: Counter[str] = Counter()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                salt = zlib.crc32(f"{name}:".encode())
                for runs in runs_in(value):
                    for run, n in Counter(runs).items():
                        word = misspelt(run, salt, noise) if noise else run
                        if len(word) >= least:
                            words[word] += n
                if len(words) >= WORDS_HELD:
                    yield held()
        yield held()

    rows = docs.select(F.coalesce(quoted(key).cast("string"), F.lit("")).alias("name"), quoted(text).alias("value"))
    return rows.filter("value is not null").mapInArrow(count, "word string, n long")


def _symbols(words: list[str], length: int) -> np.ndarray:
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)
    return points % SYMBOLS


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[str], int]]:
    """Ids and words of one length, a bounded number of letters at a time."""
    ids, words = batch.column(0).to_numpy(), batch.column(1).to_pylist()
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for same in np.split(order, cuts):
        if len(same):
            length = int(lengths[same[0]])
            step = max(1, CELLS_AT_ONCE // max(length, 1))
            for at in range(0, len(same), step):
                some = same[at : at + step]
                yield ids[some], [words[i] for i in some], length


def reduced_keys(words: list[str], length: int) -> np.ndarray:
    """Hashes of the reduced words: the sum of symbol values times powers of the base, modulo 2**64."""
    return (VALUES[_symbols(words, length)] * _powers(BASE, length)).sum(axis=1, dtype=np.uint64)


def neighbour_keys(words: list[str], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the word, hash) of every reduced word within one edit of the reduced word, each once, in slices of bounded size."""
    symbols = _symbols(words, length)
    power = _powers(BASE, length + 1)
    terms = VALUES[symbols] * power[:length]
    before = np.zeros((len(words), length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    whole = before[:, length]
    every = np.arange(len(words))
    yield every, whole
    for start in range(0, length + 1, CELLS_AT_ONCE):
        at = np.arange(start, min(length + 1, start + CELLS_AT_ONCE))
        inner = at[at < length]
        # A deletion or insertion in a run of equal symbols counts at the start of the run only.
        same = np.zeros((len(words), len(at)), bool)
        later = at > 0
        same[:, at[later] - start] = symbols[:, at[later] - 1] == symbols[:, np.minimum(at[later], length - 1)] if length else False
        word, i = np.nonzero(~same[:, : len(inner)])
        i = inner[i]
        yield word, before[word, i] + (whole[word] - before[word, i + 1]) * np.uint64(INVERSE)
        for symbol in range(SYMBOLS):
            value = VALUES[symbol]
            word, i = np.nonzero(symbols[:, inner] != symbol)
            i = inner[i]
            yield word, whole[word] - terms[word, i] + value * power[i]
            left = np.full((len(words), len(at)), SYMBOLS, symbols.dtype)
            left[:, later] = symbols[:, at[later] - 1]
            word, i = np.nonzero(left != symbol)
            i = at[i]
            yield word, before[word, i] + value * power[i] + (whole[word] - before[word, i]) * np.uint64(BASE)


def _keyed(ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids)], ["key", "id"])


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, words, length in _by_length(batch):
            yield _keyed(ids, reduced_keys(words, length))


def _bits_of(own: DataFrame) -> np.ndarray:
    """A map with the bit of every key set; it is put together on the executors and has FILTER_BITS / 64 numbers at most."""
    cell = F.shiftright("key", 6).bitwiseAND(F.lit(FILTER_BITS // 64 - 1))
    bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
    cells = own.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return bits


def _neighbours(bits: np.ndarray):
    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, words, length in _by_length(batch):
                for word, keys in neighbour_keys(words, length):
                    cell = (keys >> np.uint64(6)) & np.uint64(len(bits) - 1)
                    known = (bits[cell.astype(np.int64)] >> (keys & np.uint64(63))) & np.uint64(1) == 1
                    yield _keyed(ids[word[known]], keys[known])

    return generate


def near_words(words: DataFrame) -> DataFrame:
    """(id, other_id): all ordered pairs of words exactly one insertion, deletion or replacement apart.

    words: id long and word string, both distinct, settled or cheap. No key is hot: a reduced word is one key of a word, and copies
    were counted before.
    """
    spread = words.select("id", "word").repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = words.select("id", "word").mapInArrow(_own, "key long, id long").withColumnRenamed("id", "other_id")
    generated = spread.mapInArrow(_neighbours(_bits_of(own)), "key long, id long")
    met = generated.join(own.hint("shuffle_merge"), "key").filter("id <> other_id").select("id", "other_id")
    left = words.select("id", F.col("word").alias("a"))
    right = words.select(F.col("id").alias("other_id"), F.col("word").alias("b"))
    verified = met.join(left, "id").join(right, "other_id").filter(F.levenshtein("a", "b", 1) == 1)
    return verified.select("id", "other_id").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) of the words with a form (id, up): pointers are doubled until none moves, in as many rounds as the log of the longest chain."""
    at = settle(forms.select("id", "up"), "roots")
    while True:
        further = at.select(F.col("id").alias("up"), F.col("up").alias("top"))
        moved = settle(at.join(further, "up", "left").select("id", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "roots")
        at = moved.select("id", "up")
        if moved.filter("moved").isEmpty():
            return at.withColumnRenamed("up", "root_id")


def spelling_variants(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    noise: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word with least_length code points and least_count occurrences in all texts.

    Words are runs of Latin letters, A-Z in lower case; with noise, one in so many (row, word) pairs loses a letter first, chosen by a
    checksum of key and word. form is the most frequent near word (ties: the smallest in code-point order) if it occurs at least
    twice as often, else null; root is the last word of the chain of forms, the word itself without one.

    Null texts have no words, a null key counts as empty, repeated rows count repeatedly, whole texts of any length are read. An empty
    table or one without such words gives no rows. Other columns of docs play no part.
    """
    total = counted(docs, text, key, noise, least_length).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
    words = settle(total.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = near_words(words)
    other = words.select(F.col("id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"), F.col("other_id"))).alias("best")
    near = settle(pairs.join(other, "other_id").groupBy("id").agg(F.count("*").alias("n_near"), best), "near")
    known = words.join(near, "id", "left")
    has_form = -F.col("best.less") >= 2 * F.col("n")
    known = known.select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.other")).alias("form"),
        F.when(has_form, F.col("best.other_id")).alias("up"),
        F.when(has_form, -F.col("best.less")).alias("form_n"),
    )
    known = settle(known, "variants")
    roots = _roots(known.filter("up is not null"))
    named = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    rooted = known.join(roots.join(named, "root_id").select("id", "root"), "id", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
