"""Quality classifier: document statistics, random Fourier features, ridge by summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onblock.llm.labelled import fold, labelled_sample
from onblock.llm.tables import settle, ship

FIT_ROWS = 200_000
FEATURES = 256
BANDWIDTH = 3.0
RIDGE = 1e-3
STEPS = 1000
SLOPE = 0.02
SEED = 7
UPPER, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
SYMBOLS = b"#*$%&|<>{}[]\\^~=@_"
MARKS = b"!?"
STOPS = b".,;:"

ship(__name__)


def statistics(text: str) -> list[float]:
    """What the classifier sees of a whole text: sizes, shares of kinds of characters, and how much of it repeats."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), max(len(raw), 1)
    share = lambda kind: (len(raw) - len(raw.translate(None, kind))) / size
    letters = share(LETTERS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    distinct, pairs = len(set(words)), len(set(zip(words, words[1:], strict=False)))
    return [
        log1p(n),
        log1p(len(raw) / max(n, 1)),
        letters,
        share(UPPER) / max(letters, 1e-9),
        share(DIGITS),
        share(SYMBOLS),
        share(MARKS),
        share(STOPS),
        log1p(distinct) / max(log1p(n), 1e-9),
        pairs / max(n - 1, 1),
        sum(map(eq, words, words[1:])) / max(n - 1, 1),
        1 - len(set(lines)) / max(len(lines), 1),
        log1p(n / max(len(lines), 1)),
        raw.count(b"|") / max(n, 1),
    ]


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t) for t in texts.to_pylist()], np.float64).reshape(len(texts), -1)


@F.arrow_udf(T.ArrayType(T.DoubleType(), False))
def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = _matrix(texts)
        ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32) if len(rows) else np.zeros(1, np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


@dataclass(frozen=True)
class Model:
    """Standardised statistics -> cosines of random projections -> ridge score -> calibrated score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def cosines(self, rows: np.ndarray) -> np.ndarray:
        made = np.random.default_rng(SEED)
        directions = made.normal(0, 1 / BANDWIDTH, (len(self.mean), FEATURES))
        shift = made.uniform(0, 2 * np.pi, FEATURES)
        standard = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(standard @ directions + shift), np.ones((len(rows), 1))])

    def ridge(self, rows: np.ndarray) -> np.ndarray:
        return self.cosines(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        ridge = self.ridge(rows)
        return (1 - SLOPE) * np.interp(ridge, self.knots, self.levels) + SLOPE * np.clip(ridge, 0, 1)


def _rows(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y: each partition sums its own, Spark sums over partitions entry by entry."""
    width, side = len(model.mean), FEATURES + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side + 1))
        for batch in batches:
            z = model.cosines(_rows(batch.column("x"), width))
            y = batch.column("label").to_numpy().astype(np.float64)
            total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["entry", "value"])

    parts = train.select("x", "label").mapInArrow(summed, "entry long, value double")
    total = np.zeros(side * (side + 1))
    for entry, value in parts.groupBy("entry").agg(F.sum("value")).collect():
        total[entry] = value
    total = total.reshape(side, side + 1)
    return total[:, :side], total[:, side]


def isotonic(x: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the best non-decreasing fit, by pooling neighbours that fall; x has to be sorted."""
    blocks: list[list[float]] = []
    for at, level, w in zip(x, mean, weight, strict=True):
        blocks.append([at * w, level * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([a / w for a, _, w in blocks]), np.array([b / w for _, b, w in blocks])


def fit(sample: DataFrame) -> Model | None:
    """Fits to rows with key, text and label (0 or 1); a fifth of them, by a hash of the key, only calibrates. None without both labels.

    The driver gets sums: two numbers per statistic, (FEATURES + 1) * (FEATURES + 2) entries, and counts in STEPS bins of the score.
    """
    rows = settle(sample.select("label", _statistics("text").alias("x"), (F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(5)) == 0).alias("later")), "quality-rows")
    classes = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    if len(classes) < 2:
        return None
    width = len(statistics(""))
    x = [F.get("x", F.lit(i)) for i in range(width)]
    moments = rows.agg(*[f for c in x for f in (F.avg(c), F.stddev_pop(c))]).first()
    scale = np.array([s if s > 1e-9 else 1.0 for s in moments[1::2]])
    blank = Model(np.array(moments[::2]), scale, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    square, right = _normal_equations(rows.filter("not later"), blank)
    penalty = RIDGE * max(square[-1, -1], 1.0) * np.eye(FEATURES + 1) / FEATURES
    ridge = Model(blank.mean, scale, np.linalg.solve(square + penalty, right), blank.knots, blank.levels)

    @F.arrow_udf(T.DoubleType())
    def scored(lists: pa.Array) -> pa.Array:
        return pa.array(ridge.ridge(_rows(lists, width)))

    later = rows.filter("later") if rows.filter("later").limit(50).count() == 50 else rows
    bins = later.select("label", F.round(scored("x") * STEPS).alias("bin")).groupBy("bin").agg(F.avg("label"), F.count("*")).orderBy("bin").collect()
    at, mean, weight = (np.array(column, np.float64) for column in zip(*bins, strict=True))
    knots, levels = isotonic(at / STEPS, mean, weight)
    return Model(blank.mean, scale, ridge.weights, knots, levels)


def score(text: Column, model: Model | None) -> Column:
    """Quality between 0 and 1 of whole texts; null counts as empty. Without a model every score is one half."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf(T.DoubleType())
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.score(_matrix(texts)))

    return scores(F.coalesce(text, F.lit("")))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2, rows: int = FIT_ROWS) -> Model | None:
    """A model from the labels outside the held-out fold of keys, fitted to at most about `rows` of them."""
    return fit(labelled_sample(docs, labels, label, fold(F.col("doc_id"), folds) != held_out, rows))
