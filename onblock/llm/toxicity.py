"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier on its posteriors.

Voters that find something vote toxic, the rest of them abstain; one voter votes clean where no lexicon voter fires. The label model takes a
class prior, how often each voter fires in either class, and how far voters fire together beyond what the class explains; voters
that repeat one another share their weight. Expectation-maximisation fits it to the vote patterns. The classifier is a logistic
regression on the votes with the posteriors as labels.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onblock.llm.labelled import fold, labelled_sample
from onblock.llm.tables import settle, ship

FIT_ROWS = 60_000
STEMS = (4, 5, 6, 7, 8)
THIN = 80
MOST_CLEAN = 0.1
ROUNDS = 10
SURE = 3.3
LABEL_ACCURACY = 0.97
COUNTED_AT_ONCE = 500_000
BLOCK = 2_048
WORDS = re.compile(r"[^\W\d_]+")

# Words that insult in English, German, French and Spanish; learned words and stems come on top.
SEED_WORDS = (
    "idiot idiots moron morons stupid scum trash loser losers clown clowns worthless pathetic disgusting bastard asshole bitch imbecile retard "
    "arschloch dummkopf trottel abschaum drecksau connard salope imbécile ordure abruti estúpido imbécil basura pendejo cabrón"
).split()
PATTERNS = {
    "shouted": lambda text, words: len(text) > 20 and text.count("!") * 40 > len(text),
    "addressed": lambda text, words: not words.isdisjoint(("hate", "kill", "shut", "hasse", "déteste", "odio")),
}

ship(__name__)


def signs(text: str) -> set[str]:
    """The distinct words of a text in lower case, and their stems as `stem-`."""
    words = set(WORDS.findall(text.lower()))
    return words.union(*({f"{w[:n]}-" for w in words if len(w) > n} for n in STEMS))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (sign, toxic, clean) document counts, summed within the partition up to a bounded number of signs."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        keys = list(counts[0] | counts[1])
        columns = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in reversed(counts))]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=["sign", "toxic", "clean"])

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            counts[label].update(signs(text))
            if len(counts[0]) + len(counts[1]) > COUNTED_AT_ONCE:
                yield flush()
    yield flush()


def learn_lexicon(sample: DataFrame) -> list[str]:
    """All words and stems that mark toxic documents, best first.

    sample: text, label. Every sign of the sample is counted. A sign is kept if at least 3 and 1 in 500 toxic documents hold it, and its share of
    clean documents is at most MOST_CLEAN times that of the toxic ones and lower by SURE standard errors; a longer form of a kept stem is left out, and
    so is a stem that is found as often as a kept word that it begins.
    """
    totals = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    parts = sample.select("text", "label").mapInArrow(_counted, "sign string, toxic long, clean long")
    counts = parts.groupBy("sign").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = (F.col("clean") + 0.5) / F.lit(clean + 1.0) / ((F.col("toxic") + 0.5) / F.lit(toxic + 1.0))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    marking = (
        counts.filter(F.col("toxic") >= max(3, toxic // 500))
        .withColumn("share", share)
        .filter((F.col("share") <= MOST_CLEAN) & (-F.log("share") >= SURE * error))
    )
    kept: list[str] = []
    stems: set[str] = set()
    alike: dict[tuple[int, int], list[str]] = defaultdict(list)  # kept signs by their counts, in order
    for row in sorted(marking.collect(), key=lambda row: (-row["toxic"] * (1 - row["share"] / MOST_CLEAN), len(row["sign"]), row["sign"])):
        sign, same = row["sign"], alike[row["toxic"], row["clean"]]
        bare = sign.rstrip("-")
        at = bisect_left(same, bare)
        explained = any(f"{bare[:n]}-" in stems for n in STEMS) or (at < len(same) and same[at].startswith(bare))
        if not explained:
            kept.append(sign)
            insort(same, sign)
            if sign.endswith("-"):
                stems.add(sign)
    return kept


@dataclass(frozen=True)
class Voters:
    """The votes of a text: one for each lexicon entry, then for a seed word, for one, two and more than three entries, for few
    entries among many words, for none, and for each pattern."""

    lexicon: tuple[str, ...]

    @cached_property
    def places(self) -> dict[str, int]:
        return {sign: i for i, sign in enumerate(self.lexicon)}

    @cached_property
    def stem_lengths(self) -> list[int]:
        return sorted({len(sign) - 1 for sign in self.lexicon if sign.endswith("-")})

    def votes(self, text: str) -> bytes:
        words, at = set(WORDS.findall(text.lower())), self.places
        found = {at[w] for w in words & at.keys()}
        for n in self.stem_lengths:
            found |= {at[stem] for stem in {f"{w[:n]}-" for w in words if len(w) > n} & at.keys()}
        seeds = not words.isdisjoint(SEED_WORDS)
        few = bool(found) and len(words) > THIN * len(found)
        more = [seeds, len(found) == 1, len(found) == 2, len(found) > 3, few, not found and not seeds, *(rule(text, words) for rule in PATTERNS.values())]
        fired = np.zeros(self.width(), np.bool_)
        fired[list(found)] = True
        fired[len(self.lexicon) :] = more
        return np.packbits(fired).tobytes()

    def width(self) -> int:
        return len(self.lexicon) + 6 + len(PATTERNS)

    def matrix(self, votes: list[bytes]) -> np.ndarray:
        """A row of zeros and ones per vote pattern."""
        packed = np.frombuffer(b"".join(votes), np.uint8).reshape(len(votes), -1)
        return np.unpackbits(packed, axis=1, count=self.width())


@dataclass(frozen=True)
class Model:
    voters: Voters
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        votes = self.voters.matrix([self.voters.votes(t) for t in texts])
        return 1 / (1 + np.exp(-(_times(votes, self.weights) + self.bias)))


def _blocks(votes: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Some rows at a time as floats, as the whole would not fit for many voters."""
    for start in range(0, len(votes), BLOCK):
        rows = slice(start, start + BLOCK)
        yield rows, votes[rows].astype(np.float64)


def _times(votes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(block @ weights for _, block in _blocks(votes))])


def _crossed(votes: np.ndarray, weight: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Weighted products of all pairs of columns less their centres."""
    out = np.zeros((votes.shape[1], votes.shape[1]))
    for rows, block in _blocks(votes):
        block -= centre
        out += (block * weight[rows, None]).T @ block
    return out


def label_model(votes: np.ndarray, n: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Posterior of the toxic class for each vote pattern.

    votes: one row of zeros and ones per pattern; n: its documents; label: what they are labelled, one more voter of known accuracy,
    which starts the estimate. Firing rates of both classes and the prior are re-estimated from the posteriors; the weight of a voter is divided by
    its summed positive correlations, its own included, with all voters within the classes.
    """
    total = n.sum()
    labelled = np.where(label > 0, 1, -1) * np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
    posterior = np.where(label > 0, LABEL_ACCURACY, 1 - LABEL_ACCURACY)
    for _ in range(ROUNDS):
        prior = (n @ posterior) / total
        logs = []
        shared = np.ones(votes.shape[1])
        for weight in (n * posterior, n * (1 - posterior)):
            fired = sum((weight[rows] @ block for rows, block in _blocks(votes)), np.zeros(votes.shape[1]))
            rate = (fired + 0.5) / (weight.sum() + 1)
            together = _crossed(votes, weight, rate)
            spread = np.sqrt(np.maximum(np.diag(together), 1e-9))
            together /= np.outer(spread, spread)
            shared = np.maximum(shared, np.clip(together, 0, 1).sum(axis=1))
            logs.append((np.log(rate), np.log1p(-rate)))
        (fires1, silent1), (fires0, silent0) = logs
        silent = (silent1 - silent0) / shared
        evidence = _times(votes, (fires1 - fires0) / shared - silent) + silent.sum()
        odds = np.log(max(prior, 1e-9)) - np.log(max(1 - prior, 1e-9)) + evidence + labelled
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def linear_classifier(votes: np.ndarray, n: np.ndarray, posterior: np.ndarray, penalty: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on weighted patterns with soft labels, by Newton steps."""
    x = np.hstack([votes, np.ones((len(votes), 1), votes.dtype)])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(_times(x, w), -30, 30)))
        miss = n * (posterior - p)
        slope = sum((miss[rows] @ block for rows, block in _blocks(x)), np.zeros(len(w)))
        step = np.linalg.solve(_crossed(x, n * np.maximum(p * (1 - p), 1e-6), np.zeros(len(w))) + ridge, slope - ridge @ w)
        w = w + step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(sample: DataFrame) -> Model | None:
    """Learns lexicon, label model and classifier from rows with text and label; None without both labels.

    The sample is bounded, and so is what the driver gets from it: the signs that mark toxic documents, and one row per vote pattern of its documents.
    """
    rows = settle(sample.select("text", "label"), "toxic-rows")
    if len(rows.select("label").distinct().collect()) < 2:
        return None
    voters = Voters(tuple(learn_lexicon(rows)))

    @F.arrow_udf(T.BinaryType())
    def votes_of(texts: pa.Array) -> pa.Array:
        return pa.array([voters.votes(t) for t in texts.to_pylist()], pa.binary())

    patterns = rows.groupBy(votes_of("text").alias("votes"), "label").agg(F.count("*")).collect()
    packed, label, n = zip(*patterns, strict=True)
    votes, label, n = voters.matrix([bytes(p) for p in packed]), np.array(label, np.float64), np.array(n, np.float64)
    return Model(voters, *linear_classifier(votes, n, label_model(votes, n, label)))


def score(text: Column, model: Model | None) -> Column:
    """Toxicity between 0 and 1 of whole texts; null counts as empty. Without a model every score is 0.25."""
    if model is None:
        return F.lit(0.25)

    @F.arrow_udf(T.DoubleType())
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.scores(texts.to_pylist()))

    return scores(F.coalesce(text, F.lit("")))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0, rows: int = FIT_ROWS) -> Model | None:
    """A model from the labels outside the held-out fold of keys, fitted to at most about `rows` of them."""
    return fit(labelled_sample(docs, labels, label, fold(F.col("doc_id"), folds) != held_out, rows))
