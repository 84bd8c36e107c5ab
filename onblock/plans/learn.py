"""Training: the majority baseline, the logistic model, two boosted classifiers and two median regressors."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from onblock.operators.boosting import ABSOLUTE, LOGISTIC, Boosted, Task, fit_boosted
from onblock.operators.encode import SettledEncoding, fit_settled_encoding
from onblock.operators.metrics import binary_metrics
from onblock.plans.frames import (
    BOOKING_NUMBERS,
    CATEGORIES,
    DAYOF_EXTRA,
    DAYOF_NUMBERS,
    LABEL,
    MINUTE_CATEGORIES,
    MINUTES,
    ONE_HOT,
    majority_baseline,
)
from onblock.runtime import at_once, cut_lineage

ROUNDS, STEP = 300, 0.1
# The groups of features added one after another in the ablation.
ABLATION = {"booking": [], "previous leg": DAYOF_EXTRA[:1], "congestion and turnaround": DAYOF_EXTRA[1:3], "network state": DAYOF_EXTRA[3:]}


@dataclass
class DelayModel:
    """Target encoding, further features and learner of one model; `transform` adds the score column.

    `seconds` is how long the fit took that made it, with all models that grew side by side; it is not saved.
    """

    encoding: SettledEncoding
    numbers: list[str]
    learner: Boosted
    seconds: float | None = field(default=None, compare=False)

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        encoded = self.encoding.transform(df, "_e_")
        return self.learner.transform(encoded, output, _features(self.encoding.columns, self.numbers)).select(*df.columns, output)

    def save(self, path: str) -> None:
        encoding = self.encoding
        encoding.plain.write.mode("overwrite").parquet(f"{path}/encoding")
        meta = [(encoding.columns, self.numbers, encoding.mean, encoding.folds)]
        SparkSession.active().createDataFrame(
            meta, "categories array<string>, numbers array<string>, mean double, folds int"
        ).write.mode("overwrite").json(f"{path}/meta")
        self.learner.save(f"{path}/learner")

    @staticmethod
    def load(path: str) -> DelayModel:
        spark = SparkSession.active()
        meta = spark.read.json(f"{path}/meta").first()
        plain = spark.read.parquet(f"{path}/encoding")
        encoding = SettledEncoding.of(list(meta["categories"]), plain, None, meta["mean"], meta["folds"])
        return DelayModel(encoding, list(meta["numbers"]), Boosted.load(f"{path}/learner"))


@dataclass
class Models:
    """The four models a scoring job needs."""

    booking: DelayModel
    booking_minutes: DelayModel
    dayof: DelayModel
    dayof_minutes: DelayModel


MODELS = [f.name for f in fields(Models)]


@dataclass(frozen=True)
class Wanted:
    """A model to fit: its training rows, categories, further features by model name, and target."""

    train: DataFrame
    categories: list[str]
    numbers: dict[str, list[str]]
    label: str
    loss: str


def _features(categories: list[str], numbers: list[str]) -> list[str]:
    return [f"{c}_e_" for c in categories] + numbers


def fit_side_by_side(wanted: list[Wanted], key: str, rounds: int = ROUNDS, step: float = STEP) -> dict[str, DelayModel]:
    """Encodes each set of training rows once, all sets at the same time, and grows all models in the same passes."""
    kept, begun = [], time.monotonic()

    def encode(w: Wanted) -> tuple[SettledEncoding, tuple[DataFrame, list[Task]]]:
        numbers = list(dict.fromkeys(n for names in w.numbers.values() for n in names))
        # Both the encoding and the encoded rows read the training frame, with its windows and joins behind it.
        train = w.train.select(*dict.fromkeys([key, *w.categories, *numbers, w.label])).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(train)
        encoding = fit_settled_encoding(train, w.categories, w.label, key)
        rows = encoding.transform_training(train, key, "_e_").select(*_features(w.categories, numbers), w.label)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(rows)
        return encoding, (rows, [Task(w.loss, w.label, _features(w.categories, names)) for names in w.numbers.values()])

    try:
        made, sets = zip(*at_once(wanted[0].train.sparkSession, encode, wanted))
        grown = fit_boosted(list(sets), rounds, step)
    finally:
        for frame in kept:
            frame.unpersist()
    seconds = time.monotonic() - begun
    return {
        name: DelayModel(encoding, names, learner, seconds)
        for w, encoding, learners in zip(wanted, made, grown, strict=True)
        for (name, names), learner in zip(w.numbers.items(), learners, strict=True)
    }


def _risk(train: DataFrame, **numbers: list[str]) -> Wanted:
    return Wanted(train, CATEGORIES, numbers, LABEL, LOGISTIC)


def _minutes(train: DataFrame, **numbers: list[str]) -> Wanted:
    return Wanted(train.filter(F.col(MINUTES).isNotNull()), MINUTE_CATEGORIES, numbers, MINUTES, ABSOLUTE)


def fit_booking(train: DataFrame, key: str, rounds: int = ROUNDS, step: float = STEP) -> DelayModel:
    return fit_side_by_side([_risk(train, booking=BOOKING_NUMBERS)], key, rounds, step)["booking"]


def fit_dayof(train: DataFrame, key: str, rounds: int = ROUNDS, step: float = STEP) -> DelayModel:
    return fit_side_by_side([_risk(train, dayof=DAYOF_NUMBERS)], key, rounds, step)["dayof"]


def fit_minutes(train: DataFrame, key: str, dayof: bool = False, rounds: int = ROUNDS, step: float = STEP) -> DelayModel:
    """Median minutes on the bounded delay; pass a `hash_sample` of the training rows to bound the fit."""
    return fit_side_by_side([_minutes(train, minutes=DAYOF_NUMBERS if dayof else BOOKING_NUMBERS)], key, rounds, step)["minutes"]


def fit_named(
    names: list[str], booking: DataFrame | None, dayof: DataFrame | None, key: str, rounds: int = ROUNDS, step: float = STEP
) -> dict[str, DelayModel]:
    """The named ones of the four models, grown side by side; the training rows of models not named may be None."""
    wanted = {
        "booking": lambda: _risk(booking, booking=BOOKING_NUMBERS),
        "booking_minutes": lambda: _minutes(booking, booking_minutes=BOOKING_NUMBERS),
        "dayof": lambda: _risk(dayof, dayof=DAYOF_NUMBERS),
        "dayof_minutes": lambda: _minutes(dayof, dayof_minutes=DAYOF_NUMBERS),
    }
    return fit_side_by_side([wanted[name]() for name in names], key, rounds, step)


def fit_models(booking: DataFrame, dayof: DataFrame, key: str, rounds: int = ROUNDS, step: float = STEP) -> Models:
    """All four models."""
    return Models(**fit_named(MODELS, booking, dayof, key, rounds, step))


def fit_logistic(train: DataFrame, max_iter: int = 300, strength: float = 1.0) -> PipelineModel:
    """Logistic regression on one-hot codes; a code unseen in training becomes all zeros.

    `strength` weighs the sum of the losses against half the squared weights, hence the division by the row count.
    """
    # The count, the code tables and the learner all read the training frame, with the joins behind it.
    rows = train.select(*ONE_HOT, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = max(1, rows.filter(F.col(LABEL).isNotNull()).count())
        codes = [f"{c}_i" for c in ONE_HOT]
        return Pipeline(
            stages=[
                StringIndexer(inputCols=ONE_HOT, outputCols=codes, handleInvalid="keep"),
                OneHotEncoder(inputCols=codes, outputCols=[f"{c}_h" for c in ONE_HOT], dropLast=True),
                VectorAssembler(inputCols=[f"{c}_h" for c in ONE_HOT], outputCol="features"),
                LogisticRegression(
                    labelCol=LABEL, maxIter=max_iter, regParam=1.0 / (strength * n), standardization=False
                ),
            ]
        ).fit(rows)
    finally:
        rows.unpersist()


def logistic_scores(model: PipelineModel, df: DataFrame, output: str = "logistic") -> DataFrame:
    scored = model.transform(df).withColumn(output, vector_to_array("probability")[1])
    return scored.select(*df.columns, output)


def compare_models(
    train: DataFrame,
    test: DataFrame,
    key: str,
    booking: DelayModel | Callable[[], DelayModel] | None = None,
    rounds: int = ROUNDS,
    step: float = STEP,
    seconds: bool = False,
) -> DataFrame:
    """Baseline, logistic regression and boosted trees on the same split; booking is the boosted model if it is fitted already, or what fits it.

    Both learners are fitted at the same time, and all metrics read the test rows as scored once. With `seconds` the table has
    `train_seconds`, how long each learner's fit took, the encoding of its rows included; the baseline has none.
    """

    def boosted() -> DelayModel:
        return booking if isinstance(booking, DelayModel) else booking() if booking else fit_booking(train, key, rounds, step)

    def timed_logistic() -> tuple[PipelineModel, float]:
        begun = time.monotonic()
        return fit_logistic(train), time.monotonic() - begun

    spark = train.sparkSession
    risk, (logistic, logistic_seconds), rate = at_once(
        spark, lambda work: work(), [boosted, timed_logistic, lambda: train.agg(F.avg(LABEL)).first()[0]]
    )
    scored = majority_baseline(train, risk.transform(logistic_scores(logistic, test), "risk"))
    scored = cut_lineage(scored.select(LABEL, "baseline", "logistic", "risk"))
    names = {"baseline": "majority", "logistic": "logistic regression", "risk": "boosted trees"}
    table = reduce(DataFrame.unionByName, [binary_metrics(scored, LABEL, column, rate, name) for column, name in names.items()])
    if not seconds:
        return table
    took = {names["logistic"]: logistic_seconds, names["risk"]: risk.seconds}
    known = F.lit(None).cast("double")
    for name, value in took.items():
        known = F.when(F.col("model") == name, F.lit(None if value is None else round(value, 1)).cast("double")).otherwise(known)
    return table.withColumn("train_seconds", known)


def ablation(
    train: DataFrame, test: DataFrame, key: str, groups: dict[str, list[str]] | None = None, rounds: int = ROUNDS, step: float = STEP
) -> DataFrame:
    """features, n_features and auc after each group of features was added to the booking features, in order.

    All models grow side by side on the same binned rows.
    """
    from onblock.operators.metrics import ranking_metrics

    numbers, steps = list(BOOKING_NUMBERS), {}
    for name, extra in (ABLATION if groups is None else groups).items():
        numbers = numbers + extra
        steps[name] = numbers
    fitted = fit_side_by_side([_risk(train, **steps)], key, rounds, step)
    found = []
    for name, names in steps.items():
        scored = ranking_metrics(fitted[name].transform(test, "risk"), LABEL, "risk")
        found.append(scored.select(F.lit(name).alias("features"), F.lit(len(CATEGORIES) + len(names)).alias("n_features"), "auc"))
    return reduce(DataFrame.unionByName, found)


class Registry:
    """Saved models and their facts below one folder; facts are merged by key over successive trainings."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def save(self, name: str, model: DelayModel, facts: dict[str, str]) -> None:
        model.save(f"{self.root}/models/{name}")
        self.add_facts(name, facts)

    def load(self, name: str) -> DelayModel:
        return DelayModel.load(f"{self.root}/models/{name}")

    def add_facts(self, name: str, facts: dict[str, str]) -> None:
        merged = {**self.facts(name), **{k: str(v) for k, v in facts.items()}}
        rows = self.spark.createDataFrame([(name, k, v) for k, v in merged.items()], "model string, key string, value string")
        writer = rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("model").parquet(f"{self.root}/facts")

    def facts(self, name: str) -> dict[str, str]:
        from onblock.sources.ingest import target_exists

        if not target_exists(self.spark, f"{self.root}/facts"):
            return {}
        rows = self.spark.read.parquet(f"{self.root}/facts").filter(F.col("model") == name).collect()
        return {r["key"]: r["value"] for r in rows}
