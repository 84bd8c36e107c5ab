"""From raw documents to tokens: quality, near duplicates, benchmark leaks, personal data, byte-pair tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs. All but the
last keep the columns of documents. A stage works on all rows it is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onblock.llm import decontamination, pii, quality, simhash
from onblock.llm.bpe import encode, read_tokenizer
from onblock.llm.queries import tokenizer_file
from onblock.llm.tables import settle

KEEP_FROM = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at KEEP_FROM or more; null texts are scored as empty ones."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality.score(F.col("text"), model) >= KEEP_FROM) if model is not None else docs


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    return simhash.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars is the length of the new text, 0 for null texts."""
    redacted = pii.redact(docs, pii.fit(docs))
    return redacted.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the byte-pair tokens of every document, with its language and source."""
    ids = encode(F.col("text"), read_tokenizer(tokenizer_file()))
    tokens = docs.select("doc_id", "lang", "source", ids.alias("ids"))
    return tokens.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("pii", redact_pii),
    ("bpe", tokenize),
]

#: Fitted models, components and tokens are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written below the shared folder before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
