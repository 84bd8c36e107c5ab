"""Labelled training rows: a bounded sample of the labels, met with their documents without moving other texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.llm.tables import quoted

SPREAD = 1 << 30


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the folds; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, rows: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text, label) of the training documents; about `rows` of them at most, by a hash of the key, whatever the size of the tables.

    Labels that are null, or neither 0 nor 1, and labels without a document drop out; several labels of a key count by their largest.
    The sampled labels are sent to all executors: they are at most about `rows` pairs of numbers.
    """
    own, given = quoted(key), quoted(label)
    usable = labels.filter(given.isin(0, 1) & training).groupBy(own.alias("label_key")).agg(F.max(given).cast("int").alias("label"))
    there = usable.count()
    share = min(1.0, rows / max(there, 1))
    picked = usable.filter(F.pmod(F.xxhash64("label_key"), F.lit(SPREAD)) < int(share * SPREAD)) if share < 1 else usable
    texts = docs.select(own.alias("key"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), F.col("key") == F.col("label_key")).select("key", "text", "label")
