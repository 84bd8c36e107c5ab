"""The text operators over their whole tables, and the same as DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onblock.llm import pii, toxicity
from onblock.llm.alignment import align
from onblock.llm.bpe import decode, encode, read_tokenizer
from onblock.llm.decontamination import contaminated
from onblock.llm.html import extract
from onblock.llm.labelled import fold
from onblock.llm.quality import fit_quality, score
from onblock.llm.rules import judge
from onblock.llm.sharding import shard
from onblock.llm.simhash import as_hex, fingerprint, near_duplicates
from onblock.llm.suffixes import repeat_digests
from onblock.llm.tables import settle
from onblock.llm.urls import url_verdicts
from onblock.llm.variants import spelling_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs)).select("doc_id", "spans")
    names = F.array(*[F.lit(kind) for kind in pii.KINDS])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda i: F.size(F.filter(base, lambda s: s["kind"] == i)).cast("long")
    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    spec = read_tokenizer(tokenizer_file())
    encoded = table(spark, folder, "documents").select("doc_id", encode(F.col("text"), spec).alias("ids"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), spec), 256).alias("decoded_sha256"),
    )


@query
def op4_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op5_histogram_sort_shards(spark: SparkSession, folder: str) -> DataFrame:
    sharded = shard(table(spark, folder, "documents"), shards=24)
    return sharded.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op7_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", fingerprint(F.col("text")).alias("fp"))
    return near_duplicates(settle(docs, "fps")).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op8_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op8_url_verdicts"] = r"""
WITH rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests)
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.verdict, 'allow') AS verdict
FROM (
  SELECT page_id, host, path, (
    SELECT max_by({'rule': rhost || rpath, 'verdict': rverdict}, length(rhost || rpath))
    FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS hit
  FROM parts)
"""


@query
def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op10_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit_quality(docs, labels)
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op3_toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit_toxicity(docs, labels)
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op11_token_links(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of the byte-level and the piece vocabulary aligned in every document; align() states the rules."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    aligned = align(table(spark, folder, "documents"), read_tokenizer(tokenizer_file()), model, digest=True)
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return aligned.select("doc_id", *counts, F.col("groups").alias("groups_sha256"))


@query
def op12_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """What documents lose to strings of 200 bytes that start elsewhere too; without_repeats() states the rules."""
    return repeat_digests(table(spark, folder, "documents"))


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots, after one letter in 97 (row, word) pairs was lost."""
    return spelling_variants(table(spark, folder, "documents"), noise=97)


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
