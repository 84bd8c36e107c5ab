"""The pipeline against a plain version in Python over the smallest tables, and every query's registration."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from onblock.llm import pii, quality
from onblock.llm.queries import ORACLE, QUERIES
from tests.llm.test_html_leaks import plain_leaks
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def plain_redaction(text):
    runs = []
    for start, kind, end in plain_spans(text):
        if runs and start < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, kind])
    for start, end, kind in reversed(runs):
        text = f"{text[:start]}[{pii.KINDS[kind].upper()}]{text[end:]}"
    return text


def test_run_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = model.score(np.array([quality.statistics(r["text"]) for r in rows]))
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= corpus_pipeline.KEEP_FROM]
    assert 100 < len(rows) < 200
    labels = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
    rows = [r for r, label in zip(rows, labels, strict=True) if r["doc_id"] == label]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r in rows if not plain_leaks(r["text"], items)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: library.encode(plain_redaction(r["text"]), add_special_tokens=False).ids for r in rows}

    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) == len(want)
    assert {r["doc_id"]: r["ids"] for r in got} == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_stages_take_odd_rows(spark):
    """Nulls in every column, empty texts, repeated rows, extra columns; and an empty table."""
    rows = [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (1, "", "en", "s", 0, "x"), (2, "a text of words " * 30, "en", "s", 480, "y")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, fp string"
    for data in (rows, []):
        docs = spark.createDataFrame(data, kind)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= len(data)
            if name != "bpe":
                assert out.columns == docs.columns
    tokens = corpus_pipeline.tokenize(spark, spark.createDataFrame(rows, kind), SF).collect()
    assert sorted(r["n_tokens"] for r in tokens)[:3] == [0, 0, 0]


def test_every_operator_is_registered():
    names = contract.queries()
    assert set(QUERIES) <= set(names) and set(ORACLE) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14)) and "pipeline" in QUERIES
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_over_all_rows(spark, name):
    frame = QUERIES[name](spark, SF)
    n = frame.count()
    whole = {"op8_url_verdicts": "pages", "op9_main_text": "pages"}.get(name, "documents")
    if name not in ("op4_benchmark_leaks", "op13_spelling_variants", "pipeline"):
        assert n == spark.read.parquet(f"{SF}/{whole}.parquet").count()
    assert len(set(frame.columns)) == len(frame.columns)
