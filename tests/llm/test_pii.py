"""Spans against the plain patterns in Python, wide spans, redaction, and odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from onblock.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None,
    "",
    "no data here",
    "mail a.b+c@mail.example.com, a@b, a@b.c_d@e.f and @x.y",
    "ü 10.0.0.1 999.1.1.1 1.2.3.4.5 000255.0.0.1 7.7.7",
    "card 4111 1111 1111 1111 and 4111111111111112 and 4111-1111-1111-1111.",
    "twice 4929348385146306 4845168114407329 in a row, 7536784127813050 4845168114407329 too",
    "call +1 (555) 555-0199 or +49 30 1234567 or +1 23 or (555) 555-0199 now",
    "😀 x@y.zz +12345678901 😀 1.1.1.1",
    "a" * 50_000 + " x@" + "b." * 9_000 + "c " + "1 " * 3_000,
    "+" * 5_000 + "1" * 5_000,
]


def passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(x) <= 255 for x in span.split("."))
    if kind == "card":
        value = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and value % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = [(m.start(), i, m.end()) for i, kind in enumerate(pii.KINDS) for m in re.finditer(PLAIN[kind], text or "") if passes(kind, m.group())]
    return sorted(found)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] * 2, "doc_id long, text string, spans string")


@pytest.fixture(scope="module")
def selector(docs):
    return pii.fit(docs)


def test_base_spans_equal_the_plain_patterns(docs, selector):
    rows = pii.find(docs, selector).collect()
    assert len(rows) == 2 * len(TEXTS)
    for row in rows:
        base = [(s["start"], s["kind"], s["end"]) for s in row["spans"] if s["base"]]
        assert base == plain_spans(TEXTS[row["doc_id"]]), row["doc_id"]


def test_wide_spans_reach_into_what_failed(spark):
    pairs = [("4929348385146306 4845168114407329", 4), ("7536784127813050 9999999999999999", 0)]
    every = pii.Selector([(1.0, {0: (5.0, -1, -1, -1, 0.0)})], dict.fromkeys(pii.KINDS, 0.5))
    found = pii.find(spark.createDataFrame(pairs, "text string, n int"), every).select(F.size("spans").alias("n")).collect()
    assert [r["n"] for r in found] == [2, 2]


def test_trees_select_by_the_outcome_of_the_checks(spark):
    good = [(i, f"number {4_000_000_000_000_000 + 7 * i} is it") for i in range(3_000)]
    selector = pii.fit(spark.createDataFrame(good, "doc_id long, text string"))
    assert selector.thresholds["card"] > 0.1
    row = pii.find(spark.createDataFrame([(1, "x 4929348385146306 4845168114407329 y 4929348385146307 4845168114407320")], "doc_id long, text string"), selector).first()
    assert [(s["start"], s["end"]) for s in row["spans"]] == [(2, 18), (19, 35)]


def test_redaction(spark, selector):
    rows = [(1, "ü x@y.zz or 1.1.1.1!", 5), (2, None, 0), (3, "plain", 5)]
    out = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), selector).collect()}
    assert out == {1: "ü [EMAIL] or [IP]!", 2: None, 3: "plain"}


def test_overlapping_spans_merge(spark):
    found = F.expr("array(named_struct('start', 1L, 'kind', 0, 'end', 4L), named_struct('start', 2L, 'kind', 2, 'end', 6L))")
    assert spark.range(1).select(pii.redacted(F.lit("abcdefgh"), found).alias("t")).first()["t"] == "a[EMAIL]gh"


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(none, pii.fit(none)).count() == 0


def test_running_sums(spark):
    n = 3 * pii.CHUNK + 7
    got = spark.range(1).select(pii.running_sums(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("long"))).alias("s")).first()["s"]
    assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]
