"""The registered queries of the last three operators over all documents against their brute-force versions."""

import hashlib
from collections import Counter

from onblock.llm.queries import QUERIES
from tests.llm import test_alignment, test_suffixes, test_variants

SF = "/root/testdata/sf0.001"


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_token_links(spark):
    want = Counter()
    for key, n_a, n_b, n_groups, n_links, groups, n_best, count_sum in test_alignment.brute(documents(spark)):
        want[key, n_a, n_b, n_groups, n_links, n_best, count_sum, hashlib.sha256(groups.encode()).hexdigest() if groups else ""] += 1
    assert Counter(tuple(r) for r in QUERIES["op11_token_links"](spark, SF).collect()) == want


def test_repeated_bytes(spark):
    rows = documents(spark)
    plain = test_suffixes.brute([text for _, text in rows])
    want = Counter((key, n, gone, spans, hashlib.sha256(kept).hexdigest()) for (key, _), (n, gone, spans, kept) in zip(rows, plain, strict=True))
    assert Counter(tuple(r) for r in QUERIES["op12_repeated_bytes"](spark, SF).collect()) == want


def test_spelling_variants(spark):
    got = [tuple(r) for r in QUERIES["op13_spelling_variants"](spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == test_variants.brute(documents(spark), 97)
