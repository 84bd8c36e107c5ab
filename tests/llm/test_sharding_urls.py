"""Shards: balance, slots, groups. Urls: against a plain search over the rules."""

import itertools
import re

from pyspark.sql import functions as F

from onblock.llm.sharding import shard, write_shards
from onblock.llm.urls import url_verdicts


def by_shard(rows):
    shards = {}
    for row in rows:
        shards.setdefault(row["shard"], []).append(row)
    return shards


def test_shards_are_even_and_slots_have_no_gaps(spark):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.expr("repeat('ab', int(20 + id % 300))").alias("text"), F.lit("x").alias("shard"))
    for range_bytes in (1 << 30, 20_000):
        rows = shard(docs, 7, range_bytes=range_bytes).collect()
        shards = by_shard(rows)
        sizes = [sum(r["size"] for r in own) for own in shards.values()]
        assert len(rows) == 3_000 and set(shards) == set(range(7))
        assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
        assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in shards.values())


def test_a_hot_group_is_cut_only_where_a_splitter_must(spark):
    rows = [(i, "the same text for all of these") for i in range(900)] + [(1_000 + i, f"text {i // 2} here") for i in range(900)]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    sizes = [sum(r["size"] for r in own) for own in by_shard(got).values()]
    assert max(sizes) - min(sizes) <= 100
    cut = [k for k, own in itertools.groupby(sorted(got, key=lambda r: r["text"]), lambda r: r["text"]) if len({r["shard"] for r in own}) > 1]
    assert len(cut) <= 5


def test_equal_rows_are_spread_over_all_shards(spark):
    rows = [(7, "one row that comes again and again")] * 5_000 + [(i, f"row {i} with a text of its own") for i in range(5_000)] + [(None, None)] * 400
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    shards = by_shard(got)
    sizes = [sum(r["size"] for r in own) for own in shards.values()]
    assert len(got) == len(rows) and set(shards) == set(range(24)) and max(sizes) - min(sizes) <= 0.001 * sum(sizes) / 24 + 2 * 50
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in shards.values())


def test_placement_equals_a_plain_sort(spark):
    texts = [f"text {i % 700} " + "long " * (i % 97) for i in range(4_000)] + ["hot"] * 1_500
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    hashed = shard(docs, 9).withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64("doc_id")})
    rows = sorted(hashed.collect(), key=lambda r: (r["h1"], r["h2"], r["shard"], r["slot"]))
    assert [(r["shard"], r["slot"]) for r in rows] == sorted((r["shard"], r["slot"]) for r in rows)
    total, largest, upto = sum(r["size"] for r in rows), max(r["size"] for r in rows), 0
    for number, own in itertools.groupby(rows, lambda r: r["shard"]):
        upto += sum(r["size"] for r in own)
        assert abs(upto - total * (number + 1) / 9) <= largest + 0.001 * total / 9


def test_odd_rows(spark):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, "ü"), (3, "z" * 100_000)]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    assert sorted(r["size"] for r in got) == [8, 8, 8, 8, 10, 100_008] and all(r["grown_shard"] is None and r["law"] == "bytes" for r in got)
    assert shard(spark.createDataFrame([], "doc_id long, text string"), 24).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    write_shards(shard(docs, 4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 4


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/en/x", "block"), ("org", "", "block"), ("b.org", "/q", "allow"), ("Com", "/A", "block")]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in RULES for h in [h.lower()] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, "allow", None)
    return host, path, best[3], best[2]


def test_urls_equal_a_plain_search(spark):
    hosts = ["net", "example.net", "a.example.net", "x.A.Example.net", "org", "b.org", "c.b.org", "notnet", "x.com", "", ".net", "a..net", "É.net", "." * 2_000 + "net"]
    paths = ["", "/", "/en/", "/en/x/y", "/en/xy?en/", "#/en/", "/A", "/a", "//", "/" * 500]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "net/", "a://b://net/", "http://"]
    pages = spark.createDataFrame([(i % 7, u, "mine") for i, u in enumerate(urls + urls)], "page_id int, url string, rule string")
    rules = spark.createDataFrame([*RULES, (None, "/", "block")], "host string, path string, verdict string")
    got = url_verdicts(pages, rules).collect()
    assert len(got) == 2 * len(urls)
    for row in got:
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == plain_verdict(row["url"])


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([("http://x.net/",)], "url string")
    assert [(r["rule"], r["verdict"]) for r in url_verdicts(pages, rules, default="allow").collect()] == [(None, "allow")]
    assert url_verdicts(pages.limit(0), rules).count() == 0
