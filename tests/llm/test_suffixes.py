"""Repeated strings against brute force."""

import hashlib
import random

import numpy as np

from onblock.llm import suffixes
from onblock.llm.suffixes import LENGTH, common_words, repeat_digests, smaller_than_successor, sorted_suffixes, without_repeats


def brute(texts):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for d, t in enumerate(raw):
        for i in range(len(t) - LENGTH + 1):
            seen.setdefault(t[i : i + LENGTH], []).append((d, i))
    gone = [bytearray(len(t)) for t in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + LENGTH] = b"\1" * LENGTH
    for t, g in zip(raw, gone, strict=True):
        spans = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        yield len(t), sum(g), spans, bytes(b for b, x in zip(t, g, strict=True) if not x)


def corpus(rng):
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, boiler = prose(60), prose(45)
    texts = [prose(rng.randint(1, 150)) for _ in range(60)]
    texts += [f"{prose(rng.randint(0, 40))} {passage} {prose(rng.randint(0, 40))}" for _ in range(25)]
    texts += [boiler + prose(5) for _ in range(10)] + ["a" * n for n in (199, 200, 201, 900, 1500)] + ["ab" * 300, "abc" * 70, "xyz " * 200 + "é" * 400]
    near = prose(200)
    for _ in range(10):
        at = rng.randrange(len(near))
        texts.append(near[:at] + "#" + near[at + 1 :])
    texts += [near, near, None, "", "", texts[3], texts[5], texts[5], prose(30) + texts[70] + prose(30) + texts[70]]
    return texts


def check(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in repeat_digests(docs).collect()}
    want = {i: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, (n, gone, spans, kept) in enumerate(brute(texts))}
    assert got == want
    return docs, want


def test_equals_brute_force(spark):
    docs, _ = check(spark, corpus(random.Random(1)))
    docs = docs.selectExpr("*", "1 as spans", "2 as digest", "3 as `own.x`")
    full = without_repeats(docs)
    assert full.columns[:4] == ["doc_id", "text", "digest", "own.x"]
    for row, (n, gone, spans, kept) in zip(full.orderBy("doc_id").collect(), brute(corpus(random.Random(1))), strict=True):
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], bytes(row["kept"])) == (n, gone, spans, kept)
        assert sum(s["end"] - s["start"] for s in row["spans"]) == gone and len(row["spans"]) == spans


def test_crowded_hashes_long_texts_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", 3)
    monkeypatch.setattr(suffixes, "BYTES_AT_ONCE", 700)
    monkeypatch.setattr(suffixes, "BLOCK", 2_000)
    check(spark, corpus(random.Random(2)))


def test_nothing_to_do(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeat_digests(empty).count() == 0 and without_repeats(empty).count() == 0
    check(spark, [None, "", "short", "x" * 199])


def test_two_stage_sort_equals_plain_sort():
    rng = random.Random(4)
    for alphabet in (b"a", b"ab", b"abcdefgh", bytes(range(256))):
        block = bytes(rng.choice(alphabet) for _ in range(1500)) + b"a" * 300
        wanted = np.array([rng.random() < 0.7 for _ in block])
        key = lambda p: block[p : p + LENGTH]
        order = sorted_suffixes(block, wanted)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        assert [key(p) for p in order] == sorted(key(p) for p in np.flatnonzero(wanted))
        small = smaller_than_successor(np.frombuffer(block, np.uint8))
        assert small.tolist() == [block[i:] < block[i + 1 :] for i in range(len(block))]
        for a, b, words in zip(order[:-1], order[1:], common_words(block, order), strict=True):
            x, y = (key(p).ljust(LENGTH, b"\0") for p in (a, b))
            assert words == next((i // 8 for i in range(0, LENGTH, 8) if x[i : i + 8] != y[i : i + 8]), 25)
