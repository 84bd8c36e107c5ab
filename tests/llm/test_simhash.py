"""Fingerprints and components against brute force, with short and long posting lists."""

import random
import re

import pytest
import xxhash

from onblock.llm import simhash

MASK = (1 << 64) - 1


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """fps: (id, fingerprint) -> least reachable id for each row."""
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, a) in enumerate(fps):
        for j in range(i):
            if ((a ^ fps[j][1]) & MASK).bit_count() <= 2:
                label[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(fps):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", "  \n", "One", "one TWO", "one two three", "É é É é x", "a b c d e f g a b c", "x\x0by\x0cz w\xa0v u"])
def test_fingerprint(text):
    assert simhash.fingerprint_of((text or "").encode()) & MASK == plain_fingerprint(text)


def test_fingerprint_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    text = " ".join(random.Random(1).choices("a b c d e f".split(), k=100))
    assert simhash.fingerprint_of(text.encode()) & MASK == plain_fingerprint(text)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def make(seed, groups, size, spread):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(size):
            value = centre
            for _ in range(rng.randint(0, spread)):
                value ^= 1 << rng.randrange(64)
            rows.append(value)
    rng.shuffle(rows)
    return [(i + 5, signed(v)) for i, v in enumerate(rows)] + [(3, 0), (4, 0), (None, signed(rows[0])), (None, 1 << 50)]


@pytest.mark.parametrize("long_list", [1, 4, 64])
def test_components_equal_brute_force(spark, monkeypatch, long_list):
    monkeypatch.setattr(simhash.fingerprint_links, "__defaults__", (long_list,))
    rows = make(long_list, 12, 25, 4)
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    want = dict(zip(rows, plain_components(rows)))
    assert len(got) == len(rows)
    for row in got:
        assert row["component_id"] == want[row["doc_id"], row["fp"]]


def test_chains_become_one_component(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)]
    got = {r["node"]: r["label"] for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[200] == got[150] == got[100] == 100


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(2, text, 1), (1, text, 2), (1, text, 2), (None, text, 3), (7, "another text altogether here", 4), (8, "", 5), (9, None, 6)]
    kept = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    assert sorted((r["doc_id"], r["fp"]) for r in kept) == [(1, 2), (7, 4), (8, 5)]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.deduplicate(none).count() == 0
