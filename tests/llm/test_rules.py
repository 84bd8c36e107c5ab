"""Base counts against plain Python, and the verdicts of the estimate on planted junk."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from onblock.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def prose(rng, n=120):
    vocabulary = [f"{a}{b}" for a in "lor ips dol sit amet con sec".split() for b in "em um or ing ed er ation al".split()]
    words = rng.choices(vocabulary, k=n)
    return " ".join(w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))


def texts():
    rng = random.Random(3)
    odd = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x " * 400, "\xa0 ü ü ü ü ü", "\x0b\x0c\x1c a\rb", "one\ntwo\none\n \n \none", "#|<&>$*%"]
    repeated = [" ".join(rng.choices("a b c d".split(), k=k)) for k in (7, 30, 300, 5_000)]
    return odd + repeated + [prose(rng) for _ in range(60)]


def test_counts_equal_plain_python(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] * 2
    got = rules.judge(spark.createDataFrame(rows, "doc_id int, text string, n_words string")).collect()
    assert len(got) == len(rows)
    for row in got:
        want = plain(row["text"])
        assert {k: row[k] for k in want} == want, row["text"]


@pytest.mark.parametrize("junk_share", [0.05, 0.4])
def test_junk_goes_and_prose_stays(spark, junk_share):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        clean = prose(rng)
        junk = {
            0: lambda t: " ".join(w + rng.choice(["***", "$$$", "&&&"]) for w in t.split()),
            1: lambda t: " | ".join(t.split()),
            2: lambda t: "!! ".join(t.upper().split()),
        }[i % 3]
        bad = rng.random() < junk_share
        rows.append((i, junk(clean) if bad else clean, bad))
    got = rules.judge(spark.createDataFrame(rows, "doc_id int, text string, bad boolean")).filter("not base_failed")
    assert got.filter(F.col("kept") == F.col("bad")).count() == 0


def test_empty_table(spark):
    assert rules.judge(spark.createDataFrame([], "doc_id int, text string")).count() == 0
