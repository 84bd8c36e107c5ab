"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from onblock.llm.variants import SYMBOLS, neighbour_keys, reduced_keys, spelling_variants


def brute(rows, noise):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    alphabet = {c for w in words for c in w}

    def near(w):
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in alphabet} | {a + c + b for a, b in cuts for c in alphabet}
        return sorted((edits & words.keys()) - {w}, key=lambda v: (-words[v], v))

    found = {w: near(w) for w in words}
    form = {w: f[0] if f and words[f[0]] >= 2 * words[w] else None for w, f in found.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(found[w]), words.get(form[w])) for w, n in words.items()}


def test_generated_neighbourhood_is_full_and_each_word_once():
    rng = random.Random(3)
    for length in (1, 2, 5, 9):
        words = ["".join(rng.choice("abcdefgh") for _ in range(length)) for _ in range(20)] + ["a" * length]
        symbols = "".join(chr(104 + i) for i in range(SYMBOLS))  # one letter a symbol
        got = [[] for _ in words]
        for number, keys in neighbour_keys(words, length):
            for i, k in zip(number, keys, strict=True):
                got[i].append(int(k))
        for word, keys in zip(words, got, strict=True):
            r = "".join(next(s for s in symbols if ord(s) % SYMBOLS == ord(c) % SYMBOLS) for c in word)
            cuts = [(r[:i], r[i:]) for i in range(len(r) + 1)]
            want = {r} | {a + b[1:] for a, b in cuts if b} | {a + s + b[1:] for a, b in cuts if b for s in symbols} | {a + s + b for a, b in cuts for s in symbols}
            want = {int(reduced_keys([v], len(v))[0]) if v else 0 for v in want}
            assert len(keys) == len(set(keys)) and set(keys) == want


def test_equals_brute_force(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdeé×") for _ in range(rng.randint(4, 8))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = [rng.choice(stems) for _ in range(30)]
        words = [w.upper() if rng.random() < 0.1 else w[: rng.randrange(len(w))] + rng.choice("abc") + w[rng.randrange(len(w)) :] if rng.random() < 0.3 else w for w in words]
        rows.append((i, rng.choice([" ", "_", "1", "\n"]).join(words)))
    rows += [(None, "chained chained chained"), (7, None), (8, ""), (9, "copy " * 50 + "copies " * 3), (9, "copies copies"), (9, "copies copies")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as word", "1 as `n.n`")
    for noise in (None, 7):
        got = spelling_variants(df, noise=noise)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        got = [tuple(r) for r in got.collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows, noise)


def test_chains_long_words_and_nothing(spark):
    long = "ab" * 20_000
    rows = [(1, "aaaaa " * 40 + "aaaab " * 20 + "aaabb " * 10 + "aabbb " * 5 + "abbbb " * 3), (2, " ".join([long] * 6 + [long + "x"] * 3))]
    got = {r["word"]: r for r in spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[w]["root"] for w in ("aabbb", "aaabb", "aaaab", "aaaaa")} == {"aaaaa"} and got["abbbb"]["form"] is None
    assert got[long + "x"]["form"] == long and got[long]["n_near"] == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(empty).count() == 0
    assert spelling_variants(spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")).count() == 0
    assert np.array_equal(reduced_keys(["abcde"], 5), reduced_keys(["ijkde"], 5))
