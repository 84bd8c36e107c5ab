"""Ids and texts against the tokenizers library."""

import random
import string
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from onblock.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPEC = bpe.read_tokenizer(PATH)
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(bpe.Vocabulary(SPEC))


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\t'srelv1aß😀.", max_size=60))
def test_encoder_equals_the_library(text):
    assert ENCODER.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_texts_meet_at_certain_cuts(monkeypatch):
    monkeypatch.setattr(bpe, "CHARACTERS_AT_ONCE", 50)
    text = "Words it's  and\n\n numbers 123 456!!  " * 40 + "x" * 300
    encoder = bpe.Encoder(bpe.Vocabulary(SPEC))
    assert len(list(encoder.parts(text))) > 5
    assert encoder.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    text = "one two three four five six seven one two"
    assert bpe.Encoder(bpe.Vocabulary(SPEC)).encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_memories_stay_within_their_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5_000)
    encoder = bpe.Encoder(bpe.Vocabulary(SPEC))
    text = " ".join(f"word{i} Straße{i} \u6771\u4eac{i % 7}" for i in range(400))
    assert encoder.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    for memory in (encoder, encoder.fragments):
        assert sum(len(k) + len(v) + bpe.ENTRY for part in (memory, memory.older) for k, v in part.items()) <= 5_000


@pytest.mark.parametrize("alphabet", ["a", "ab", string.ascii_letters + string.digits + "+/", "é🙂x"])
def test_long_unbroken_runs_take_seconds(alphabet):
    rng = random.Random(2)
    text = "".join(rng.choices(alphabet, k=1_000_000 if len(alphabet) != 2 else 200_000))
    started = time.perf_counter()
    ids = ENCODER.encode(text).tolist()
    assert time.perf_counter() - started < 60
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abtheinr é", min_size=1, max_size=200))
def test_both_ways_of_merging_are_the_same(text):
    ids = [ENCODER.vocabulary.single[b] for b in text.encode()]
    assert ENCODER._merged_long(list(ids)) == ENCODER._merged_short(list(ids))


def test_certain_cuts_are_in_no_token():
    vocabulary = bpe.Vocabulary(SPEC)
    pairs = {a << 8 | b for token in vocabulary.tokens.values() if token not in map(str.encode, vocabulary.special) for a, b in zip(token, token[1:])}
    assert vocabulary.inside == pairs and len(pairs) < 65536


@pytest.mark.parametrize("ids", [[], [0, 50256, 5], [128, 129], [-1, 10**6]])
def test_decode(spark, ids):
    got = spark.createDataFrame([(ids,), (None,)], "ids array<int>").select(bpe.decode(F.col("ids"), SPEC).alias("t")).collect()
    assert got[0]["t"] == LIBRARY.decode([i for i in ids if 0 <= i < 50257], skip_special_tokens=False) and got[1]["t"] == ""


def test_round_trip_of_odd_rows(spark):
    texts = [None, "", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "é\r\n\u2028 x", "w" * 20_000, "same", "same"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", bpe.encode(F.col("text"), SPEC).alias("ids"))
    for row in df.select("text", "ids", bpe.decode(F.col("ids"), SPEC).alias("back")).collect():
        assert row["ids"] == LIBRARY.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["back"] == (row["text"] or "")
    assert df.filter("false").count() == 0
