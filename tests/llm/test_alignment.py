"""Cross-tokenizer alignment against a plain version over the tokenizers themselves."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from tokenizers import Tokenizer

from onblock.llm import alignment
from onblock.llm.alignment import PieceTokens, ByteTokens, align
from onblock.llm.bpe import byte_alphabet, read_tokenizer

SPEC = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


def brute(rows):
    byte_level = Tokenizer.from_str(SPEC)
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    alphabet = byte_alphabet()
    out, holders = [], Counter()
    for key, text in rows:
        a, b = [], []
        if text:
            a = byte_level.encode(" " + text, add_special_tokens=False).ids
            b = pieces.encode(text)
        raw_a = [bytes(alphabet[c] for c in byte_level.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces.id_to_piece(b), strict=True)]
        if any(b"".join(raw) != b" " + (text or "").encode() for raw in (raw_a, raw_b)):
            a, b, raw_a, raw_b = [], [], [], []
        groups, i, j, end_a, end_b, now = [], 0, 0, 0, 0, ([], [])
        while i < len(a) or j < len(b):
            if end_a <= end_b and i < len(a):
                now[0].append(a[i])
                end_a += len(raw_a[i])
                i += 1
            else:
                now[1].append(b[j])
                end_b += len(raw_b[j])
                j += 1
            if end_a == end_b:
                groups.append(now)
                now = ([], [])
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        holders.update(set(links))
        out.append((key, len(a), len(b), groups, links))
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    for key, n_a, n_b, groups, links in out:
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        best = sum(holders[p] == most[p[0]] for p in links)
        yield key, n_a, n_b, len(groups), len(links), text, best, sum(holders[p] for p in links)


def corpus():
    rng = random.Random(1)
    words = "the quick brown naïve café Straße 東京 über-cool 12345 e=mc² \t  \n\n don't I'll 🙂🙃 <|endoftext|> <s> <0x41> x_y_z http://a.b/c?d=1".split(" ")
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for i in range(80)]
    rows += [(100, None), (101, ""), (101, "twice"), (101, "twice"), (None, "no key"), (102, "a ▁ b"), (103, "   "), (104, " lead"), (105, "\x00\x01"), (106, "a" * 3000)]
    return rows + [(107, os.urandom(40).hex()), (108, "ﬁ ½ Å"), (109, "<|endoftext|>")]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 900)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as pairs", "2 as key", "3 as `a.b`")
    got = align(docs, SPEC, MODEL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    want = Counter(brute(rows))
    assert Counter(tuple(r) for r in got.collect()) == want
    digests = Counter((r["doc_id"], r["groups"]) for r in align(docs, SPEC, MODEL, digest=True).collect())
    assert digests == Counter((k, hashlib.sha256(row[5].encode()).hexdigest() if row[5] else "") for row in want.elements() for k in [row[0]])


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id string, text string"), SPEC, MODEL).collect() == []


def test_parts_of_long_texts_meet_at_certain_cuts(monkeypatch):
    text = "\n".join(t for _, t in corpus() if t) * 2
    a, b = ByteTokens(SPEC), PieceTokens(MODEL)
    whole = a.encode(text).tolist(), b.encode(text).tolist()
    monkeypatch.setattr(alignment, "CHARACTERS_AT_ONCE", 50)
    assert len(list(alignment.parts(text))) > 20
    assert (a.encode(text).tolist(), b.encode(text).tolist()) == whole


def test_long_unbroken_text_ends():
    a, b = ByteTokens(SPEC), PieceTokens(MODEL)
    found = alignment.linked(["a" * 300_000, "ab" * 150_000, "x"], a, b)
    assert found["n_links"][0] >= found["n_a"][0] and found["n_a"][2] == 1


def test_bytes_of_all_tokens_come_in_one_step():
    pieces = pa.array([b"", b" a", b"\xf0", b"\x9f\x98\x80"], pa.large_binary())
    ids, bounds = np.array([1, 2, 3, 1], np.int32), np.array([0, 0, 1, 3, 4, 4])
    assert alignment._written_bytes(ids, bounds, pieces) == [b"", b" a", "\U0001f600".encode(), b" a", b""]
    assert alignment._written_bytes(ids[:0], np.zeros(3, np.int64), pieces) == [b"", b""]


def test_stored_blocks_are_read_a_few_at_a_time(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(alignment, "BLOCK", 8)
    rows = [(i, f"text number {i}") for i in range(40)]
    monkeypatch.setattr("onblock.llm.tables.fresh_path", lambda _, label: f"{tmp_path}/{label}")
    found = align(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), SPEC, MODEL)
    assert found.count() == 40
    files = list((tmp_path / "aligned-blocks").glob("*.parquet"))
    groups = [pq.ParquetFile(f).metadata for f in files]
    sizes = [m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)]
    assert sum(sizes) == 40 and max(sizes) <= alignment.GROUP_BLOCKS


def test_strings_are_made_a_few_at_a_time():
    column = pa.array([None if i % 7 == 0 else str(i) for i in range(1000)])
    assert list(alignment._strings(column)) == column.to_pylist()
