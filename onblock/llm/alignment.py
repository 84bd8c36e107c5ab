"""Alignment of the tokens of two tokenizers, in Arrow tables that Spark partitions and merges.

Texts are taken in blocks. The token lists of a block are flattened with their parent indices; segmented cumulative sums of token
bytes give every token's end in its text. A hash join of both sides on (text, end) finds the ends they share; each token's group is
the first shared end at or behind its own, and a second hash join on that end yields all links of a group. Grouping counts in how many
texts of the block a pair of ids is linked; Spark merges these partial counts and brings each block the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onblock.llm.bpe import PATTERN, byte_alphabet
from onblock.llm.tables import kept, quoted, settle, ship

BLOCK = 1 << 20
GROUP_BLOCKS = 4  # stored blocks are read again in batches of whole row groups, so these bound a reader's memory
TEXTS_AT_ONCE = 256
END_BITS = 40
CHARACTERS_AT_ONCE = 1 << 20
SPACE = "▁"  # fixed value: how a piece writes a space

ship(__name__)


class ByteTokens:
    """A tokenizer file with a byte-level model whose merges are numbered in the order they are made."""

    def __init__(self, spec: str):
        file, alphabet = json.loads(spec), byte_alphabet()
        special = {t["content"] for t in file["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.pieces = pa.array(self.bytes, pa.large_binary())
        self.lengths = pa.array([len(b) for b in self.bytes], pa.int64())

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([self.encoding.encode_to_numpy(" " + part, disallowed_special=()) for part in parts(text)]).astype(np.int32)


class PieceTokens:
    """A piece model; it puts a space before every text itself."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(self.model.get_piece_size())
        names = [self.model.id_to_piece(i) for i in every]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in zip(every, names, strict=True)]
        self.pieces = pa.array(self.bytes, pa.large_binary())
        self.lengths = pa.array([len(b) for b in self.bytes], pa.int64())
        #: A space that no piece has behind another character always starts a piece.
        self.starts_at_space = not any(SPACE in p.lstrip(SPACE) for p in names)

    def encode(self, text: str) -> np.ndarray:
        found = [self.model.encode(part, num_threads=1) for part in (parts(text) if self.starts_at_space else [text])]
        return np.concatenate([np.array(ids, np.int32) for ids in found])


def parts(text: str) -> Iterator[str]:
    """A long text in parts that leave out the single space between two words at which it is cut."""
    start, cut = 0, re.compile(r"(?<=\S) (?=\S)")
    while len(text) - start > CHARACTERS_AT_ONCE and (found := cut.search(text, start + CHARACTERS_AT_ONCE)):
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]


def check_ranks(spec: str) -> str:
    """The tokenizer file, if its merges make ids in ascending order; otherwise ids are no ranks."""
    model = json.loads(spec)["model"]
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(made):
        raise ValueError("the merges of this tokenizer file do not make ids in ascending order")
    return spec


def _written_bytes(ids: np.ndarray, bounds: np.ndarray, pieces: pa.LargeBinaryArray) -> list[bytes]:
    """The bytes of the tokens between neighbouring bounds, joined: in the taken array they lie side by side."""
    if not len(ids):
        return [b""] * (len(bounds) - 1)
    taken = pc.take(pieces, pa.array(ids))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[bounds].tolist()
    characters = (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [characters[start:end] for start, end in zip(ends[:-1], ends[1:], strict=True)]


def _tokens(texts: list[str], a: ByteTokens, b: PieceTokens) -> tuple[pa.ListArray, pa.ListArray]:
    """Token lists of both tokenizers; no tokens for empty texts and those that one of them does not give back byte for byte."""
    none = np.empty(0, np.int32)
    wanted = [b" " + text.encode() if text else b"" for text in texts]
    held = [[side.encode(text) if text else none for text in texts] for side in (a, b)]
    flat = [(np.concatenate(lists), np.cumsum([0, *map(len, lists)])) for lists in held]
    given = [_written_bytes(ids, bounds, side.pieces) for side, (ids, bounds) in zip((a, b), flat, strict=True)]
    if lost := [i for i, want in enumerate(wanted) if not given[0][i] == given[1][i] == want]:
        for lists in held:
            for i in lost:
                lists[i] = none
        flat = [(np.concatenate(lists), np.cumsum([0, *map(len, lists)])) for lists in held]
    return tuple(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)) for ids, bounds in flat)


def _ends(lists: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Ids of all tokens, and (text, end in bytes) as one number: cumulative sums that start anew in every text."""
    ids, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pc.take(lengths, ids))
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), total]), lists.offsets[:-1])
    end = pc.subtract(total, pc.take(before, parent))
    return ids, pc.bit_wise_or(pc.shift_left(pc.cast(parent, pa.int64()), END_BITS), end)


def _grouped(ids: pa.Array, ends: pa.Array, shared: np.ndarray, side: str) -> tuple[np.ndarray, pa.Table]:
    """The group number of every token, and how often an id occurs in a group, keyed by the group's end."""
    group = np.searchsorted(shared, ends.to_numpy())
    table = pa.table({"end": shared[group], side: ids}).group_by(["end", side], use_threads=False).aggregate([([], "count_all")])
    return group, table.rename_columns(["end", side, f"n_{side}"])


def _written(group_a: np.ndarray, group_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, text_of: np.ndarray, n_texts: int) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of every text: ids with the sign that follows them, put in the order of the groups and joined."""
    last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(group_a)]
    last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(group_b)]
    text_b = text_of[group_b]
    ends_text = np.append(text_b[1:] != text_b[:-1], True)[: len(text_b)]
    signs = pa.array(np.concatenate([np.where(last_a, 1, 0), np.where(ends_text, 3, np.where(last_b, 2, 0))]), pa.int8())
    numbers = pc.cast(pa.array(np.concatenate([ids_a, ids_b])), pa.string())
    pieces = pc.binary_join_element_wise(numbers, pc.take(pa.array([",", "|", ";", ""]), signs), "")
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    per_text = np.bincount(text_of[group_a], minlength=n_texts) + np.bincount(text_b, minlength=n_texts)
    joined = pc.take(pieces.cast(pa.large_string()), pa.array(order))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    # The characters of neighbouring strings lie side by side, so a text's part of them is its joined string.
    ends = np.frombuffer(joined.buffers()[1], np.int64)[bounds] if len(joined) else np.zeros(len(bounds), np.int64)
    characters = joined.buffers()[2] if len(joined) else pa.py_buffer(b"")
    return [characters[start:end].to_pybytes().decode() for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def linked(texts: list[str], a: ByteTokens, b: PieceTokens) -> dict[str, list | np.ndarray]:
    """What a block keeps: per text the counts, the groups' text and the number of its pairs; the block's pairs; the links by pair."""
    lists_a, lists_b = _tokens(texts, a, b)
    ids_a, ends_a = _ends(lists_a, a.lengths)
    ids_b, ends_b = _ends(lists_b, b.lengths)
    met = pa.table({"end": ends_a}).join(pa.table({"end": ends_b}), "end", join_type="inner", use_threads=False)
    shared = np.sort(met["end"].to_numpy())
    group_a, table_a = _grouped(ids_a, ends_a, shared, "a")
    group_b, table_b = _grouped(ids_b, ends_b, shared, "b")
    links = table_a.join(table_b, "end", join_type="inner", use_threads=False)
    pair = np.left_shift(links["a"].to_numpy().astype(np.int64), 32) | links["b"].to_numpy()
    links = pa.table({"text": links["end"].to_numpy() >> END_BITS, "pair": pair, "n": pc.multiply(links["n_a"], links["n_b"])})
    links = links.group_by(["text", "pair"], use_threads=False).aggregate([("n", "sum")]).sort_by([("text", "ascending"), ("pair", "ascending")])
    held = links.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
    text, n, pairs = links["text"].to_numpy(), links["n_sum"].to_numpy(), held["pair"].to_numpy()
    text_of = shared >> END_BITS
    written = _written(group_a, group_b, ids_a.to_numpy(), ids_b.to_numpy(), text_of, len(texts))
    n_pairs = np.bincount(text, minlength=len(texts))
    upto = np.concatenate([[0], np.cumsum(n)])
    bounds = np.concatenate([[0], np.cumsum(n_pairs)])
    return {
        "n_a": np.diff(lists_a.offsets.to_numpy()).astype(np.int64),
        "n_b": np.diff(lists_b.offsets.to_numpy()).astype(np.int64),
        "n_groups": np.bincount(text_of, minlength=len(texts)).astype(np.int64),
        "n_links": np.diff(upto[bounds]),
        "groups": written,
        "n_pairs": n_pairs.astype(np.int32),
        "pairs": pairs,
        "held": held["count_all"].to_numpy(),
        "link_pair": np.searchsorted(pairs, links["pair"].to_numpy()).astype(np.int32),
        "link_n": n,
    }


PER_TEXT = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string", "n_pairs": "int"}
PER_BLOCK = {"pairs": "long", "held": "long", "link_pair": "int", "link_n": "long"}
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _blocks(spec: str, model: bytes, digest: bool):
    name = f"aligned_{hashlib.sha256(spec.encode() + model).hexdigest()}"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = kept(name, lambda: (ByteTokens(spec), PieceTokens(model)))

        def block(keys: list[pa.Array], texts: list[str]) -> pa.RecordBatch:
            found = linked(texts, a, b)
            if digest:
                found["groups"] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
            columns = {"keys": pa.concat_arrays(keys)} | {c: pa.array(found[c], ARROW[t]) for c, t in (PER_TEXT | PER_BLOCK).items()}
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns.values()], list(columns))

        keys: list[pa.Array] = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            start = 0
            for i, text in enumerate(_strings(batch.column(1))):
                texts.append(text)
                size += len(text)
                if size >= BLOCK:
                    yield block([*keys, batch.column(0)[start : i + 1]], texts)
                    keys, texts, size, start = [], [], 0, i + 1
            if start < batch.num_rows:
                keys.append(batch.column(0)[start:])
        if texts:
            yield block(keys, texts)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return encode


def _strings(column: pa.Array) -> Iterator[str]:
    """The strings of a column, made a few at a time: a batch holds far more texts than a block."""
    for start in range(0, len(column), TEXTS_AT_ONCE):
        yield from column.slice(start, TEXTS_AT_ONCE).to_pylist()


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n (how many texts hold it linked) and best (whether no pair of the same first id has more)."""
    parts_of = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    counts = parts_of.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n")).withColumn("first_id", F.shiftright("pair", 32))
    counts = settle(counts, "pair-counts")
    most = counts.groupBy("first_id").agg(F.max("n").alias("most"))
    return counts.join(most, "first_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The texts of a block with n_best and count_sum; counts has a row for each of the block's pairs."""
    row = {c: blocks.column(c).combine_chunks() for c in blocks.column_names if c != "block"}
    values = {c: (array.chunk(0) if isinstance(array, pa.ChunkedArray) else array).flatten() for c, array in row.items()}
    order = np.argsort(counts["at"].to_numpy())
    n, best = counts["n"].to_numpy()[order], counts["best"].to_numpy(zero_copy_only=False)[order]
    pair, links = values["link_pair"].to_numpy(), values["link_n"].to_numpy()
    bounds = np.concatenate([[0], np.cumsum(values["n_pairs"].to_numpy())])
    per_text = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])
    out = {"key": values["keys"]} | {c: values[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups")}
    out |= {"n_best": pa.array(per_text(links * best[pair]), pa.int64()), "count_sum": pa.array(per_text(links * n[pair]), pa.int64())}
    return pa.table(out)


def align(docs: DataFrame, spec: str, model: bytes, text: str = "text", key: str = "doc_id", digest: bool = False) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, groups, n_best and count_sum of every row.

    spec is the text of a byte-level tokenizer file (A, which gets a space before the text), model a piece model (B, which adds it).
    groups is written `a1,a2|b1;a3|b2,b3`, or its SHA-256 with digest. n_best are links whose pair is linked in the most texts among
    all pairs of its A id, ties included; count_sum adds, over all links, the number of texts that hold the pair.

    Null and empty texts, and those that one tokenizer does not give back byte for byte, have no tokens: zeros and an empty string.
    Null and repeated keys are kept, repeated rows count as texts of their own, an empty table stays empty, other columns play no
    part. A task holds one block of BLOCK characters or one longer text; such a text is encoded in parts that meet at certain cuts.
    """
    check_ranks(spec)
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("keys", T.ArrayType(kind))] + [T.StructField(c, T.ArrayType(T._parse_datatype_string(t))) for c, t in (PER_TEXT | PER_BLOCK).items()])
    rows = docs.select(quoted(key).alias("key"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    blocks = rows.mapInArrow(_blocks(spec, model, digest), schema).withColumn("block", F.monotonically_increasing_id())
    blocks = settle(blocks, "aligned-blocks", GROUP_BLOCKS)
    own = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("at", "pair"))
    counts = own.join(pair_counts(blocks), "pair").select("of_block", "at", "n", "best")
    out = T.StructType([T.StructField(key, kind)] + [T.StructField(c, T._parse_datatype_string(t)) for c, t in PER_TEXT.items() if c != "n_pairs"])
    out = out.add("n_best", "long").add("count_sum", "long")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        return _summed(left, right).rename_columns(out.names)

    sides = blocks.drop("pairs", "held").groupBy("block"), counts.groupBy("of_block")
    return sides[0].cogroup(sides[1]).applyInArrow(summed, out)
