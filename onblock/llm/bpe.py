"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that no vocabulary token holds can never be merged over, so a token boundary between them is certain.
Texts are cut by the tokenizer's own pattern, the pieces at those pairs, and the fragments are encoded on their own and remembered;
what they give is concatenated. The vocabulary file is read on the driver and travels with the tasks; its size bounds what is sent.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onblock.llm.tables import kept, ship

# The published splitting pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes that an encoder may remember of pieces, a quarter of them of fragments, with an estimate of what an entry costs besides its content.
REMEMBERED, ENTRY = 96 << 20, 240
LONG = 64
TEXTS_AT_ONCE = 512
BITS = 24
NO_MERGE = 1 << 62
CHARACTERS_AT_ONCE = 1 << 20

ship(__name__)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for the 256 bytes: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merges and certain cuts of a tokenizer file with a byte-level BPE model."""

    def __init__(self, spec: str):
        file = json.loads(spec)
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        ids = {raw(token): i for token, i in file["model"]["vocab"].items() if token not in self.special}
        self.tokens = {i: token for token, i in ids.items()} | {i: text.encode() for text, i in self.special.items()}
        self.single = [ids[bytes([b])] for b in range(256)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        #: Both ids in one number -> rank and merged id in one number, so that the least is the merge to make.
        self.merges = {ids[raw(a)] << BITS | ids[raw(b)]: rank << BITS | ids[raw(a + b)] for rank, (a, b) in enumerate(merges)}
        self.inside = {first << 8 | second for token in ids for first, second in zip(token, token[1:], strict=False)}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None


class Memory(dict):
    """Entries up to a number of bytes, in two generations: when the younger has half of them it becomes the older, and the older goes.

    What is asked for while it is in the older generation enters the younger again, so frequent entries stay.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.held, self.older = most, 0, {}

    def keep(self, key: str | bytes, ids: bytes) -> bytes:
        size = len(key) + len(ids) + ENTRY
        if self.held + size > self.most // 2:
            self.older, self.held = dict(self), 0
            self.clear()
        if size <= self.most // 2:
            self[key] = ids
            self.held += size
        return ids


class Encoder(Memory):
    """Piece of text -> the bytes of its ids as int32; pieces and fragments are remembered."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(REMEMBERED)
        self.vocabulary, self.fragments = vocabulary, Memory(REMEMBERED // 4)
        self.pieces = regex.compile(PATTERN).findall
        self.cut = regex.compile(r"(?<=\S) (?=\S)")

    def __missing__(self, piece: str) -> bytes:
        if (known := self.older.get(piece)) is not None:
            return self.keep(piece, known)
        raw, inside = piece.encode(), self.vocabulary.inside
        cuts = [i + 1 for i, pair in enumerate(zip(raw, raw[1:], strict=False)) if pair[0] << 8 | pair[1] not in inside]
        if cuts:
            ids = b"".join([self.fragment(raw[i:j]) for i, j in zip([0, *cuts], [*cuts, len(raw)], strict=True)])
        else:
            ids = self.merged(raw)
        return self.keep(piece, ids)

    def fragment(self, raw: bytes) -> bytes:
        ids = self.fragments.get(raw)
        return self.fragments.keep(raw, self.fragments.older.get(raw) or self.merged(raw)) if ids is None else ids

    def merged(self, raw: bytes) -> bytes:
        """Merges the leftmost pair of the lowest rank until no pair has one."""
        ids = [self.vocabulary.single[b] for b in raw]
        return np.array(self._merged_long(ids) if len(ids) > LONG else self._merged_short(ids), np.int32).tobytes()

    def _merged_short(self, ids: list[int]) -> list[int]:
        merge_of = self.vocabulary.merges.get
        merges = [merge_of(a << BITS | b, NO_MERGE) for a, b in zip(ids, ids[1:], strict=False)]
        while merges and (best := min(merges)) != NO_MERGE:
            at = merges.index(best)
            ids[at : at + 2] = [new] = [best & ((1 << BITS) - 1)]
            del merges[at]
            if at:
                merges[at - 1] = merge_of(ids[at - 1] << BITS | new, NO_MERGE)
            if at < len(merges):
                merges[at] = merge_of(new << BITS | ids[at + 1], NO_MERGE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same on a linked list: pairs wait in a heap by rank and place, and those that have changed since are passed over."""
        merge_of, n = self.vocabulary.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(merge, at) for at in range(n - 1) if (merge := merge_of(ids[at] << BITS | ids[at + 1])) is not None]
        heapify(waiting)
        while waiting:
            merge, at = heappop(waiting)
            right = after[at]
            if ids[at] < 0 or right >= n or merge_of(ids[at] << BITS | ids[right]) != merge:
                continue
            ids[at], ids[right] = merge & ((1 << BITS) - 1), -1
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                if (found := merge_of(ids[at] << BITS | ids[beyond])) is not None:
                    heappush(waiting, (found, at))
            if before[at] >= 0 and (found := merge_of(ids[before[at]] << BITS | ids[at])) is not None:
                heappush(waiting, (found, before[at]))
        return [i for i in ids if i >= 0]

    def parts(self, text: str) -> Iterator[str]:
        """A long text in parts, cut before a single space between two words, where the pattern starts a piece anyway."""
        start = 0
        while len(text) - start > CHARACTERS_AT_ONCE:
            found = self.cut.search(text, start + CHARACTERS_AT_ONCE)
            if found is None:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def encode(self, text: str) -> np.ndarray:
        special, split = self.vocabulary.special, self.vocabulary.split_special
        found = []
        for run in split.split(text) if split and any(map(text.__contains__, special)) else [text]:
            if run in special:
                found.append(np.array([special[run]], np.int32))
            else:
                for part in self.parts(run):
                    found.append(np.frombuffer(b"".join(map(self.__getitem__, self.pieces(part))), np.int32))
        return found[0] if len(found) == 1 else np.concatenate(found)


def encode(text: Column, spec: str) -> Column:
    """Ids of whole texts as array<int>; null and empty texts have none.

    spec is the text of the tokenizer file. Its special tokens are found in texts first, as the file asks for; nothing is added
    before or after a text. Very long texts are encoded in parts that meet at certain cuts, and a run without any cut in a time little
    more than linear. Repeated rows are encoded alike, an empty table stays empty. A worker process builds the vocabulary once and
    keeps what it remembers for its later tasks, within the bytes of REMEMBERED.
    """
    name = hashlib.sha256(spec.encode()).hexdigest()

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = kept(f"encoder_{name}", lambda: Encoder(Vocabulary(spec)))
        for texts in (batch[at : at + TEXTS_AT_ONCE] for batch in batches for at in range(0, len(batch), TEXTS_AT_ONCE)):
            ids = [encoder.encode(t) for t in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))

    return ids_of(F.coalesce(text, F.lit("")))


def decode(ids: Column, spec: str) -> Column:
    """The text of ids: the bytes of all tokens, special ones included, read as UTF-8 with the replacement character for what is none.

    Ids outside the vocabulary give nothing; null and empty lists give an empty text, repeated rows the same text, no rows none.
    """
    tokens = Vocabulary(spec).tokens
    table = [tokens.get(i, b"") for i in range(max(tokens) + 1)] + [b""]

    @F.arrow_udf(T.StringType())
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in (batch[at : at + TEXTS_AT_ONCE] for batch in batches for at in range(0, len(batch), TEXTS_AT_ONCE)):
            values, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            ends = ends - ends[0]
            known = np.where((values >= 0) & (values < len(table)), values, len(table) - 1)
            rows = (known[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False))
            yield pa.array([b"".join(map(table.__getitem__, row)).decode("utf-8", "replace") for row in rows], pa.string())

    return text_of(F.coalesce(ids, F.array().cast("array<int>")))


def read_tokenizer(path: str) -> str:
    """The tokenizer file, read on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()
