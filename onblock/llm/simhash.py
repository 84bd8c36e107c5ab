"""Near duplicates by SimHash, a byte-position inverted index with count filtering, and linear-size components.

Fingerprints that differ in at most RADIUS bits differ in at most RADIUS of their eight bytes, so they share at least
8 - RADIUS positional bytes. A posting list per single byte would hold a 256th of all fingerprints; here a posting is two of the four
byte pairs, four positional bytes, of which such fingerprints always share one. Pairs from a posting list tally their shared
positional bytes, those that reach the guaranteed count are verified by their bits.

Long posting lists are not paired. There every fingerprint posts itself and its 64 neighbours at one bit, and links to the least
fingerprint that posted the same value: two are within two bits exactly if they post a common value. That is 65 rows each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onblock.llm.tables import quoted, settle, ship

RADIUS = 2
SHINGLE = 3
SEED = 42
LONG_LIST = 64
SHINGLES_AT_ONCE = 1 << 16
PAIR_MASKS = [0xFFFF << (16 * i) for i in range(4)]
KEY_MASKS = [a | b for a, b in combinations(PAIR_MASKS, 2)]

ship(__name__)


def fingerprint_of(text: bytes) -> int:
    """SimHash of the word shingles, as a signed long; 0 without words.

    ASCII letters are lower-cased and words are cut at ASCII white space, which is what the bytes methods do.
    """
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    ends = np.append(spaces, len(line))
    starts = np.append(0, spaces + 1)
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        some = zip(starts[at : at + SHINGLES_AT_ONCE].tolist(), ends[at : at + SHINGLES_AT_ONCE].tolist(), strict=True)
        bits = np.unpackbits(np.frombuffer(b"".join([digest(line[s:e], SEED) for s, e in some]), np.uint8))
        counts += np.add.reduce(bits.reshape(-1, 64), axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint_of(t) for t in texts.cast(pa.large_binary()).to_pylist()], pa.int64())


def fingerprint(text: Column) -> Column:
    """The 64-bit fingerprint as a long; null texts count as empty."""
    return _fingerprints(F.coalesce(text, F.lit("")))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _postings(fps: DataFrame) -> DataFrame:
    """Six rows a fingerprint: which two byte pairs, and their bytes."""
    keys = [F.struct(F.lit(i).alias("pairs"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bytes")) for i, m in enumerate(KEY_MASKS)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.pairs", "k.bytes")


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes two fingerprints share."""
    differ = a.bitwiseXOR(b)
    return sum((differ.bitwiseAND(F.lit(_signed(0xFF << (8 * i)))) == 0).cast("int") for i in range(8))


def fingerprint_links(fps: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """Links (a, b), a < b, over distinct fingerprints in column fp: their components are those of all pairs within RADIUS.

    Pairs from short posting lists are all there; in long ones a pair may be linked through others. An empty table has no links.
    """
    postings = _postings(fps)
    lists = postings.groupBy("pairs", "bytes").agg(F.count("*").alias("n")).filter("n > 1")
    met = settle(postings.join(lists, ["pairs", "bytes"]), "postings")
    short = met.filter(F.col("n") <= long_list)
    left, right = short.select("pairs", "bytes", F.col("fp").alias("a")), short.select("pairs", "bytes", F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    differ = a.bitwiseXOR(b)
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(i)) for i, m in enumerate(KEY_MASKS)])
    paired = (
        left.join(right, ["pairs", "bytes"])
        .filter((a < b) & (F.col("pairs") == first))
        .filter(shared_bytes(a, b) >= 8 - RADIUS)
        .filter(F.bit_count(differ) <= RADIUS)
        .select("a", "b")
    )
    crowd = met.filter(F.col("n") > long_list).select("fp").distinct()
    posted = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    values = crowd.select("fp", F.explode(posted).alias("value"))
    centre = values.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    starred = values.join(centre.select("value", "a"), "value").filter("a < fp").select("a", F.col("fp").alias("b")).distinct()
    return paired.unionByName(starred)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); label is the least node of its component.

    A round hooks every node to its least neighbour, jumps once and contracts the links between hooked nodes; nothing but the
    question whether links are left comes to the driver. Tables are written between rounds.
    """
    edges = settle(links.filter("a <> b").distinct(), "links")
    members = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("least")).select("from", F.least("from", "least").alias("to"))
        hooks = settle(hooks, "hooks")
        further = hooks.select(F.col("from").alias("to"), F.col("to").alias("top"))
        hooks = settle(hooks.join(further, "to").select("from", F.col("top").alias("to")), "hooks")
        x, y = (hooks.select(F.col("from").alias(n), F.col("to").alias(f"{n}_to")) for n in ("a", "b"))
        contracted = edges.join(x, "a").join(y, "b").filter("a_to <> b_to")
        edges = settle(contracted.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
        up = hooks.select(F.col("from").alias("label"), F.col("to").alias("up"))
        members = settle(members.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "members")
    return members


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Adds component_id to a table with doc_id and fp: the least doc_id that links of at most RADIUS bits reach.

    fp has to be settled or cheap, since it is read several times. Documents without words have fingerprint 0 and are linked like
    others. Null ids count for a component only if it has no other; repeated rows stay repeated. Equal fingerprints are counted once
    before any posting, so a group of copies of any size is one entry.
    """
    same = settle(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprints")
    labels = components(fingerprint_links(same.select("fp")))
    grouped = same.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("label", "fp").alias("label"))
    least = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    found = grouped.join(least, "label").select(F.col("fp").alias("own_fp"), "component_id")
    return docs.join(found, F.col("fp") == F.col("own_fp"), "left").drop("own_fp")


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of every group of near duplicates, with the columns of docs: the one with the least id, null ids last.

    Rows get a number when they are written with their fingerprints, so equal rows and rows without an id are told apart.
    """
    numbered = settle(
        docs.select(
            F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
            quoted(key).alias("doc_id"),
            fingerprint(quoted(text)).alias("fp"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "fingerprinted",
    )
    ids = numbered.select("doc_id", "fp", "number")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "number")).alias("best")
    same = settle(ids.groupBy("fp").agg(best), "fingerprints")
    labels = components(fingerprint_links(same.select("fp")))
    chosen = (
        same.join(labels, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("label", "fp").alias("label"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.number").alias("number"))
    )
    return numbered.join(chosen, "number", "left_semi").select("row.*")
