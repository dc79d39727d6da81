"""SimHash near-dedup with Golay-code keys (operator 3).

Fingerprint: lower-case A-Z, take the words, hash each 3-word shingle (repeats included) with
XXH64 (seed 42); a bit is set where over half the hashes set it. Two fingerprints link at
`MAX_BITS` = 3 or fewer differing bits; a group is what links reach.

Candidates: the 64 bits are cut into segments of 22, 21 and 21 bits, each read as a word of
the perfect binary Golay code [23, 12], whose decoder names the codeword nearest to it by a
12-bit index. A segment of even weight gives the index of its codeword, one of odd weight
those of all words within one bit of it (about five), so that two segments that differ in
at most one bit always share an index: two at distance one have different parity, and the odd one
looks at the even one. With three errors over three segments (pigeonhole), either
some segment is equal and another differs in at most one bit, or all three differ in
one each. So the keys are (bits of one segment, index of another) for all ordered pairs of
segments, and the three indices together: 33 and 36 bits, about 50 keys. Distinct fingerprints that share a key are
joined and verified; no key is dropped or capped, and copies meet as one fingerprint.

Groups: links between distinct fingerprints are contracted by alternating large-star and
small-star rounds; each round is a table in the shared folder, so lineage stays short.

The pipeline's dedup asks for a Jaccard similarity of shingles of five words instead (`kept`).
Its candidates are first those of this method, by fingerprints of five-word shingles: Golay keys,
join, check of the bits. An exact check on the whole sets follows, and `jaccard` finds the
similar texts that fingerprints miss.

Defined results: a null or empty text has fingerprint 0 and links like any other; rows that
repeat are kept and share a group; the id of a group is its smallest id, null if all its
ids are null.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from meetlake.llm import jaccard
from meetlake.llm.common import free_name
from meetlake.session import staged

SHINGLE_WORDS, MAX_BITS = 3, 3
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_PLACES = (np.arange(8, dtype=np.uint16) * 256)[None, :]


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a whole text."""
    return majority(jaccard.shingle_hashes(text, SHINGLE_WORDS))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half the hashes set; 0 without hashes."""
    if not len(hashes):
        return 0
    # counts of set bits from a histogram of the byte values at each of the eight places
    seen = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _PLACES
    ones = np.bincount(seen.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int(np.packbits(ones.ravel() * 2 > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """Fingerprints as signed 64-bit numbers."""
    out = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
    return pd.Series(out.view(np.int64))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _remainder(v: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words divided by the generator polynomial: 11-bit syndromes."""
    v = v.copy()
    for bit in range(22, 10, -1):
        v ^= ((v >> bit) & 1) * (GOLAY << (bit - 11))
    return v


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and the error of each syndrome."""
    low = _remainder(np.arange(2**12, dtype=np.int64))
    high = _remainder(np.arange(2**11, dtype=np.int64) << 12)
    one = 1 << np.arange(23, dtype=np.int64)
    errors = np.zeros(2**11, dtype=np.int64)
    two = (one[:, None] | one[None, :]).ravel()
    three = (two[:, None] | one[None, :]).ravel()
    for e in (three, two, one):  # perfect code: one error of weight <= 3 per syndrome
        errors[_remainder(e)] = e
    errors[0] = 0
    return low, high, errors


def codeword_index(v: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    low, high, errors = _tables()
    return (v ^ errors[low[v & 0xFFF] ^ high[v >> 12]]) >> 11


def _indices(segment: int, width: int) -> list[int]:
    v = np.array([segment], dtype=np.int64)
    if segment.bit_count() % 2:
        v = np.append(v, segment ^ (1 << np.arange(width, dtype=np.int64)))
    return np.unique(codeword_index(v)).tolist()


def golay_keys(fp: int) -> list[int]:
    """Keys of a fingerprint: any two at three or fewer bits share at least one."""
    fp &= 2**64 - 1
    raw = [(fp >> at) & ((1 << width) - 1) for at, width in SEGMENTS]
    near = [_indices(s, width) for s, (_, width) in zip(raw, SEGMENTS)]
    keys = [
        ((3 * i + j) << 40) | (raw[i] << 12) | index
        for i in range(3)
        for j in range(3)
        if i != j
        for index in near[j]
    ]
    keys += [(15 << 40) | (a << 24) | (b << 12) | c for a in near[0] for b in near[1] for c in near[2]]
    return keys


@F.pandas_udf(ArrayType(LongType()))
def keys_of(fps: pd.Series) -> pd.Series:
    return pd.Series([golay_keys(int(v)) for v in fps], dtype="object")


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints `fp` at three or fewer differing bits."""
    keyed = staged(fps.select("fp", F.explode(keys_of("fp")).alias("key")), "golay-keys")
    a, b = keyed.select("key", F.col("fp").alias("a")), keyed.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    return a.join(b, "key").filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts whose fingerprints link; `nodes` has fp, a text's id, and `simhash`.

    Texts of one fingerprint meet the first of them, and the first ones of linked fingerprints
    meet each other.
    """
    firsts = staged(nodes.groupBy("simhash").agg(F.min("fp").alias("first")), "fingerprints")
    same = nodes.join(firsts, "simhash").filter("fp != first")
    near = links(firsts.select(F.col("simhash").alias("fp")))
    a = firsts.select(F.col("simhash").alias("a"), F.col("first").alias("x"))
    b = firsts.select(F.col("simhash").alias("b"), F.col("first").alias("y"))
    near = near.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return near.union(same.select(F.col("first").alias("a"), F.col("fp").alias("b")))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def groups_of_links(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the links; root is the smallest node of the group.

    Each round points every node at the smallest one it sees, first for larger neighbours,
    then for smaller ones, until nothing changes. Joins are with one row per node.
    """
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("h"))
    now, seen = staged(edges, "links"), None
    while True:
        both = _both_ways(now)
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).filter("b != m")
        now = staged(large.select(F.col("m").alias("a"), "b").distinct(), "links")
        # small star: of a node and its smaller neighbours, all but the least point at it
        down = now.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
        moved = now.join(down, now["b"] == down["n"]).filter("a != m")
        small = moved.select(F.col("m").alias("a"), F.col("a").alias("b")).union(
            down.select(F.col("m").alias("a"), F.col("n").alias("b"))
        )
        now = staged(small.distinct(), "links")
        state = tuple(now.agg(mark.alias("s")).first()["s"])
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _groups(rows: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(fp, root, component_id) of all fingerprints in staged rows (doc_id, fp)."""
    firsts = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = groups_of_links(links(firsts) if edges is None else edges)
    named = firsts.join(roots, F.col("fp") == F.col("node"), "left")
    named = staged(named.select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprints(text).alias("fp"))
    rows = staged(rows, "simhash")
    return rows.join(_groups(rows), "fp").select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"
    )


def kept(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    similarity: float | None = None,
) -> DataFrame:
    """One row of each group, with all its columns: that of the group's smallest id.

    With a `similarity` links are those of the texts' sets of shingles of `words` words, at that
    Jaccard similarity or more: those that fingerprints of such shingles find, each checked on
    the sets, and those they miss. A null id never wins over an
    id; of several rows with the winning id (repeated rows) the one of smallest text hash stays.
    """
    if similarity is None and words != SHINGLE_WORDS:
        raise ValueError(f"fingerprints are of {SHINGLE_WORDS} words")
    fp, row = free_name(docs, "simhash_fp"), free_name(docs, "simhash_row")
    if similarity is None:
        marked = docs.withColumn(fp, F.struct(fingerprints(text).alias("fp")))
    else:
        marked = docs.withColumn(fp, jaccard.signatures(text, words, majority))
    marked = staged(marked.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    rows = marked.select(
        F.col(doc_id).alias("doc_id"),
        F.col(fp)["fp"].alias("fp"),
        F.struct(F.col(doc_id).isNull(), doc_id, F.xxhash64(text), row).alias("turn"),
        F.col(row).alias("row"),
    )
    edges = None
    if similarity is not None:
        firsts = rows.groupBy("fp").agg(F.min("row").alias(row)).select(row)
        nodes = marked.join(firsts, row, "left_semi").select(f"{fp}.*", F.col(text).alias("text"))
        met = staged(candidates(nodes.select("fp", "simhash")), "simhash-pairs")
        edges = jaccard.links(nodes, words, similarity, groups_of_links, met)
    turns = rows.join(_groups(rows, edges).select("fp", "root"), "fp").groupBy("root")
    winners = turns.agg(F.min_by("row", "turn").alias(row)).select(row)
    return marked.join(winners, row, "left_semi").select(*docs.columns)
