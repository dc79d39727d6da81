"""Links of texts by the Jaccard similarity of their word shingles, for the pipeline's dedup.

A text is the set of its shingles of `words` words (a shorter text is one shingle); texts of
equal sets are one node. The first candidates are those of operator 3, by Golay keys of
fingerprints; what these miss share one of `BANDS` keys of `ROWS` MinHash values each,
and every link is verified on the whole sets. A pair at similarity s shares no key with probability
(1 - s^8)^48: 1.5e-4 at 0.8, 2e-7 at 0.85.

A bucket of near copies is not paired with itself. Its members first meet its head, the node that
shares most keys with others (in a group of copies, about the text they were made of). Links
are contracted, those of fingerprints before the first head, and where a bucket still holds several groups a second head is tried. What is then
still apart is paired by an exact prefix filter on shingles, rarest first: two sets that are
similar enough share one of their first n - ceil(s n) + 1 shingles, and as many as s / (1 + s) of
both sizes together. Shingles that no other such node has cannot be shared, which bounds the
sizes a node's partners may have. Each set also has a bitmap of `BITS` bits, every shingle turning
one bit round: two sets differ in at least as many shingles as their bitmaps do in bits, so
pairs beyond what the similarity allows are dropped where they meet. Neither misses a similar
pair. No bucket is dropped or capped.

Defined results: texts without words are the empty set, one node of size 0 without keys, so
they are copies of each other and of nothing else; rows that repeat, null and empty texts and ties
are for the caller, who numbers nodes; empty input gives no links. Nodes are frames made here,
so columns of the documents do not clash.
"""

from __future__ import annotations

from functools import cache, reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetlake.session import staged

BANDS, ROWS, SEED = 48, 8, 42
#: Heads that the members of a bucket meet, one after the other.
HEADS = 2
#: Bits of a set's bitmap.
BITS = 1024
#: Pairs of one node that are verified in one task.
PAIRS = 500
#: Classes of sizes per factor e.
SIZE_CLASSES = 16
_CHUNK = 256
_EMPTY = np.iinfo(np.uint64).max


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Hashes of the shingles of a text in order, repeats included, letters A-Z in lower case."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    flat, ends = memoryview(b" ".join(parts)), np.cumsum([len(w) + 1 for w in parts])
    size = min(words, len(parts))
    stops = (ends[size - 1 :] - 1).tolist()
    starts = [0, *ends[: len(parts) - size].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(flat[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    return np.unique(shingle_hashes(text, words))


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64)
    return a | np.uint64(1), b


def band_keys(hashes: np.ndarray) -> list[int]:
    """Signed keys of the bands; none for an empty set."""
    if not len(hashes):
        return []
    a, b = _permutations()
    least = np.full(BANDS * ROWS, _EMPTY, dtype=np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        values = hashes[at : at + _CHUNK, None] * a
        values += b
        np.minimum(least, values.min(axis=0), out=least)
    raw = least.astype("<u8").reshape(BANDS, ROWS)
    keys = np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(raw)], dtype=np.uint64)
    return keys.view(np.int64).tolist()


def signatures(text: str, words: int, fingerprint) -> Column:
    """Per text: `fp`, the same for equal sets, its number of shingles `n`, its keys `bands`, and
    `simhash`, the `fingerprint` of its shingles with their repeats."""

    @F.pandas_udf("fp long, n long, bands array<long>, simhash long")
    def signed(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            every = shingle_hashes(t, words)
            s = np.unique(every)
            fp = np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).astype(np.int64)
            mark = np.uint64(fingerprint(every)).astype(np.int64)
            rows.append((int(fp), len(s), band_keys(s), int(mark)))
        return pd.DataFrame(rows, columns=["fp", "n", "bands", "simhash"])

    return signed(text)


def bitmap(hashes: np.ndarray) -> list[int]:
    """Per bit whether an odd number of the hashes fall on it, as signed 64-bit words."""
    odd = np.bincount((hashes.view(np.uint64) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _near_bits(a: str, b: str, n: Column, similarity: float) -> Column:
    """Whether bitmaps differ in no more bits than similar sets of `n` shingles together may."""
    words = [F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(BITS // 64)]
    return reduce(Column.__add__, words) * (1 + similarity) <= n * (1 - similarity) + 1e-9


def _likely(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow the similarity; these are small, the sets are not."""
    marks = sets.select("fp", "bits", F.size("hashes").alias("n"))
    a = marks.select(F.col("fp").alias("a"), F.col("bits").alias("x"), F.col("n").alias("m"))
    b = marks.select(F.col("fp").alias("b"), F.col("bits").alias("y"), "n")
    met = pairs.join(a, "a").join(b, "b")
    return met.filter(_near_bits("x", "y", F.col("m") + F.col("n"), similarity)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets are at least so similar.

    A node in many pairs is dealt to several tasks, its set once to each.
    """
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share")
    dealt = pairs.join(shares, "a").select("a", "b", share)
    every = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    a = sets.join(shares, F.col("fp") == F.col("a")).select("a", every, F.col("hashes").alias("x"))
    b = sets.select(F.col("fp").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    near = both / (F.size("x") + F.size("y") - both) >= similarity
    return dealt.join(a, ["a", "share"]).join(b, "b").filter(near).select("a", "b")


def _stars(members: DataFrame, similarity: float) -> DataFrame:
    """Pairs of each bucket's head and its members of other groups, those alike in size.

    `members` has key, fp, n, degree and root. The head is a node of most shared keys, of
    another group than the most central node's where that was tried before (`top`).
    """
    turn = F.struct("degree", "fp")
    fresh = members.filter("top IS NULL OR root != top")
    head = F.max_by(F.struct("fp", "n", "root"), turn).alias("head")
    met = members.join(fresh.groupBy("key").agg(head), "key").filter("root != head.root")
    met = met.filter(_alike("n", "head.n", similarity))
    return met.select(F.col("head.fp").alias("a"), F.col("fp").alias("b")).distinct()


def _alike(x: str, y: str, similarity: float) -> Column:
    """Of two sets the smaller must have at least that share of the larger one's size."""
    return F.least(x, y) / F.greatest(x, y) >= similarity


def _prefixes(rest: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(fp, root, n, shared, at, t, bits): the shingles by which nodes may find partners.

    `t` is a shingle of the prefix that other nodes have too, `at` the number of such before it,
    `shared` the number of all of them.
    """
    items = rest.join(sets, "fp").select("fp", "root", "n", F.explode("hashes").alias("t"))
    items = staged(items, "jaccard-items")
    often = items.groupBy("t").agg(F.count("*").alias("f")).filter("f > 1")
    # one row per shingle of a document; a document's shingles meet in one row
    common = items.join(often, "t").groupBy("fp", "root", "n")
    common = common.agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("ts"))
    common = common.withColumn("shared", F.size("ts"))
    # of the first n - ceil(s n) + 1 shingles those of one node alone come first
    first = F.col("shared") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    kept = common.filter(first > 0).withColumn("ts", F.slice("ts", 1, first.cast("int")))
    rows = kept.select("fp", "root", "n", "shared", F.posexplode("ts").alias("at", "item"))
    rows = rows.select("fp", "root", "n", "shared", "at", F.col("item.t").alias("t"))
    return rows.join(sets.select("fp", "bits"), "fp")


def _across(prefixes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that may be similar; no similar one is missing.

    The larger looks for the smaller among those of the same shingle and about the sizes it
    may have: at least s n, and not so large that the shared shingles would not do.
    """
    share = (1 + similarity) / similarity
    most = F.col("shared") * share - F.col("n")

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) * SIZE_CLASSES).cast("int")

    rows = prefixes.withColumn("most", most + 1e-9)
    least = F.greatest(F.lit(1), F.floor(F.col("n") * similarity))
    top = F.least(F.col("n"), F.col("most"))
    looks = rows.filter(top >= least).select(
        *[F.col(c).alias(f"a_{c}") for c in ("fp", "root", "n", "shared", "at", "most", "bits")],
        "t",
        F.explode(F.sequence(size_class(least), size_class(top))).alias("class"),
    )
    rows = rows.withColumn("class", size_class(F.col("n")))
    # shared shingles before this one, and from it on
    ahead = F.least(F.col("a_shared") - F.col("a_at"), F.col("shared") - F.col("at"))
    bound = F.least("a_at", "at") + ahead
    fits = (
        (F.col("a_root") != F.col("root"))
        & (F.struct("n", "fp") < F.struct("a_n", "a_fp"))
        & (F.col("n") >= F.col("a_n") * similarity - 1e-9)
        & (F.col("n") <= F.col("a_most"))
        & (F.col("a_n") <= F.col("most"))
        & (bound * share + 1e-9 >= F.col("a_n") + F.col("n"))
        & _near_bits("a_bits", "bits", F.col("a_n") + F.col("n"), similarity)
    )
    met = looks.join(rows, ["t", "class"]).filter(fits)
    return met.select(F.col("a_fp").alias("a"), F.col("fp").alias("b")).distinct()


def links(
    nodes: DataFrame, words: int, similarity: float, contracted, candidates: DataFrame
) -> DataFrame:
    """Links (a, b) that join all texts which a chain of similar texts joins.

    `nodes` has fp, n, bands and text, one row per fp; `contracted` names the root of each
    node of some links; `candidates` are pairs (a, b) to start from.
    """

    @F.pandas_udf("hashes array<long>, bits array<long>")
    def made(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(t, words).view(np.int64) for t in texts]
        return pd.DataFrame({"hashes": found, "bits": [bitmap(h) for h in found]})

    met = nodes.select("fp", "n", F.explode("bands").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    met = staged(met.join(shared, "key"), "jaccard-keys")
    degree = met.groupBy("fp").agg(F.sum("m").alias("degree"))
    needed = degree.select("fp").union(candidates.select("a")).union(candidates.select("b"))
    sets = nodes.join(needed, "fp", "left_semi").select("fp", made("text").alias("s"))
    sets = staged(sets.select("fp", "s.*"), "jaccard-sets")
    found = staged(_verified(_likely(candidates, sets, similarity), sets, similarity), "jaccard-links")
    roots = contracted(found).withColumnRenamed("node", "fp")
    members = met.drop("m").join(degree, "fp").join(roots, "fp", "left")
    members = members.withColumn("root", F.coalesce("root", "fp"))
    members = staged(members.withColumn("top", F.lit(None).cast("long")), "jaccard-members")
    for _ in range(HEADS):
        stars = staged(_likely(_stars(members, similarity), sets, similarity), "jaccard-stars")
        found = staged(found.union(_verified(stars, sets, similarity)), "jaccard-links")
        roots = contracted(found).withColumnRenamed("node", "fp")
        members = members.drop("root", "top").join(roots, "fp", "left")
        members = members.withColumn("root", F.coalesce("root", "fp"))
        # only buckets of several groups go on
        tops = members.groupBy("key").agg(
            F.max_by("root", F.struct("degree", "fp")).alias("top"),
            (F.min("root") != F.max("root")).alias("mixed"),
        )
        members = members.join(tops.filter("mixed").drop("mixed"), "key")
        members = staged(members, "jaccard-members")
        rest = members.select("fp", "root", "n").distinct()
        sets = staged(sets.join(rest, "fp", "left_semi"), "jaccard-sets")
    prefixes = staged(_prefixes(rest, sets, similarity), "jaccard-prefixes")
    across = staged(_across(prefixes, similarity), "jaccard-pairs")
    return found.union(_verified(across, sets, similarity))
