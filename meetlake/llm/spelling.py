"""Spelling variants grouped by single edits (operator 11).

Words are maximal runs of `[A-Za-z\\u00C0-\\u00FF]` with A-Z in lower case; of one run in 199, by
CRC-32 of `<doc_id>:<run>`, one code point is dropped. Tasks count runs per document before
anything is moved, so a hot word is one row per task. Words of `MIN_LETTERS` or more that
occur `MIN_COUNT` times or more are compared.

Two words are near if they differ by one inserted, deleted or replaced code point, that is if
their common prefix and common suffix together reach the longer length minus one. Of the shorter
word's s code points such an edit leaves either the first s div 2 or the others in place, so near
words share a key (s, side, that half). Words of a key meet as matrices of code points, padded to
one width, once aligned left and once right; blocks of them are compared whole, which gives
prefix and suffix lengths of all pairs of two blocks at once. Only near pairs leave a
task. A key of more than `TILE_ROWS` words is split into tiles, pairs of hashed blocks, so no key
meets in one task. A pair with both halves in common is reported by its prefix key only.

A word's form is its near word of largest count (ties: smallest in code-point order), if that
counts at least `RATIO` times the word. Counts grow along forms, so following them ends; roots are
found by doubling the steps, in the logarithm of the longest chain.

Defined results: null and empty texts have no words; a null id stands as the empty text in the hash;
repeated rows count each time; long texts and runs are taken whole; without words there are no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetlake.session import staged

MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
TYPO_EVERY = 199
TILE_ROWS = 4096
#: Rows of the matrices compared at once; small enough for a processor's cache.
BLOCK = 256
#: Distinct words a task holds before it hands on its counts.
HELD_WORDS = 300_000
_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")


def _lowered(text: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return text.lower() if text.isascii() else text.encode("utf-8", "replace").lower().decode()


def written(head: int, run: str) -> str:
    """The word a run stands for; `head` is the CRC-32 of what comes before the run."""
    h = zlib.crc32(run.encode(), head)
    if h % TYPO_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n) of the words to compare."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            kept = {w: n for w, n in held.items() if len(w) >= MIN_LETTERS}
            held.clear()
            return pa.record_batch(
                [pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                head = zlib.crc32(f"{i or ''}:".encode())
                for run, n in Counter(_RUN.findall(_lowered(t))).items():
                    held[written(head, run)] += n
                if len(held) > HELD_WORDS:
                    yield out()
        if held:
            yield out()

    rows = docs.filter(F.length(text) >= MIN_LETTERS)
    rows = rows.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(partial, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _keyed(words: DataFrame) -> DataFrame:
    """(word, n, s, side, key): each word with the halves it shares with near words."""
    size = F.length("word")

    def halves(s):
        half = F.floor(s / 2).cast("int")
        first, last = F.left("word", half), F.right("word", s - half)
        return [
            F.struct(s.alias("s"), F.lit(side).alias("side"), part.alias("part"))
            for side, part in enumerate((first, last))
        ]

    # as one of the shorter length, and as the longer of the two
    keys = F.array(*halves(size), *halves(size - 1))
    rows = words.select("word", "n", F.explode(keys).alias("k")).filter(F.col("k.s") >= MIN_LETTERS)
    return rows.select("word", "n", "k.s", "k.side", F.xxhash64("k.part").alias("key"))


def _tiled(keyed: DataFrame, tile_rows: int) -> DataFrame:
    """Adds block, and the tile (a, b) of blocks; rows of large keys stand once per tile."""
    keys = ["s", "side", "key"]
    large = keyed.groupBy(*keys).count().filter(F.col("count") > tile_rows)
    blocks = large.select(*keys, F.ceil(F.col("count") / tile_rows).cast("int").alias("blocks"))
    rows = keyed.join(blocks, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = rows.withColumn("other", F.explode(others))
    return rows.select(
        "word", "n", *keys, "block",
        F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
    )


def _aligned(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, padded with 0 to one width: aligned left, and aligned right."""
    flat = "".join(w.ljust(width, "\0") for w in words) + "".join(w.rjust(width, "\0") for w in words)
    points = np.frombuffer(flat.encode("utf-32-le"), dtype="<u4").reshape(2, len(words), width)
    if points.size and points.max() < 256:
        points = points.astype(np.uint8)
    return points[0], points[1]


def _common(x: np.ndarray, y: np.ndarray, places) -> np.ndarray:
    """How many places in turn hold equal code points, for all pairs of rows."""
    alike = np.ones((len(x), len(y)), dtype=bool)
    # prefix and suffix are added up later
    total = np.zeros((len(x), len(y)), dtype=np.uint16 if x.shape[1] < 2**15 else np.uint32)
    for p in places:
        alike &= x[:, p, None] == y[None, :, p]
        if not alike.any():
            break
        total += alike
    return total


def near_pairs(a: list[str], b: list[str], s: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, common prefix) of near words, the shorter of each pair of s code points.

    Words have s or s + 1 code points; two of s + 1 belong to another key.
    """
    width, at = s + 1, max(1, min(BLOCK, 2**22 // (s + 1)))
    long_a, long_b = np.array([len(w) > s for w in a]), np.array([len(w) > s for w in b])
    for i in range(0, len(a), at):
        left_a, right_a = _aligned(a[i : i + at], width)
        for j in range(0, len(b), at):
            left_b, right_b = _aligned(b[j : j + at], width)
            la, lb = long_a[i : i + at, None], long_b[None, j : j + at]
            prefix = _common(left_a, left_b, range(width))
            suffix = _common(right_a, right_b, range(width - 1, -1, -1))
            longer = s + (la | lb)
            # equal words are equal to the end of the padding
            near = (prefix + suffix >= longer - 1) & (prefix < longer) & ~(la & lb)
            for p, q in zip(*np.nonzero(near)):
                yield i + int(p), j + int(q), int(prefix[p, q])


def _group_pairs(rows: list[tuple], s: int, side: int) -> Iterator[tuple]:
    """(word, n, other, n) of near words in rows (key, a, b, block, word, n) of whole tiles.

    Small keys stand in one list, so that they are compared in one block.
    """
    half = s // 2
    first = [r for r in rows if r[3] == r[1]]
    second = [r for r in rows if r[3] == r[2]]
    for i, j, prefix in near_pairs([r[4] for r in first], [r[4] for r in second], s):
        x, y = first[i], second[j]
        if x[:3] != y[:3] or (prefix < half) != bool(side):
            continue
        if x[1] == x[2] and x[4] > y[4]:  # within one block every pair is seen twice
            continue
        yield x[4], x[5], y[4], y[5]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of a sorted partition: whole tiles, small ones by blocks of several."""

    def out(pairs: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pairs))
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n", "other", "other_n"]
        )

    def runs() -> Iterator[tuple[int, int, list[tuple]]]:
        """Rows of one (s, side): whole tiles, as many as fit a block, or one that does not."""
        ready, current, tile, at = [], [], None, None
        for batch in batches:
            for s, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
                here = (s, side, *row[:3])
                if here != tile:
                    if ready and (at != (tile[0], tile[1]) or len(ready) + len(current) > BLOCK):
                        yield *at, ready
                        ready = []
                    if current:
                        ready, at, current = ready + current, (tile[0], tile[1]), []
                    tile = here
                current.append(tuple(row))
        if ready and (at != (tile[0], tile[1]) or len(ready) + len(current) > BLOCK):
            yield *at, ready
            ready = []
        if current:
            yield tile[0], tile[1], ready + current

    found: list[tuple] = []
    for s, side, rows in runs():
        if len(rows) > 1:
            found += _group_pairs(rows, s, side)
        if len(found) > 20_000:
            yield out(found)
            found = []
    if found:
        yield out(found)


def near_words(words: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(word, n, other, other_n): every near pair of `words` (word, n) once."""
    order = ["s", "side", "key", "a", "b"]
    rows = _tiled(_keyed(words), tile_rows).repartition(*order).sortWithinPartitions(*order)
    rows = rows.select("s", "side", "key", "a", "b", "block", "word", "n")
    return rows.mapInArrow(_compared, "word string, n bigint, other string, other_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where following forms ends."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = staged(now, "spelling-roots")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = now.join(ahead, "root", "left")
        if met.filter("next IS NOT NULL").isEmpty():
            return now
        now = met.select("word", F.coalesce("next", "root").alias("root"))


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = staged(counted(docs, doc_id, text), "spelling-words")
    pairs = near_words(words, tile_rows)

    def way(*columns: str):
        return F.struct(*[F.col(c).alias(a) for c, a in zip(columns, ("word", "n", "o", "m"))])

    both = F.array(way("word", "n", "other", "other_n"), way("other", "other_n", "word", "n"))
    links = pairs.select(F.explode(both).alias("l")).select("l.*")
    best = F.min(F.struct((-F.col("m")).alias("minus"), "o")).alias("best")
    near = links.groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    larger = -F.col("best.minus") >= RATIO * F.col("n")
    near = near.select(
        "word",
        "n_near",
        F.when(larger, F.col("best.o")).alias("form"),
        F.when(larger, -F.col("best.minus")).alias("form_n"),
    )
    near = staged(near, "spelling-near")
    ends = roots(near.filter("form IS NOT NULL"))
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
        )
    )
