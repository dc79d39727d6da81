"""Packing documents into sequences of fixed length by minimum bin slack (operator 7).

A document's token ids (with the end id) are cut into full windows and one rest. Rests are
packed whole: which of them meet is decided on the *histogram of lengths* alone, at most
`capacity` numbers. Minimum bin slack takes the longest length left, and a subset-sum
dynamic program over bitsets finds the multiset of remaining lengths that comes closest to
filling the window; counts are found by going back through the bitsets, and the pattern is
used as often as the lengths last. Each use exhausts a length or at least halves what is left of it, so the
number of patterns depends on the capacity and not on the number of documents; the plan is
small at any scale. Pieces are numbered within their length in parallel (salted by
buckets of at most `BUCKET_ROWS` pieces on average), and number and plan give sequence and offset by
arithmetic.

Words are encoded once per task and looked up after that: the vocabulary's tokenizer drops
white space between words, so the ids of a text are those of its words in turn. Texts are
encoded in one pass; no ids are moved, only lengths and checksums.

Defined results: a null or empty text is the end id alone; repeated rows give repeated pieces; the
cut depends on the document alone; a rerun gives the same packing.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from meetlake.session import staged

CAPACITY, END_ID = 4096, 2
BUCKET_ROWS = 5000
CACHED_WORDS = 1_600_000


class WordIds:
    """Token ids of words separated by ASCII white space, each encoded once while it is cached."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self._clear()

    def _clear(self):
        self.place: dict[bytes, int] = {}
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.uint32), 0

    @staticmethod
    def _grown(a: np.ndarray, need: int) -> np.ndarray:
        return a if need <= len(a) else np.concatenate([a, np.zeros(max(need, len(a)), a.dtype)])

    def _add(self, words: list[bytes]) -> None:
        """Encode new words in one call and tell their ids apart by where they stand."""
        texts = [w.decode("utf-8", "replace") for w in words]
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        n, first, total = len(words), len(self.place), len(found.ids)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        at = np.fromiter((a for a, _ in found.offsets), np.int64, total)
        sizes = np.bincount(np.searchsorted(begins, at, "right") - 1, minlength=n)
        self.start, self.size = self._grown(self.start, first + n), self._grown(self.size, first + n)
        self.flat = self._grown(self.flat, self.used + total)
        self.size[first : first + n] = sizes
        self.start[first : first + n] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = found.ids
        self.used += total
        self.place.update(zip(words, range(first, first + n)))

    def __call__(self, text: str | None) -> np.ndarray:
        data = (text or "").encode("utf-8", "replace")
        # the vocabulary has no capitals; only special strings are told apart by them
        words = data.split() if b"<|" in data else data.lower().split()
        try:
            at = list(map(self.place.__getitem__, words))
        except KeyError:
            known = self.place
            new = [w for w in dict.fromkeys(words) if w not in known]
            if len(known) + len(new) > self.cached:
                self._clear()
                new = list(dict.fromkeys(words))
            self._add(new)
            at = list(map(self.place.__getitem__, words))
        at = np.array(at, dtype=np.int64)
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[at] - ends + size, size) + np.arange(total)]


@cache
def word_ids(path: str) -> WordIds:
    """One per worker process, so that tasks that follow each other share the words."""
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id="doc_id", text="text"):
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    names = ("start", "length", "ids_crc32", "doc_tokens")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], *[StructField(n, LongType()) for n in names]])

    def cut(batches):
        encode = word_ids(tokenizer)
        for batch in batches:
            of, out = [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(t), np.uint32(END_ID)).astype("<u4")
                for k in range(0, len(ids), capacity):
                    part = ids[k : k + capacity]
                    of.append(i)
                    out.append((k, len(part), zlib.crc32(part), len(ids)))
            table = np.array(out, dtype=np.int64).reshape(-1, 4)
            ids = batch.column("doc_id").take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, *map(pa.array, table.T.copy())], names=["doc_id", *names]
            )

    return rows.mapInArrow(cut, schema)


@dataclass(frozen=True)
class Pattern:
    """A filling of windows: how often it is used, and (length, times) in it."""

    uses: int
    parts: tuple[tuple[int, int], ...]


def fullest(room: int, left: dict[int, int]) -> dict[int, int]:
    """The multiset of remaining lengths whose sum is closest to `room` from below.

    Bit s of a bitset says that sum s can be reached with the lengths so far, longest first;
    it stops as soon as the room can be filled.
    """
    mask = (1 << (room + 1)) - 1
    levels, bits = [], 1
    for length in sorted((x for x in left if x <= room), reverse=True):
        levels.append((length, bits))
        copies = min(left[length], room // length)
        step = 1
        while copies:
            take = min(step, copies)
            bits |= (bits << (length * take)) & mask
            copies -= take
            step *= 2
        if bits >> room:
            break
    total, chosen = bits.bit_length() - 1, {}
    for length, before in reversed(levels):
        times = 0
        while not (before >> total) & 1:
            total -= length
            times += 1
        if times:
            chosen[length] = times
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up all pieces, by minimum bin slack anchored at the longest piece."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        anchor = max(left)
        rest = left | {anchor: left[anchor] - 1}
        parts = fullest(capacity - anchor, {k: v for k, v in rest.items() if v})
        parts[anchor] = parts.get(anchor, 0) + 1
        uses = min(left[k] // n for k, n in parts.items())
        out.append(Pattern(uses, tuple(sorted(parts.items(), reverse=True))))
        for k, n in parts.items():
            left[k] -= uses * n
            if not left[k]:
                del left[k]
    return out


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go, in order of their number within it."""

    lengths: np.ndarray  # sorted; slots of a length follow each other
    first: np.ndarray  # number of the first piece of a slot
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # (length, number) as one sortable value: numbers stay below 2^50
        at = np.searchsorted((self.lengths << 50) + self.first, (length << 50) + number, "right") - 1
        over = number - self.first[at]
        return (
            self.sequence[at] + over // self.times[at],
            self.offset[at] + over % self.times[at] * length,
        )


def slots(patterns: list[Pattern]) -> Slots:
    rows, used, sequence = [], {}, 0
    for p in patterns:
        offset = 0
        for length, times in p.parts:
            rows.append((length, used.get(length, 0), times, sequence, offset))
            used[length] = used.get(length, 0) + p.uses * times
            offset += length * times
        sequence += p.uses
    rows.sort()
    return Slots(*np.array(rows, dtype=np.int64).reshape(-1, 5).T.copy())


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id="doc_id", text="text"
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = staged(pieces(docs, tokenizer, capacity, doc_id, text), "pieces")
    # at most `capacity` lengths
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    layout = slots(plan(counts, capacity))
    spread = {k: -(-n // BUCKET_ROWS) for k, n in counts.items() if n > BUCKET_ROWS}
    salt = F.lit(1)
    if spread:
        many = F.create_map(*[F.lit(x).cast("long") for kv in spread.items() for x in kv])
        salt = F.coalesce(F.get(F.array(many), F.lit(0))[F.col("length")], F.lit(1).cast("long"))
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), salt))
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    rows = rows.withColumn("turn", F.row_number().over(inside)).join(starts, ["length", "bucket"])
    result = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])

    @F.pandas_udf(result)
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = layout.place(length.to_numpy(np.int64), number.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    number = F.col("begin") + F.col("turn") - 1
    return rows.withColumn("slot", place("length", number)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "slot.sequence_id", "slot.offset"
    )
