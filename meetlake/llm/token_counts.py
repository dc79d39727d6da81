"""Exact token counts at every prefix by dynamic programming (operator 9).

For byte-pair encoding, the last token of a prefix decides all before it: prefix b[:i] ends
in token b[j:i] if that token may follow the last token of b[:j], that is if the pair,
encoded together, stays that pair. So one pass over a part of a text gives, for every
prefix, its last token and its exact number of tokens, count(i) = count(j) + 1. Counts
for truncation and budgets are then look-ups: nothing is encoded again.

A text is cut into parts as the vocabulary's own pre-tokenizer cuts it. Parts of up to
`CACHED_SYMBOLS` are counted once per worker while they are cached, and share the states of
prefixes they begin with. A longer part (an unbroken run) is counted with two numbers per
symbol and not kept, so memory is linear in its length and caches are bounded in bytes.
Strings of special tokens in a text count as one token each, as is the library's default.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows give repeated
rows; texts are counted whole.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

LIMIT = 512
CACHED_PARTS = 250_000
#: Longest part or word a cache holds.
CACHED_SYMBOLS = 64


class PrefixCounter:
    """Token counts of prefixes for one byte-level BPE vocabulary."""

    def __init__(self, path: str, cached: int = CACHED_PARTS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rank = {
            tuple(m if isinstance(m, list) else m.split(" ")): i
            for i, m in enumerate(spec["model"]["merges"])
        }
        #: Merges that make a token, by token.
        self.made: dict[str, list[tuple[int, str, str]]] = {}
        for (a, b), i in self.rank.items():
            self.made.setdefault(a + b, []).append((i, a, b))
        self.trees: dict[str, tuple | None] = {}
        self.vocab = spec["model"]["vocab"]
        ends: dict[str, set[int]] = {}
        for token in self.vocab:
            ends.setdefault(token[-2:], {1}).add(len(token))
        #: Lengths of tokens by their last two symbols, longest first.
        self.lengths = {end: sorted(n, reverse=True) for end, n in ends.items()}
        self.cut = Tokenizer.from_file(path).pre_tokenizer or ByteLevel(add_prefix_space=False)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.pairs: dict[tuple[str, str], bool] = {}
        self.states: dict[str, tuple[str, int]] = {"": ("", 0)}
        self.totals: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        self.cached = cached

    def merged(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges, lowest rank first, leftmost first among equals."""
        while len(symbols) > 1:
            ranked = [self.rank.get(p, np.inf) for p in zip(symbols, symbols[1:])]
            best = min(ranked)
            if best == np.inf:
                break
            out, i = [], 0
            while i < len(symbols):
                if i < len(ranked) and ranked[i] == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _tree(self, token: str) -> tuple | None:
        """(rank, left spine, right spine) of the merges that make a token; None if they do not
        run in order of rank or make something else.

        A spine lists what stands at an end of the token while it is made, each symbol with the
        rank of the merge that ends it.
        """
        known = self.trees.get(token, 0)
        if known == 0:
            known = None
            if len(token) == 1:
                known = -1, ((token, np.inf),), ((token, np.inf),)
            elif len(made := self.made.get(token, ())) == 1:
                rank, a, b = made[0]
                left, right = self._tree(a), self._tree(b)
                if left and right and max(left[0], right[0]) < rank and self._stays(a, b, rank):
                    first = (*left[1][:-1], (a, rank), (token, np.inf))
                    known = rank, first, (*right[2][:-1], (b, rank), (token, np.inf))
            self.trees[token] = known
        return known

    def _stays(self, a: str, b: str, until: float) -> bool:
        """Whether no merge over the seam of two tokens comes before rank `until`.

        The two symbols at the seam change as each side is merged. A merge of both comes
        first if its rank is below those that end them; of equal ranks the leftmost comes first.
        """
        ends, starts, i, j = self.trees[a][2], self.trees[b][1], 0, 0
        while True:
            (x, end), (y, start) = ends[i], starts[j]
            rank = self.rank.get((x, y), np.inf)
            if rank < end and rank <= start and rank < until:
                return False
            if end == start == np.inf:
                return True
            i, j = (i + 1, j) if end <= start else (i, j + 1)

    def follows(self, last: str, token: str) -> bool:
        """Whether `token` may stand after `last`: together they encode to just the two.

        With an empty `last`: whether the token encodes to itself. Where both are made in order of
        rank, the seam alone decides; else the two are merged.
        """
        known = self.pairs.get((last, token))
        if known is None:
            if len(self.pairs) >= 2 * self.cached:
                self.pairs.clear()
            if self._tree(token) and (not last or self._tree(last)):
                known = not last or self._stays(last, token, np.inf)
            else:
                known = self.merged(list(last + token)) == ([last, token] if last else [token])
            self.pairs[last, token] = known
        return known

    def state(self, prefix: str) -> tuple[str, int]:
        """(last token, tokens) of a prefix of a part, in the vocabulary's byte symbols.

        Prefixes are kept, so parts that begin alike share the work; only for short parts.
        """
        states, known = self.states, len(prefix)
        while prefix[:known] not in states:
            known -= 1
        if len(states) >= 2 * self.cached:
            states.clear()
            states[""] = "", 0
            known = 0
        vocab, lengths, pairs = self.vocab, self.lengths, self.pairs
        for i in range(known + 1, len(prefix) + 1):
            for n in lengths.get(prefix[i - 2 if i > 1 else 0 : i], (1,)):
                j = i - n
                if j >= 0 and (token := prefix[j:i]) in vocab:
                    last, count = states[prefix[:j]]
                    stays = pairs.get((last, token))
                    if stays or (stays is None and self.follows(last, token)):
                        states[prefix[:i]] = token, count + 1
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return states[prefix]

    def _counts(self, part: str) -> array:
        """Tokens of every prefix of one part of any length; nothing is kept."""
        starts, counts = array("q", [0]), array("q", [0])
        vocab, lengths, pairs = self.vocab, self.lengths, self.pairs
        for i in range(1, len(part) + 1):
            for n in lengths.get(part[max(0, i - 2) : i], (1,)):
                j = i - n
                if j < 0 or (token := part[j:i]) not in vocab:
                    continue
                last = part[starts[j] : j]
                stays = pairs.get((last, token))
                if stays or (stays is None and self.follows(last, token)):
                    starts.append(j)
                    counts.append(counts[j] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return counts

    def part_counts(self, part: str) -> list[int]:
        """Tokens of every prefix of one part."""
        return self._counts(part).tolist()

    def _parts(self, text: str) -> list[str]:
        return [p for p, _ in self.cut.pre_tokenize_str(text)]

    def _part_total(self, part: str) -> int:
        if len(part) > CACHED_SYMBOLS:
            return self._counts(part)[-1]
        n = self.totals.get(part)
        if n is None:
            if len(self.totals) >= self.cached:
                self.totals.clear()
            n = self.totals[part] = self.state(part)[1]
        return n

    def _segments(self, text: str) -> list[str]:
        """Stretches of plain text and, at odd places, special strings."""
        return self.special.split(text) if self.special else [text]

    def prefix_counts(self, text: str | None) -> list[tuple[int, int]]:
        """(bytes, tokens) at every byte of a text, for its own encoding cut there.

        Between parts this is the count of the text up to there; inside a part the part's
        prefix is counted as if the text ended there.
        """
        out, done, base = [(0, 0)], 0, 0
        for k, segment in enumerate(self._segments(text or "")):
            if k % 2:
                done, base = done + len(segment.encode()), base + 1
                out.append((done, base))
                continue
            for part in self._parts(segment) if segment else []:
                counts = self.part_counts(part)
                out += [(done + i, base + n) for i, n in enumerate(counts) if i]
                done, base = done + len(part), base + counts[-1]
        return out

    def fitting_bytes(self, text: str | None, budget: int) -> int:
        """Longest prefix (bytes) of at most `budget` tokens; nothing is encoded again."""
        return max(b for b, n in self.prefix_counts(text) if n <= budget)

    def _plain(self, text: str) -> int:
        # Between words a space goes with the word after it, so a text falls into " word"
        # chunks; where white space runs on, the text is cut as a whole.
        words = text.split(" ")
        if "" in words or any(w[0].isspace() for w in words[1:]):
            return sum(map(self._part_total, self._parts(text)))
        first, chunks = self._parts(words[0]), self.chunks
        total = sum(map(self._part_total, first))
        try:
            return total + sum(map(chunks.__getitem__, words[1:]))
        except KeyError:
            pass
        if len(chunks) >= self.cached:
            chunks.clear()
        new = [w for w in dict.fromkeys(words[1:]) if w not in chunks]
        found = self._chunk_totals(new)
        # ends of lines join words that hardly meet again
        chunks.update(
            (w, n) for w, n in found.items() if len(w) <= CACHED_SYMBOLS and "\n" not in w
        )
        return total + sum(found[w] if w in found else chunks[w] for w in words[1:])

    def _chunk_totals(self, words: list[str]) -> dict[str, int]:
        """Tokens of " word" chunks, cut in one call; chunks do not change each other's parts."""
        totals, ends, end = [0] * len(words), [], 0
        for w in words:
            end += len(w) + 1
            ends.append(end)
        k = 0
        for part, (begin, _) in self.cut.pre_tokenize_str(" " + " ".join(words)):
            while begin >= ends[k]:
                k += 1
            totals[k] += self._part_total(part)
        return dict(zip(words, totals))

    def count(self, text: str | None) -> int:
        """Tokens of a whole text."""
        total = 0
        for k, segment in enumerate(self._segments(text or "")):
            total += 1 if k % 2 else self._plain(segment) if segment else 0
        return total


@cache
def prefix_counter(path: str) -> PrefixCounter:
    """One per worker process, so that tasks that follow each other share what is cached."""
    return PrefixCounter(path)


def counted(
    docs: DataFrame, tokenizer: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""

    @F.pandas_udf(LongType())
    def tokens(texts: pd.Series) -> pd.Series:
        count = prefix_counter(tokenizer).count
        return pd.Series([count(t) for t in texts], dtype="int64")

    full = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(full).cast("bigint").alias("n_bytes"),
        tokens(full).alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
