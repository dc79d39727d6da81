"""Quality classifier from weak labels (operator 1).

Ten overlapping heuristic labellers look at a whole text and vote good, bad or abstain.
Expectation-maximisation over the counts of vote patterns of *all* documents estimates how
each labeller votes on good and on bad texts, with no labels given. The posterior of a
document's own pattern is then the (soft) label on which a hashed linear scorer is trained
with a bounded sample; the scorer judges every whole text.

Defined results: a null text counts as empty; an empty text is scored like any other (its
only features are the intercept and the length bin) and is rejected by the labellers'
verdict. Equal texts get equal scores. With no documents the fit is neutral: every score is
0.5. `doc_id`, `lang` and `source` are never inputs.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from meetlake.llm.common import bounded_sample, free_name

GOOD, BAD, ABSTAIN = 1, 0, 2
LABELLERS = (
    "capitals", "shouting", "symbols", "endings", "letters", "bars", "stutter", "variety",
    "lines", "sentences",
)
#: Documents the scorer is trained on, at most; labeller accuracies use all documents.
SAMPLE_ROWS = 6000
#: Texts longer than this (characters) are left out of that sample, never of the scoring.
SAMPLE_CHARS = 50_000
TRIGRAM_BITS, EVENT_BITS = 11, 8
DIM = 2**TRIGRAM_BITS + 2**EVENT_BITS
EM_ROUNDS = 50
#: Words of the blocks in which the share of different words is measured, so that it means the
#: same for texts of any length.
BLOCK_WORDS = 200
THRESHOLD = 0.5

_SYMBOLS = set(b"!#$%&*+<=>@[\\]^_`{}~")
_CLASS = np.full(256, 4, dtype=np.uint8)  # 0 lower, 1 upper, 2 space, 3 bar, 4 other, 5 symbol, 6 digit
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[[9, 10, 11, 12, 13, 32]] = 2
_CLASS[ord("|")] = 3
_CLASS[list(_SYMBOLS)] = 5
_CLASS[ord("0") : ord("9") + 1] = 6
_CLASS[128:] = 0  # bytes of letters beyond ASCII


@dataclass(frozen=True)
class Signals:
    """Measures of one text; shares are 0 where there is nothing to divide by."""

    words: int
    letters: int
    capitals: float
    symbols: float
    bars: float
    shouting: float
    endings: float
    letter_share: float
    stutter: float
    variety: float
    repeated_lines: float
    stops: float


def signals(text: str | None) -> Signals:
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return Signals(0, 0, *[0.0] * 10)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    kind = _CLASS[raw]
    lower, upper, space, bars, _, symbols, digits = np.bincount(kind, minlength=7).tolist()
    letters = lower + upper
    # a symbol or bar at the end of a word: before a space or at the very end
    last = np.append(kind[1:] == 2, True)
    endings = int(((kind == 5) | (kind == 3))[last].sum())
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(map(str.__eq__, words, words[1:]))
    stops = text.count(".") + text.count("?") + text.count(";")
    return Signals(
        words=n,
        letters=letters,
        capitals=upper / max(letters, 1),
        symbols=symbols / len(raw),
        bars=bars / n,
        shouting=int((((kind[:-1] == 1) & (kind[1:] == 1)).sum())) / max(letters, 1),
        endings=endings / n,
        letter_share=letters / max(len(raw) - space - digits, 1),
        stutter=same / max(n - 1, 1),
        variety=sum(len(set(words[i : i + BLOCK_WORDS])) for i in range(0, n, BLOCK_WORDS)) / n,
        repeated_lines=1 - len(set(lines)) / max(len(lines), 1),
        stops=stops / n,
    )


def votes(s: Signals) -> list[int]:
    """One vote per labeller, in the order of `LABELLERS`."""

    def band(value: float, good: bool, bad: bool) -> int:
        return BAD if bad else GOOD if good else ABSTAIN

    if not s.words:
        return [ABSTAIN] * 9 + [BAD]
    long = s.letters >= 120  # an address or number must not weigh down a short text
    return [
        band(s.capitals, s.capitals < 0.15 or s.letters < 20, s.capitals > 0.3 and s.letters >= 20),
        band(s.shouting, s.shouting < 0.05, s.shouting > 0.15),
        band(s.symbols, s.symbols < 0.005 or not long, s.symbols > 0.02 and long),
        band(s.endings, s.endings < 0.02, s.endings > 0.1),
        band(s.letter_share, s.letter_share > 0.92 or not long, s.letter_share < 0.88 and long),
        band(s.bars, s.bars == 0, s.bars > 0.1),
        band(s.stutter, s.stutter < 0.03, s.stutter > 0.1),
        band(s.variety, s.variety > 0.45, s.variety < 0.25),
        band(s.repeated_lines, s.repeated_lines < 0.1, s.repeated_lines > 0.4),
        band(s.stops, s.stops >= 0.02, s.words > 80 and s.stops < 0.008),
    ]


def _event(name: str) -> int:
    return 2**TRIGRAM_BITS + (zlib.crc32(name.encode()) & (2**EVENT_BITS - 1))


def features(text: str | None, s: Signals) -> np.ndarray:
    """Hashed features of a whole text: byte trigrams and binned measures, each part of length 1."""
    out = np.zeros(DIM, dtype=np.float32)
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    if len(raw) > 2:
        h = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA77)
        h = (h + raw[2:]) * np.uint32(0xC2B2AE3D) >> np.uint32(32 - TRIGRAM_BITS)
        grams = np.sqrt(np.bincount(h, minlength=2**TRIGRAM_BITS))
        out[: 2**TRIGRAM_BITS] = grams / np.linalg.norm(grams)
    for name in (
        "capitals", "shouting", "symbols", "endings", "letter_share", "bars", "stutter", "variety",
        "repeated_lines", "stops",
    ):
        out[_event(f"{name}:{min(9, int(getattr(s, name) * 20))}")] += 0.4
    out[_event(f"words:{int(math.log2(s.words + 1))}")] += 0.4
    return out


@dataclass(frozen=True)
class LabelModel:
    """Estimated by EM: P(good) and, per labeller and class, the chance of each vote."""

    prior: float
    given: np.ndarray  # labeller x class (bad, good) x vote (bad, good, abstain)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good | votes) for rows of votes."""
        k = np.arange(self.given.shape[0])
        log = np.log(self.given)
        bad = log[k, 0, patterns].sum(1) + math.log(1 - self.prior)
        good = log[k, 1, patterns].sum(1) + math.log(self.prior)
        return 1 / (1 + np.exp(np.clip(bad - good, -60, 60)))


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
    """EM for labellers that are independent given the class, from counts of vote patterns.

    The first guess is good where no labeller votes bad, which also tells which class is
    called good.
    """
    k = len(LABELLERS)
    if not len(patterns):
        return LabelModel(0.5, np.full((k, 2, 3), 1 / 3))
    p = np.where((patterns == BAD).any(1), 0.05, 0.95)
    model = None
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        given = np.empty((k, 2, 3))
        for vote in (BAD, GOOD, ABSTAIN):
            given[:, :, vote] = ((patterns == vote).T @ weight.T) + 1.0
        given /= given.sum(2, keepdims=True)
        prior = float(np.clip((p * counts).sum() / counts.sum(), 0.02, 0.98))
        model = LabelModel(prior, given)
        nxt = model.posterior(patterns)
        done = np.abs(nxt - p).max() < 1e-9
        p = nxt
        if done:
            break
    return model


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    intercept: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.intercept, -60, 60)))


def fit_scorer(x: np.ndarray, p: np.ndarray, rounds: int = 150, ridge: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels; both classes weigh the same in all."""
    if not len(x):
        return Scorer(np.zeros(DIM), 0.0)
    one = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = p / max(p.sum(), 1e-9) + (1 - p) / max((1 - p).sum(), 1e-9)
    weight /= weight.sum()
    lr = 0.1
    w, m, v = (np.zeros(DIM + 1) for _ in range(3))
    for t in range(1, rounds + 1):
        score = 1 / (1 + np.exp(-np.clip(one @ w.astype(np.float32), -60, 60)))
        g = one.T @ ((score - p) * weight).astype(np.float32) + ridge * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - lr * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Scorer(w[:-1], float(w[-1]))


@F.pandas_udf(StringType())
def vote_pattern(text: pd.Series) -> pd.Series:
    """The votes on a text as one digit per labeller."""
    return text.map(lambda t: "".join(map(str, votes(signals(t)))))


@dataclass(frozen=True)
class QualityModel:
    labellers: LabelModel
    scorer: Scorer

    def score(self, text: Column) -> Column:
        """Quality of a whole text, 0 to 1."""
        scorer = self.scorer

        @F.pandas_udf(DoubleType())
        def quality(texts: pd.Series) -> pd.Series:
            if not len(texts):
                return pd.Series([], dtype="float64")
            rows = [features(t, signals(t)) @ scorer.weights for t in texts]
            z = np.clip(np.array(rows) + scorer.intercept, -60, 60)
            return pd.Series(1 / (1 + np.exp(-z)))

        return quality(F.coalesce(text, F.lit("")))


def _patterns(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    keys = sorted(counts)
    rows = np.array([[int(c) for c in k] for k in keys], dtype=np.int64)
    return rows.reshape(len(keys), len(LABELLERS)), np.array([counts[k] for k in keys], float)


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS
) -> QualityModel:
    """Label model from the votes on all documents, scorer from a bounded sample.

    What reaches the driver is a count per vote pattern (at most 3^10 of them) and the sample.
    """
    texts = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    counted = texts.select(vote_pattern("text").alias("p")).groupBy("p").count().collect()
    labellers = fit_labellers(*_patterns(Counter({r["p"]: r["count"] for r in counted})))
    total = sum(r["count"] for r in counted)
    fitting = texts.filter(F.length("text") <= SAMPLE_CHARS)
    pick = bounded_sample(fitting, rows, total, "id", "text").select("text")
    x, seen = [], []
    for r in pick.toLocalIterator():
        s = signals(r["text"])
        x.append(features(r["text"], s))
        seen.append(votes(s))
    if not x:
        return QualityModel(labellers, fit_scorer(np.zeros((0, DIM)), np.zeros(0)))
    p = labellers.posterior(np.array(seen))
    return QualityModel(labellers, fit_scorer(np.stack(x), p))


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, quality (0 to 1), keep (1 if quality >= 0.5, else 0)."""
    model = fit(docs, doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), model.score(F.col(text)).alias("quality"))
    return rows.withColumn("keep", (F.col("quality") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents the classifier does not reject, with all their columns."""
    mark = free_name(docs, "quality_score")
    marked = docs.withColumn(mark, fit(docs, doc_id, text).score(F.col(text)))
    return marked.filter(F.col(mark) >= THRESHOLD).drop(mark)
