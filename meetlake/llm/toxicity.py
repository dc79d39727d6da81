"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM (operator 2).

The kernel compares two words by the subsequences of four symbols they share, each weighed by
`DECAY` to the power of its span, so gaps and inserted characters (`id.i-ot`) cost a little
instead of hiding the word. Words carry `^` and `$` at their ends; runs of single letters
(`i d i o t`) are joined to one word first; long words are cut into overlapping windows.

Training is from labelled sentences: each sentence of a labelled document inherits its label,
a sentence scores as its worst word, a document as its worst sentence. Rounds of
multiple-instance learning pick the witness word of each toxic document and the hardest
words of the clean ones, and fit a linear SVM on the Nyström features
``K(x, Z) K(Z, Z)^-1/2`` of `LANDMARKS` landmark words Z. As the kernel is a sum over shared
subsequences, the trained SVM folds into one weight per subsequence of the landmarks: the
score of a word is a sum of look-ups, exactly the SVM's value.

Defined results: a null or empty text has no words and the lowest score of the model; texts
are scored whole; equal texts get equal scores; without labels of both classes every score
is 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from meetlake.llm.common import bounded_sample, free_name, held_out

LENGTH, SPAN, DECAY = 4, 6, 0.7
WINDOW, STEP = 22, 14
#: Labelled documents of each class that training may take, and their longest text (characters).
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 20_000
LANDMARKS = 160
#: Clean words taken for their high margin in each round, besides one of each clean document.
NEGATIVES = 3000
ROUNDS, COST = 4, 2000.0
CACHED_WORDS = 300_000
THRESHOLD = 0.5

_BITS = 6
_SINGLES = re.compile(r"(?:(?<!\S)[^\W\d_][^\w\s]?\s){3,}[^\W\d_](?!\w)")
_EDGES = re.compile(r"^[^\w]+|[^\w]+$")


class _Symbols(dict):
    """Character codes to symbols 3..63; characters beyond a-z share symbols."""

    def __missing__(self, code: int) -> str:
        self[code] = chr(3 + code - 97 if 97 <= code <= 122 else 29 + code % 35)
        return self[code]


_TO_SYMBOL = _Symbols()


def _symbols(word: str) -> bytes:
    """A word as symbols between its end marks."""
    return b"\x01" + word.translate(_TO_SYMBOL).encode("latin-1") + b"\x02"


def pieces(word: str) -> list[bytes]:
    """What of one lower-case word is compared: its symbols, or windows of a long word.

    A word with marks inside is compared as it is and without them.
    """
    bare = word if word.isalnum() else _EDGES.sub("", word)
    forms = [bare] if bare.isalnum() else [bare, "".join(filter(str.isalnum, bare))]
    out: list[bytes] = []
    for s in map(_symbols, forms):
        if len(s) > WINDOW:
            out += [s[i : i + WINDOW] for i in range(0, len(s) - WINDOW + STEP, STEP)]
        elif len(s) >= LENGTH:
            out.append(s)
    return out


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words of a whole text, with joined runs of single letters."""
    low = (text or "").lower()
    found = set(low.split())
    for run in _SINGLES.findall(low):
        found.add("".join(c for c in run if c.isalnum()))
    return found


_PLACES: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}


def _places(length: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Index tuples of all subsequences of a word of that length, their weights and the norm."""
    if length not in _PLACES:
        rows = [
            (i, *(i + j for j in rest))
            for i in range(length - LENGTH + 1)
            for rest in combinations(range(1, min(SPAN, length - i)), LENGTH - 1)
        ]
        at = np.array(rows, dtype=np.int64).reshape(-1, LENGTH)
        weight = DECAY ** (at[:, -1] - at[:, 0] + 1.0)
        _PLACES[length] = at, weight, float(np.sqrt((weight**2).sum()))
    return _PLACES[length]


def codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence codes (word x place) of words of one length, and the normed weights."""
    at, weight, norm = _places(len(words[0]))
    s = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1).astype(np.int32)
    code = s[:, at[:, 0]]
    for k in range(1, LENGTH):
        code = (code << _BITS) | s[:, at[:, k]]
    return code, weight / norm


def kernel(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Length-normed gap-weighted subsequence kernel between two lists of words."""
    spots: dict[int, list[tuple[int, float]]] = {}
    for j, z in enumerate(b):
        code, weight = codes([z])
        for c, w in zip(code[0].tolist(), weight.tolist()):
            spots.setdefault(c, []).append((j, w))
    out = np.zeros((len(a), len(b)))
    for i, x in enumerate(a):
        code, weight = codes([x])
        for c, w in zip(code[0].tolist(), weight.tolist()):
            for j, v in spots.get(c, ()):
                out[i, j] += w * v
    return out


@dataclass
class ToxicityModel:
    """The trained SVM as weights of subsequences, and its calibration."""

    code: np.ndarray
    weight: np.ndarray
    intercept: float
    slope: float
    offset: float
    _table: np.ndarray | None = field(default=None, repr=False)
    _seen: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_table": None, "_seen": {}}

    def margins(self, words: list[bytes]) -> np.ndarray:
        """SVM values of words: the intercept plus the weights of their subsequences."""
        if self._table is None:
            self._table = np.zeros(2 ** (_BITS * LENGTH), dtype=np.float32)
            self._table[self.code] = self.weight
        out = np.empty(len(words))
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        for at in by.values():
            for k in range(0, len(at), 4096):
                part = at[k : k + 4096]
                code, weight = codes([words[i] for i in part])
                out[part] = self._table[code] @ weight
        return out + self.intercept

    def word_margins(self, words: set[str]) -> None:
        """Fill the cache with the margins of words it lacks."""
        new = [w for w in words if w not in self._seen]
        if len(self._seen) + len(new) > CACHED_WORDS:
            self._seen.clear()
            new = list(words)
        parts = [pieces(w) for w in new]
        flat = [p for ps in parts for p in ps]
        value = self.margins(flat) if flat else np.zeros(0)
        i = 0
        for w, ps in zip(new, parts):
            self._seen[w] = max(value[i : i + len(ps)].tolist(), default=-np.inf)
            i += len(ps)

    def margin(self, texts: list[str | None]) -> np.ndarray:
        """Per text the largest margin of its words; the lowest value of all if it has none."""
        sets = [words_of(t) for t in texts]
        self.word_margins(set().union(*sets))
        low = min(self.intercept, 0.0) - 10.0
        worst = [max(map(self._seen.__getitem__, s), default=low) for s in sets]
        return np.maximum(np.array(worst, dtype=float), low)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = self.slope * self.margin(texts) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def score(self, text: Column) -> Column:
        """Toxicity of a whole text, 0 to 1."""
        model = self

        @F.pandas_udf(DoubleType())
        def toxicity(texts: pd.Series) -> pd.Series:
            return pd.Series(model.scores(texts.tolist()), dtype="float64")

        return toxicity(text)


def _no_model() -> ToxicityModel:
    return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), 0.0, 0.0, -60.0)


def _first_margins(bags: list[list[int]], vocab: list[bytes], toxic: np.ndarray) -> np.ndarray:
    """How strongly the best contiguous part of each word speaks for the toxic documents."""
    grams: dict[bytes, int] = {}
    per_word = [
        np.array([grams.setdefault(w[i : i + LENGTH], len(grams)) for i in range(len(w) - LENGTH + 1)])
        for w in vocab
    ]
    count = np.zeros((2, len(grams)))
    for bag, label in zip(bags, toxic):
        if bag:
            count[label, np.unique(np.concatenate([per_word[i] for i in bag]))] += 1
    n = np.array([max((toxic == 0).sum(), 1), max((toxic == 1).sum(), 1)])
    base = (count.sum(0) + 1) / (n.sum() + 2)
    lift = (count[1] - n[1] * base) / np.sqrt(n[1] * base + 1)
    only = np.log((count[1] + 0.1) / n[1]) - np.log((count[0] + 0.1) / n[0])
    value = np.where(only > 0, lift * np.minimum(only, 4), -1.0)
    return np.array([value[g].max() for g in per_word])


def _svm(x: np.ndarray, y: np.ndarray, cost: float, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; both classes weigh the same in all."""
    one = np.hstack([x, np.ones((len(x), 1))])
    c = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * cost
    ridge = np.eye(one.shape[1])
    ridge[-1, -1] = 1e-6
    w, active = np.zeros(one.shape[1]), np.ones(len(y), dtype=bool)
    for _ in range(rounds):
        a = one[active]
        w = np.linalg.solve(ridge + a.T @ (a * c[active, None]), a.T @ (c * y)[active])
        now = y * (one @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def train(texts: list[str], toxic: list[int], landmarks: int = LANDMARKS) -> ToxicityModel:
    """The model from labelled texts (a bounded sample)."""
    y = np.array(toxic, dtype=np.int64)
    ids: dict[bytes, int] = {}
    bags = [
        sorted({ids.setdefault(p, len(ids)) for w in sorted(words_of(t)) for p in pieces(w)})
        for t in texts
    ]
    use = [i for i, b in enumerate(bags) if b]
    if not use or y[use].min() == y[use].max():
        return _no_model()
    bags, y, vocab = [bags[i] for i in use], y[use], list(ids)
    size = np.array([len(b) for b in bags])
    flat = np.concatenate([np.array(b) for b in bags])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])

    def witness(value: np.ndarray, which: int) -> np.ndarray:
        """The word of largest value in each document of a class, most frequent first."""
        of_doc = [flat[s + int(value[flat[s : s + n]].argmax())] for s, n, k in zip(starts, size, y) if k == which]
        words, times = np.unique(of_doc, return_counts=True)
        return words[np.lexsort((words, -times))]

    value = _first_margins(bags, vocab, y)
    clean_used = np.bincount(
        np.concatenate([np.array(b) for b, k in zip(bags, y) if k == 0]), minlength=len(vocab)
    )
    clean_rate = clean_used / (y == 0).sum()
    toxic_used = np.bincount(flat, minlength=len(vocab)) - clean_used
    toxic_rate = toxic_used / (y == 1).sum()
    clean_words = np.flatnonzero(clean_used)
    common = np.argsort(-clean_used, kind="stable")[: landmarks * 4]
    model = _no_model()
    for k in range(ROUNDS):
        pos, neg = witness(value, 1), witness(value, 0)
        # a witness must be at home in toxic texts, and, once there is an SVM, on their side of
        # it: a toxic document without any such word does not teach
        pos = pos[clean_rate[pos] * 5 < toxic_rate[pos]]
        if k and (value[pos] > 0).any():
            pos = pos[value[pos] > 0]
        hardest = clean_words[np.argsort(-value[clean_words], kind="stable")[:NEGATIVES]]
        neg = np.setdiff1d(np.concatenate([neg, common, hardest]), pos)
        if not len(pos) or not len(neg):
            break
        by_use = neg[np.argsort(-clean_used[neg], kind="stable")]
        hard = neg[np.argsort(-value[neg], kind="stable")]
        quarter = landmarks // 4
        z = list(dict.fromkeys([*pos[: 2 * quarter], *hard[:quarter], *by_use[:quarter]]))
        zs = [vocab[i] for i in z]
        kzz = kernel(zs, zs)
        eig, vec = np.linalg.eigh(kzz)
        keep = eig > 1e-6 * eig.max()
        root = vec[:, keep] / np.sqrt(eig[keep])  # K(Z,Z)^-1/2 on its range
        rows = np.concatenate([pos, neg])
        x = kernel([vocab[i] for i in rows], zs) @ root
        w, b = _svm(x, np.where(np.arange(len(rows)) < len(pos), 1.0, -1.0), COST)
        alpha = root @ w
        folded: dict[int, float] = {}
        for a, word in zip(alpha, zs):
            code, weight = codes([word])
            for c, v in zip(code[0].tolist(), (a * weight).tolist()):
                folded[c] = folded.get(c, 0.0) + v
        model = ToxicityModel(
            np.array(list(folded), np.int64), np.array(list(folded.values())), b, 1.0, 0.0
        )
        value = model.margins(vocab)
    worst = np.array([value[flat[s : s + n]].max() for s, n in zip(starts, size)])
    w, b = _calibrated(worst, y)
    return ToxicityModel(model.code, model.weight, model.intercept, w, b)


def _calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset; the cut is put where the two classes are told apart best."""
    order = np.argsort(margin)
    m, k = margin[order], y[order]
    wrong = np.concatenate([[0], np.cumsum(k)]) + np.concatenate([np.cumsum((1 - k)[::-1])[::-1], [0]])
    best = np.flatnonzero(wrong == wrong.min())
    cuts = [(m[max(i - 1, 0)] + m[min(i, len(m) - 1)]) / 2 for i in best]
    width = [m[min(i, len(m) - 1)] - m[max(i - 1, 0)] for i in best]
    cut = float(cuts[int(np.argmax(width))])
    spread = max(float(np.median(m[k == 1]) - np.median(m[k == 0])), 1e-3)
    return 8.0 / spread, -8.0 / spread * cut


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """The model from at most `rows` labelled documents of each class, none of them held out."""
    marked = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    marked = marked.filter(~held_out(F.col(doc_id))).select(
        F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")
    )
    short = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(
        F.length("text").between(1, SAMPLE_CHARS)
    )
    # ids first, so that no more texts than the sample are moved; half as many more for long ones
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    picked = [
        bounded_sample(
            marked.filter(F.col("label") == k), rows + rows // 2, totals.get(k, 0), "id"
        )
        for k in (0, 1)
    ]
    few = F.broadcast(picked[0].unionByName(picked[1]).dropDuplicates(["id"]))
    got = [r for r in short.join(few, "id").toLocalIterator()]
    got.sort(key=lambda r: (r["id"], r["text"]))
    sample = [r for k in (0, 1) for r in [x for x in got if x["label"] == k][:rows]]
    return train([r["text"] for r in sample], [r["label"] for r in sample])


def scored(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5)."""
    model = fit(docs, labels, doc_id, text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        held_out(F.col(doc_id)).alias("held_out"),
        model.score(F.col(text)).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """The documents that are not predicted toxic, with all their columns."""
    mark = free_name(docs, "toxicity_score")
    marked = docs.withColumn(mark, fit(docs, labels, doc_id, text).score(F.col(text)))
    return marked.filter(F.col(mark) < THRESHOLD).drop(mark)
