"""Quality and toxicity: label model, kernel, and accuracy on rows with known labels."""

from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from meetlake.llm import quality, toxicity
from meetlake.llm.common import held_out

SF_DIR = "/root/testdata/sf0.01"


def test_em_finds_the_accuracy_of_labellers():
    rng = np.random.default_rng(7)
    truth = rng.random(20_000) < 0.8
    k = len(quality.LABELLERS)
    right = np.linspace(0.7, 0.95, k)
    hit = rng.random((len(truth), k)) < right
    votes = np.where(hit, truth[:, None], ~truth[:, None]).astype(int)
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_labellers(rows, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.03
    assert np.abs(model.given[:, 1, quality.GOOD] - right).max() < 0.05
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.97


@pytest.mark.parametrize("times", [20, 120, 2000])
def test_votes_do_not_change_with_length(times):
    rng = random.Random(2)
    variety = lambda text: quality.votes(quality.signals(text))[quality.LABELLERS.index("variety")]
    phrase = "one phrase of seven words said again "
    assert variety(phrase * times) == quality.BAD
    words = [f"w{rng.randrange(300)}" for _ in range(10 * times)]
    assert variety(" ".join(words)) == quality.GOOD


def test_scores_equal_brute_force(spark):
    """The query against votes counted in a loop, EM on all single votes, and the scorer's sum."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    votes = np.array([quality.votes(quality.signals(t)) for t in texts.values()])
    # one row per document instead of counts of patterns
    labellers = quality.fit_labellers(votes, np.ones(len(votes)))
    order = docs.selectExpr("text", "xxhash64(doc_id, text) AS h").filter("length(text) <= 50000")
    sample = [r["text"] for r in order.orderBy("h").collect()]
    x = np.stack([quality.features(t, quality.signals(t)) for t in sample])
    p = labellers.posterior(np.array([quality.votes(quality.signals(t)) for t in sample]))
    scorer = quality.fit_scorer(x, p)
    for r in quality.scored(docs).collect():
        text = texts[r["doc_id"]]
        f = quality.features(text, quality.signals(text))
        z = sum(a * b for a, b in zip(f.tolist(), scorer.weights.tolist())) + scorer.intercept
        assert r["quality"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-3)
        assert r["keep"] == (r["quality"] >= 0.5)


def test_quality_of_labelled_documents(spark):
    rows = quality.scored(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = rows.join(labels, "doc_id").select("keep", rows["quality"], labels["quality"]).toPandas()
    got.columns = ["keep", "score", "label"]
    assert (got.keep[got.label == 1] == 1).mean() > 0.98
    assert (got.keep[got.label == 0] == 0).mean() > 0.7


def _brute_kernel(a: bytes, b: bytes) -> float:
    def spread(w):
        out, norm = {}, 0.0
        for at in combinations(range(len(w)), toxicity.LENGTH):
            span = at[-1] - at[0] + 1
            if span <= toxicity.SPAN:
                u = bytes(w[i] for i in at)
                out[u] = out.get(u, 0.0) + toxicity.DECAY**span
                norm += toxicity.DECAY ** (2 * span)
        return {u: v / norm**0.5 for u, v in out.items()}

    x, y = spread(a), spread(b)
    return sum(v * y.get(u, 0.0) for u, v in x.items())


def test_kernel_is_that_of_gapped_subsequences():
    words = [toxicity.pieces(w)[0] for w in ("idiot", "idioot", "i.d.iot", "banana", "x" * 20)]
    got = toxicity.kernel(words, words)
    want = np.array([[_brute_kernel(a, b) for b in words] for a in words])
    assert np.allclose(got, want)
    assert got[0, 1] > 3 * got[0, 3]


def _texts(n, seed):
    rng = random.Random(seed)
    parts = "th er on an re he in ed nd ha at en es of or nt ti to it".split()
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(["blorgh", "snuzzak", "grumfip"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_toxic_words_are_found_with_gaps_and_insertions():
    model = toxicity.train(*_texts(400, 1))
    texts, labels = _texts(200, 2)
    assert ((model.scores(texts) >= 0.5) == np.array(labels, bool)).mean() > 0.97
    clean = texts[1]
    for word in ("snuzzak", "SNUZZAK!!", "s.n.u.z.z.a.k", "snuzzzak", "s n u z z a k", "blorrgh"):
        assert model.scores([f"{clean} {word} {clean}"])[0] >= 0.5, word
    assert model.scores(["", None, clean]).max() < 0.5


def test_folded_weights_equal_the_kernel_machine():
    model = toxicity.train(*_texts(120, 3))
    words = sorted(toxicity.words_of(" ".join(_texts(5, 4)[0])))
    parts = [p for w in words for p in toxicity.pieces(w)]
    folded = dict(zip(model.code.tolist(), model.weight.tolist()))
    want = []
    for p in parts:
        code, weight = toxicity.codes([p])
        want.append(sum(folded.get(c, 0.0) * w for c, w in zip(code[0].tolist(), weight.tolist())))
    assert np.allclose(model.margins(parts), np.array(want) + model.intercept, atol=1e-4)


def test_held_out_fold_is_that_of_the_contract(spark):
    rows = spark.range(200).withColumn("h", held_out(F.col("id")))
    for r in rows.collect():
        assert r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0)


def test_toxicity_never_learns_from_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    # labels of the held-out fold turned round change nothing
    turned = labels.withColumn(
        "toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert np.array_equal(a.code, b.code) and np.allclose(a.weight, b.weight)


@pytest.mark.parametrize("text", ["idiot", "ok", ""])
def test_scores_lie_between_0_and_1(text):
    assert 0 <= toxicity.train(*_texts(80, 5)).scores([text])[0] <= 1
