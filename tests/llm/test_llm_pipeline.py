"""The pipeline: its stages one by one, and what they must keep and remove."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meetlake.llm import jaccard, mixing, quality, simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_stages_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "toxicity", "dedup", "mixing", "packing"]

    good = stages["quality"](spark, docs, SF_DIR).cache()
    rejected = {r["doc_id"] for r in quality.scored(docs).filter("keep = 0").collect()}
    ids = lambda f: {r["doc_id"] for r in f.select("doc_id").collect()}
    assert ids(good) == ids(docs) - rejected

    mild = stages["toxicity"](spark, good, SF_DIR).cache()
    toxic = {r["doc_id"] for r in toxicity.scored(good, labels).filter("predicted = 1").collect()}
    assert ids(mild) == ids(good) - toxic

    single = stages["dedup"](spark, mild, SF_DIR).cache()
    groups = _firsts_of_groups([(r["doc_id"], r["text"]) for r in mild.collect()])
    assert ids(single) == groups and single.count() == len(groups)

    mix = stages["mixing"](spark, single, SF_DIR).cache()
    taken = mixing.mixed(single).agg(F.sum("taken")).first()[0]
    assert mix.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken

    packed = stages["packing"](spark, mix, SF_DIR)
    assert ids(packed) == ids(mix)
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096


def _grams(text):
    words = (text or "").encode().lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def _firsts_of_groups(rows):
    """Smallest id of each group of texts that links at 0.8 of their 5-word shingles reach."""
    sets = {i: _grams(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                if x == y or len(x & y) >= 0.8 * len(x | y):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {find(i) for i in sets}


def _edited(rng, words, edits, new):
    near = list(words)
    for at in rng.sample(range(len(words)), edits):
        near[at] = new()
    return near


def test_dedup_groups_equal_brute_force_of_five_words(spark):
    rng = random.Random(8)
    lexicon = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(lexicon) for _ in range(150)]
        texts.append(base)
        for edits in (1, 1, 2, 3, 4, 6, 12):
            texts.append(_edited(rng, texts[-1] if edits == 2 else base, edits, lambda: "changed"))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(200, "One two"), (201, "one TWO"), (202, None), (203, ""), (204, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["dedup"](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in got.collect()} == _firsts_of_groups(rows)


def _crowd(seed, n=260, length=120):
    """Copies of one text at 0.6 to 0.9 of each other, without the text itself; some of them in
    chains, some cut short."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    word = lambda: f"x{rng.randrange(10**6)}"
    texts = []
    for i in range(n):
        texts.append(_edited(rng, base, rng.choice((1, 2, 3, 4, 5)), word))
        if i % 5 == 0:
            texts.append(_edited(rng, texts[-1], 2, word))
        if i % 7 == 0:
            texts.append(texts[-1][: rng.randrange(90, length)])
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_a_crowd_of_near_copies_is_grouped_like_brute_force(spark, seed):
    rows = _crowd(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["dedup"](spark, docs, SF_DIR)
    want = _firsts_of_groups(rows)
    assert {r["doc_id"] for r in got.collect()} == want and 20 < len(want) < len(rows)


def _nodes(rows):
    """(fp, root, n) and (fp, hashes, bits) of rows, each a group of its own."""
    sets = [(i, jaccard.shingles(t, 5)) for i, t in rows]
    sets = [(i, s.view("int64").tolist(), jaccard.bitmap(s)) for i, s in sets]
    return [(i, i, len(s)) for i, s, _ in sets], sets


def test_no_similar_pair_is_lost_by_the_prefixes(spark):
    rows = _crowd(3, 120)
    nodes, sets = _nodes(rows)
    sets_frame = spark.createDataFrame(sets, "fp long, hashes array<long>, bits array<long>")
    for s in (0.8, 0.6, 0.95):
        found = jaccard._prefixes(spark.createDataFrame(nodes, "fp long, root long, n int"), sets_frame, s)
        got = {frozenset(p) for p in jaccard._across(found, s).collect()}
        of = {i: set(h) for i, h, _ in sets}
        want = {
            frozenset((a, b))
            for a in of for b in of
            if a < b and of[a] != of[b] and len(of[a] & of[b]) >= s * len(of[a] | of[b])
        }
        assert want <= got and want


def test_bitmaps_never_differ_more_than_their_sets():
    rows = _crowd(5, 60) + [(1000, ""), (1001, "one"), (1002, " ".join(f"w{i}" for i in range(5000)))]
    sets = [jaccard.shingles(t, 5) for _, t in rows]
    maps = [[w & 2**64 - 1 for w in jaccard.bitmap(s)] for s in sets]
    for x, p in zip(sets, maps):
        for y, q in zip(sets, maps):
            bits = sum((a ^ b).bit_count() for a, b in zip(p, q))
            assert bits <= len(set(x.tolist()) ^ set(y.tolist()))


def test_copies_that_differ_too_much_meet_nobody(spark):
    """Pairs looked at grow with the nodes, not with their square."""
    rng, pairs = random.Random(4), []
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    for n in (150, 600):
        rows = [
            (i, " ".join(_edited(rng, base, 6, lambda: f"x{rng.randrange(10**9)}"))) for i in range(n)
        ]
        nodes, sets = _nodes(rows)
        sets = spark.createDataFrame(sets, "fp long, hashes array<long>, bits array<long>")
        found = jaccard._prefixes(spark.createDataFrame(nodes, "fp long, root long, n int"), sets, 0.8)
        pairs.append(jaccard._across(found, 0.8).count())
    assert pairs[0] <= 150 and pairs[1] <= 600


def _long_near_copies():
    """Texts of 1500 words with no edit, one or two edits, and others of the same length."""
    rng = random.Random(11)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(900)}" for _ in range(1500)]
        texts += [base, *[_edited(rng, base, n, lambda: "changed") for n in (1, 1, 2, 2)]]
        texts.append(base[:750] + [f"v{rng.randrange(900)}" for _ in range(750)])
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(90, "a b"), (91, None), (92, "A b")]


def _bits(text):
    return simhash.majority(jaccard.shingle_hashes(text, 5))


def test_fingerprints_of_five_words_give_the_first_candidates(spark):
    rows = _long_near_copies()
    signed = [(i, _bits(t)) for i, t in rows]
    nodes = [(i, f - 2**64 if f >= 2**63 else f) for i, f in signed]
    met = simhash.candidates(spark.createDataFrame(nodes, "fp long, simhash long")).collect()
    bits = dict(signed)
    assert all((bits[p["a"]] ^ bits[p["b"]]).bit_count() <= 3 for p in met)
    near = [(a, b) for a in bits for b in bits if a < b and (bits[a] ^ bits[b]).bit_count() <= 3]
    assert _joined(bits, near) == _joined(bits, [(p["a"], p["b"]) for p in met])
    assert any(bits[a] != bits[b] for a, b in near) and any(bits[a] == bits[b] for a, b in near)


def _joined(ids, pairs):
    root = {i: {i} for i in ids}
    for a, b in pairs:
        if root[a] is not root[b]:
            root[a] |= root[b]
            for i in root[b]:
                root[i] = root[a]
    return {frozenset(g) for g in root.values()}


def test_links_start_from_fingerprints_and_are_checked_on_the_sets(spark):
    """Without a shared MinHash key a pair of near fingerprints still links, if its sets agree."""
    rows = [(i, t) for i, t in _long_near_copies()[:6]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = docs.select("doc_id", "text", jaccard.signatures("text", 5, simhash.majority).alias("s"))
    nodes = signed.select("s.*", "text", "doc_id").withColumn("bands", F.array().cast("array<long>"))
    ids = {r["fp"]: r["doc_id"] for r in nodes.select("fp", "doc_id").collect()}
    fps = {i: fp for fp, i in ids.items()}
    met = [(fps[0], fps[i]) for i in range(1, 6)]
    met = spark.createDataFrame(met, "a long, b long")
    got = jaccard.links(nodes, 5, 0.8, simhash.groups_of_links, met).collect()
    assert {(ids[p["a"]], ids[p["b"]]) for p in got} == {(0, i) for i in range(1, 5)}


def test_dedup_stage_runs_the_fingerprint_join(spark, monkeypatch):
    seen, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda fps: seen.append(fps) or links(fps))
    rows = _long_near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["dedup"](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in got.collect()} == _firsts_of_groups(rows)
    (fps,) = seen
    assert {r["fp"] & 2**64 - 1 for r in fps.collect()} == {_bits(t) for _, t in rows}


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]
