"""Token counts, packing, mixing and URLs against the library, brute force and SQL."""

from __future__ import annotations

import random
import re
import tracemalloc
import zlib
from collections import defaultdict
from itertools import product

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import ROWS, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meetlake.llm import mixing, packing, token_counts, urls

SF_DIR = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a  b", "a   b\n\n c", "x \n y", "<|endoftext|>a <|endoftext|> b", "<|ENDOFTEXT|> A", "it's they'll  ",
    " é　漢字 🙂🙂", "a\x1cb \x85 c", "tab\there\n\n\n  z", "ΣΑΣ ΣΣ.", "İI", " lead", "trail ",
    "\n\nx", "0123 45678,90", "e\u0301 \u0301a",
]


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(BYTES)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTES)


def _texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()
    return [r["text"] for r in rows] + ODD


def test_counts_equal_the_library(spark, counter, byte_library):
    for t in _texts(spark):
        assert counter.count(t) == len(byte_library.encode(t, add_special_tokens=False).ids), t


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_counts_of_any_text(text):
    one, library = token_counts.PrefixCounter(BYTES), Tokenizer.from_file(BYTES)
    text = text.encode("utf-8", "ignore").decode()
    assert one.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_of_a_part_is_exact(counter, byte_library):
    for word in ("antidisestablishmentarianism", " thtionheringed", "aaaaaaaaaaaa", "!!!!!!?!"):
        part = word.replace(" ", "Ġ")
        got = counter.part_counts(part)
        want = [len(byte_library.encode(word[:i], add_special_tokens=False).ids) for i in range(len(word) + 1)]
        assert got == want


def _runs(n):
    """Unbroken runs of n characters: letters, digits, marks, and text without blanks or marks."""
    rng = np.random.default_rng(9)
    return {
        name: "".join(rng.choice(list(signs), n))
        for name, signs in (("letters", "etaoinshrdlu"), ("digits", "0123456789"), ("marks", "-=#*!?."), ("cjk", "的一是不了人"))
    } | {"same letter": "a" * n, "same mark": "-" * n, "words": ("thetionher" * n)[:n]}


@pytest.mark.parametrize("name", _runs(1))
def test_long_runs_equal_the_library(byte_library, name):
    run, one = _runs(200_000)[name], token_counts.PrefixCounter(BYTES)
    assert one.count(f"a {run} b") == len(byte_library.encode(f"a {run} b", add_special_tokens=False).ids)
    assert max(map(len, [*one.states, *one.totals, *one.chunks])) <= token_counts.CACHED_SYMBOLS


def test_memory_is_linear_in_a_run(counter):
    tracemalloc.start()
    counter.count(_runs(10_000)["letters"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5_000_000  # all prefixes as strings: 50 MB and more


def test_prefixes_of_a_long_run_are_exact(counter, byte_library):
    run = _runs(3_000)["letters"]
    got = counter.part_counts(run)
    for i in (1, 63, 64, 65, 500, 2_999, 3_000):
        assert got[i] == len(byte_library.encode(run[:i], add_special_tokens=False).ids)


def test_pairs_by_rank_equal_merging(counter):
    """What the seam tells of two tokens is what merging both from their symbols gives."""
    rng = random.Random(6)
    tokens = [t for t in counter.vocab if len(t) < 12]
    same = [("\u0120" * i, "\u0120" * j) for i in (1, 2, 3, 4) for j in (1, 2, 3, 4)]
    doubled = [(t, t) for t in rng.sample(tokens, 400)]
    pairs = [tuple(rng.sample(tokens, 2)) for _ in range(6000)] + same + doubled
    pairs += [(t[:i], t[i:]) for t in rng.sample(tokens, 800) for i in range(1, len(t))]
    seen = set()
    for a, b in pairs:
        if a in counter.vocab and b in counter.vocab and counter.follows("", a) and counter.follows("", b):
            want = counter.merged(list(a + b)) == [a, b]
            assert counter.follows(a, b) == want, (a, b)
            seen.add(want)
    assert seen == {True, False}
    for t in rng.sample(tokens, 500):
        assert counter.follows("", t) == (counter.merged(list(t)) == [t])


def test_budget_questions(counter):
    text = "the thing of heatherington\nand more"
    pairs = counter.prefix_counts(text)
    assert pairs[-1] == (len(text), counter.count(text))
    for budget in range(8):
        n = counter.fitting_bytes(text, budget)
        assert counter.count(text[:n]) <= budget


def test_ids_of_words_equal_the_library(spark):
    ids, library = packing.WordIds(WORDS, cached=500), Tokenizer.from_file(WORDS)
    for t in _texts(spark):
        assert ids(t).tolist() == library.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 40), st.dictionaries(st.integers(1, 20), st.integers(1, 3), max_size=4))
def test_fullest_is_the_closest_filling(room, left):
    chosen = packing.fullest(room, left)
    assert all(chosen[k] <= left[k] for k in chosen)
    sums = [
        sum(k * n for k, n in zip(left, times))
        for times in product(*[range(n + 1) for n in left.values()])
    ]
    assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)


def test_plan_uses_every_piece_and_does_not_grow_with_their_number():
    rng = np.random.default_rng(2)
    counts = {int(k): int(n) for k, n in zip(rng.choice(4096, 500, False) + 1, rng.integers(1, 900, 500))}
    plan = packing.plan(counts)
    used = defaultdict(int)
    for p in plan:
        assert sum(k * n for k, n in p.parts) <= 4096
        for k, n in p.parts:
            used[k] += n * p.uses
    assert dict(used) == counts
    many = packing.plan({k: n * 10_000 for k, n in counts.items()})
    assert len(many) < 3 * len(plan) + 100
    windows = sum(p.uses for p in plan)
    assert windows * 4096 < 1.02 * sum(k * n for k, n in counts.items()) + 4096


@pytest.mark.parametrize("bucket", [20_000, 3])
def test_packing_holds_every_id_once(spark, monkeypatch, bucket):
    monkeypatch.setattr(packing, "BUCKET_ROWS", bucket)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = packing.packed(docs, WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for d in docs.collect():
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by_doc[d["doc_id"]], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], dtype="<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 4096


def _mix_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    return con.execute(mixing.SQL).fetchall()


@pytest.mark.parametrize("bucket", [2000, 2])
def test_mix_equals_sql(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = ROWS + [(100 + i, "of the and " * (i % 9), "en", "big") for i in range(60)]
    got = mixing.mixed(documents(spark, rows)).collect()
    order = lambda r: tuple((v is None, v) for v in r)
    want = sorted((tuple(map(lambda v: round(v, 6) if v is not None else v, r)) for r in _mix_sql(rows)), key=order)
    have = sorted((tuple(map(lambda v: round(v, 6) if v is not None else v, r)) for r in got), key=order)
    assert have == want
    by_source = defaultdict(lambda: [0, 0.0])
    sources = {r[0]: r[3] for r in rows}
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        by_source[sources[r["doc_id"]]][0] += r["taken"]
        by_source[sources[r["doc_id"]]][1] = r["target"]
    for words, target in by_source.values():
        assert abs(words - target) <= 1


def test_targets_share_all_words_and_stop_at_three_epochs(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 20), (None, 5), ("d", 0), ("e", 3000)]
    frame = spark.createDataFrame(sizes, "source string, source_size bigint")
    got = {r["source"]: r for r in mixing.targets(mixing.source_weights(frame)).collect()}
    assert abs(sum(r["target"] for r in got.values()) - 4035) < 1e-6
    assert all(r["target"] <= 3 * r["source_size"] + 1e-9 for r in got.values())
    assert [got[s]["weight"] for s in ("a", "b", "c", "d", "e", None)] == [1, 2, 3, 1, 2, 3]
    # the two that are not full share by weight
    assert got["a"]["target"] == 30 and got["b"]["target"] / got["e"]["target"] == pytest.approx(1.0)


def test_repeated_documents_are_those_taken(spark):
    docs = documents(spark)
    taken = sum(r["taken"] for r in mixing.mixed(docs).collect())
    words = mixing.repeated(docs).select(mixing.word_count(F.col("text")).alias("n")).collect()
    assert sum(r["n"] for r in words) == taken
    for r in mixing.repeated(docs).collect():
        assert r["text"].strip()


def test_no_python_in_the_mix(spark):
    plan = mixing.mixed(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def _parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    best = None
    for r in urls.RULES:
        name, rest = r.text.split("/", 1)
        fits = (host == name or host.endswith("." + name)) and path.startswith("/" + rest)
        if fits and (best is None or len(r.text) > len(best.text)):
            best = r
    return best


def test_verdicts_follow_rules_and_trees(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = ["x", None, "a://", "a://B.COM/en/", "://com/en/7", "a://example.com/en/7x", "a://q.net/de/8",
           "a://example.net/de/8?x", "a://notcom/en/", "a://h#/en/://z", "É://É.ORG/es/"]
    extra = spark.createDataFrame([(10**6 + i, u, None) for i, u in enumerate(odd)], pages.schema)
    both = pages.unionByName(extra)
    of = {r["page_id"]: r["url"] for r in both.collect()}
    got = urls.judged(both).collect()
    assert len(got) == len(of)
    for r in got:
        host, path = _parsed(of[r["page_id"]])
        rule = _rule(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule.text if rule else None)
        if rule:
            assert r["verdict"] == rule.verdict
    again = {r["page_id"]: r["verdict"] for r in urls.judged(both).collect()}
    assert again == {r["page_id"]: r["verdict"] for r in got}


def test_statistics_leave_out_a_row_and_its_copies(spark):
    """Shares per key by a loop over all other folds; a key only copies have says nothing."""
    rows = [(f"http://h{i % 7}.example.{'com' if i % 3 else 'org'}/a{i % 4}/{i}", i % 5 and float(i % 2)) for i in range(120)]
    rows = [(u, None if y == 0 and i % 5 == 0 else float(y)) for i, (u, y) in enumerate(rows)]
    rows += [("http://alone.test/zz/1", 1.0)] * 9 + [("http://alone.test/zz/2", None)]
    frame = spark.createDataFrame(rows, "url string, label double")
    host, path = urls.host_and_path(F.col("url"))
    frame = urls.lexical(frame.withColumn("host", host).withColumn("path", path))
    fold = F.pmod(F.xxhash64("url"), F.lit(urls.FOLDS)).alias("f")
    plain = frame.select("url", "label", *urls.SUFFIXES, fold).collect()
    for r in urls.rated(frame, 0.3).collect():
        f = next(p["f"] for p in plain if p["url"] == r["url"])
        for key in urls.SUFFIXES:
            same = [p for p in plain if p[key] == r[key] and p["label"] is not None]
            if r["label"] is not None:
                same = [p for p in same if p["f"] != f]
            want = (sum(p["label"] for p in same) + 0.3 * 5) / (len(same) + 5)
            assert r[f"{key}_rate"] == pytest.approx(want)
        if r["url"].endswith("zz/1"):
            assert r["suffix_rate"] == pytest.approx(0.3)


def test_a_withheld_rule_is_learned_from_the_others(spark):
    """Trees that never saw a rule's own labels: how they judge its URLs."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    whole = {r["page_id"]: r for r in urls.judged(pages).collect()}
    rule = next(r for r in urls.RULES if r.text == "org/es/")
    rest = tuple(r for r in urls.RULES if r != rule)
    got = {r["page_id"]: r for r in urls.judged(pages, rest).collect()}
    mine = [i for i, r in whole.items() if r["rule"] == rule.text]
    assert mine and all(got[i]["rule"] is None and got[i]["score"] is not None for i in mine)
    kept = [i for i, r in whole.items() if r["rule"] not in (None, rule.text)]
    assert all(got[i]["verdict"] == whole[i]["verdict"] for i in kept)


def test_trees_learn_the_labels(spark):
    """URLs whose rules are withheld get the verdict of URLs like them."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    full = {r["page_id"]: r for r in urls.judged(pages).collect()}
    hidden = {i for i, r in full.items() if r["rule"] == "org/es/" and i % 2}


    masked = pages.withColumn(
        "url",
        F.when(F.col("page_id").isin(sorted(hidden)), F.regexp_replace("url", r"\.org/es/", ".org/es-x/")).otherwise(
            F.col("url")
        ),
    )
    got = {r["page_id"]: r["verdict"] for r in urls.judged(masked).collect()}
    assert np.mean([got[i] == "block" for i in hidden]) > 0.5
