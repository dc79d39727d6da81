"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for all."""

from __future__ import annotations

import public_tokenizers
import pytest
from llm_fixtures import ROWS, clashing, documents

import corpus_pipeline
from meetlake.llm import media, mixing, packing, quality, simhash, token_counts, topk, toxicity
from meetlake.llm import urls, warc

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def _labels(spark, rows=((1, 1, 0), (5, 1, 1), (None, 0, 1), (7, None, None))):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


PER_ROW = {
    "quality": lambda s, d: quality.scored(d),
    "toxicity": lambda s, d: toxicity.scored(d, _labels(s)),
    "simhash": lambda s, d: simhash.grouped(d),
    "mixing": lambda s, d: mixing.mixed(d),
    "tokens": lambda s, d: token_counts.counted(d, BYTES),
    "media": lambda s, d: media.measured(media.stored(d)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_result_per_row(spark, name):
    got = PER_ROW[name](spark, clashing(documents(spark))).collect()
    key = lambda i: (i is None, i)
    assert sorted((r["doc_id"] for r in got), key=key) == sorted((r[0] for r in ROWS), key=key)
    same = {tuple(r) for r in got if r["doc_id"] == 4}
    assert len(same) == (1 if name != "mixing" else len(same))


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](spark, documents(spark, [])).collect() == []


def test_no_documents_but_labels_gives_neutral_scores(spark):
    got = toxicity.scored(documents(spark), _labels(spark, [])).collect()
    assert {r["predicted"] for r in got} == {0} and all(0 <= r["score"] <= 1 for r in got)


def test_packing_edges(spark):
    got = packing.packed(clashing(documents(spark)), WORDS).collect()
    assert {r["doc_id"] for r in got} == {r[0] for r in ROWS}
    assert {r["doc_tokens"] for r in got if r["doc_id"] in (2, 3)} == {1}
    assert packing.packed(documents(spark, []), WORDS).collect() == []


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "packing"])
def test_stages_keep_columns(spark, tmp_path, stage):
    _labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = clashing(documents(spark))
    got = stage[1](spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert {r["score"] for r in got.collect()} <= {"own score"}
    assert stage[1](spark, docs.limit(0), str(tmp_path)).collect() == []


def test_dedup_keeps_one_row_of_each_group(spark):
    groups = {r["component_id"] for r in simhash.grouped(documents(spark)).collect()}
    kept = simhash.kept(documents(spark)).collect()
    assert len(kept) == len(groups)
    assert {r["doc_id"] for r in kept} == groups


def test_vectors_and_pages_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (20, [1.0, 0.5]), (40, None), (60, [nan, 1.0]), (1, [None, 1.0]),
            (None, [1.0, 1.0]), (2, []), (3, [2.0]), (0, [1.0, 0.5])]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr(
        "*", "'x' as score", "1 as rank", "2 as v"
    )
    got = topk.search(v, topk.every_nth(v)).collect()
    assert sorted(map(tuple, got)) == [
        (0, 1, 3, 64 * 128), (0, 2, 20, 64 * 64 + 32 * 32), (0, 3, 2, 0),
        (20, 1, 3, 64 * 128), (20, 2, 0, 64 * 64 + 32 * 32), (20, 3, 2, 0),
    ]
    assert topk.search(v.limit(0), v.limit(0)).collect() == []

    pages = spark.createDataFrame(
        [(1, None, None), (2, "nothing", ""), (3, "http://A.Example.COM", "x" * 100),
         (5, "http://e.org/es/\r\n?a=1", "x" * 100), (None, "http://e.net/de/8#t", "x" * 100),
         (3, "http://A.Example.COM", "x" * 100), (6, "q://h?x", "x" * 99), (7, "q://h", "x" * 99)],
        "page_id bigint, url string, html string",
    ).selectExpr("*", "1 as digest", "'h' as host", "'b' as body")
    back = warc.round_trip(pages).collect()
    assert len(back) == 8
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"] or 0) for r in back)
    assert kinds == [
        (-1, "revisit", 3), (1, "response", 0), (2, "response", 0), (3, "response", 0),
        (3, "revisit", 3), (5, "revisit", 3), (6, "response", 0), (7, "response", 0),
    ]
    assert {r["payload_bytes"] for r in back if r["page_id"] in (3, 5, None)} == {100}
    assert warc.round_trip(pages.limit(0)).collect() == []

    judged = {r["page_id"]: r for r in urls.judged(pages).collect()}
    assert judged[1]["host"] == "" and judged[2]["path"] == "" and judged[1]["rule"] is None
    assert judged[3]["host"] == "a.example.com"
    assert judged[5]["rule"] == "org/es/" and judged[5]["verdict"] == "block"
    assert judged[5]["path"] == "/es/\r\n"
    assert judged[None]["rule"] == "net/de/"
    assert {r["verdict"] for r in judged.values()} <= {"allow", "block"}
    assert urls.judged(pages.limit(0)).collect() == []
