"""Queries op1 to op13 over the driver tables, and SQL where it can state the result."""

from __future__ import annotations

import public_tokenizers

from meetlake.llm import (
    media,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    spelling,
    token_counts,
    topk,
    toxicity,
    urls,
    warc,
    whitening,
)
from meetlake.llm.common import table


def op1_quality(spark, sf_dir):
    """Quality of every document, and whether the classifier keeps it."""
    return quality.scored(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from labels outside the held-out fold."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate group of every document."""
    return simhash.grouped(table(spark, sf_dir, "documents"))


def op4_topk(spark, sf_dir):
    """The 20 best rows of every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(rows, topk.every_nth(rows))


def op5_warc(spark, sf_dir):
    """All pages written as an archive and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_mixing(spark, sf_dir):
    """Words taken of every document for the mix of sources."""
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    """All documents packed into sequences of 4096 tokens."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary)


def op8_urls(spark, sf_dir):
    """A verdict on every page's URL."""
    rows = urls.judged(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "host", "path", "rule", "verdict")


def op9_token_counts(spark, sf_dir):
    """Exact token counts of all documents."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.counted(table(spark, sf_dir, "documents"), vocabulary)


def op10_media(spark, sf_dir):
    """All documents stored as transport streams and read back."""
    return media.measured(media.stored(table(spark, sf_dir, "documents")))


def op11_spelling(spark, sf_dir):
    """Every word with the word it is a spelling variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    """All embeddings on their eight leading components, whitened."""
    return whitening.transformed(table(spark, sf_dir, "embeddings"))


def op13_secrets(spark, sf_dir):
    """Secrets in every document, weak ones where other parts of a credential are near."""
    return secrets.scanned(table(spark, sf_dir, "documents"))


_ALL = (
    op1_quality, op2_toxicity, op3_simhash, op4_topk, op5_warc, op6_mixing, op7_packing, op8_urls,
    op9_token_counts, op10_media, op11_spelling, op12_whitening, op13_secrets,
)
QUERIES = {q.__name__: q for q in _ALL}
SQL = {"op4_topk": topk.SQL, "op5_warc": warc.SQL, "op6_mixing": mixing.SQL, "op13_secrets": secrets.SQL}
