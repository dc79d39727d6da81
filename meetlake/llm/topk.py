"""Exact top-k inner-product search by a three-phase uniform threshold (operator 4).

The dimensions are dealt to `LISTS` lists; the score of a candidate is the sum of its
partial scores over the lists. Phase 1 gathers, per query and list, the k best partial
scores of every block of candidates and sums up the candidates seen; the k-th best sum is a lower bound t
of the true k-th score. Phase 2 sends t with its query to all blocks: a candidate of score t
or more must reach t / lists in at least one list, so every list hands in its entries from
that cutoff on, and candidates whose upper bound (entries seen, the cutoff for those not
seen) stays below t are let go. Phase 3 resolves the scores of the remaining ones exactly.
Nothing is approximate, and no block hands on more than k candidates of a query.

Queries and candidates meet as blocks of at most `QUERY_ROWS` and `VECTOR_ROWS` rows on average (by hash), so memory does not
depend on the table; a block of queries is sent to each block of candidates.

Defined results: vectors that are null or hold null or non-finite components take no part;
a vector shorter than the longest counts as padded with zeros; rows are named by vec_id, and of
several rows with one id the smallest vector counts; a null id takes no part; ties go to the
smaller id; with fewer candidates than k all are given; without candidates a query gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetlake.session import staged

K, LISTS, SCALE = 20, 2, 64
QUERY_EVERY = 20
QUERY_ROWS, VECTOR_ROWS = 512, 8192
_EXACT = 2.0**53


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as whole numbers; null if one is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(
        wide,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale)))))


def usable(rows: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): one row per id that takes part, with whole components."""
    named = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), scaled(F.col(vector), scale).alias("v"))
    named = named.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    return named.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


class _Block:
    """A block of queries against a block of candidates."""

    def __init__(self, queries: pd.DataFrame, vectors: pd.DataFrame, lists: int):
        # by id, so that a stable order of scores breaks ties to the smaller one
        self.vectors = vectors.sort_values("vec_id", ignore_index=True)
        self.queries = queries
        self.ids = self.vectors["vec_id"].to_numpy(np.int64)
        self.query_ids = queries["vec_id"].to_numpy(np.int64)
        width = max([*map(len, queries["v"]), *map(len, self.vectors["v"]), 1])
        q, x = _matrix(queries["v"], width), _matrix(self.vectors["v"], width)
        largest = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width
        if largest >= _EXACT:  # beyond what doubles hold exactly
            q, x = q.astype(np.int64), x.astype(np.int64)
        cuts = np.linspace(0, width, lists + 1).astype(int)
        self.partial = [q[:, a:b] @ x[:, a:b].T for a, b in zip(cuts, cuts[1:])]
        self.own = self.query_ids[:, None] == self.ids[None, :]

    def best(self, i: int, candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of some candidates of query i and their exact scores."""
        score = sum(p[i, candidates] for p in self.partial).astype(np.int64)
        order = np.lexsort((self.ids[candidates], -score))[:k]
        return candidates[order], score[order]

    def seen(self, k: int):
        """Phase 1: per query the sums of the k best entries of every list."""
        for i in range(len(self.query_ids)):
            free = np.flatnonzero(~self.own[i])
            tops = [
                free if len(free) <= k else free[np.argpartition(-p[i, free], k - 1)[:k]]
                for p in self.partial
            ]
            yield i, *self.best(i, np.unique(np.concatenate(tops)), k)

    def sufficient(self, k: int):
        """Phases 2 and 3: per query the best of all candidates that may reach its bound."""
        bounds = self.queries["bound"].to_numpy(np.float64)
        for i, bound in enumerate(bounds):
            cut = bound / len(self.partial)
            rows = [p[i] for p in self.partial]
            entries = np.logical_or.reduce([r >= cut for r in rows]) & ~self.own[i]
            found = np.flatnonzero(entries)
            upper = sum(np.maximum(r[found], cut) for r in rows)
            yield i, *self.best(i, found[upper >= bound], k)


def search(
    rows: DataFrame, queries: DataFrame, k: int = K, lists: int = LISTS, vec_id="vec_id",
    vector="embedding", scale: int = SCALE,
) -> DataFrame:
    """Per query its k best rows: query_id, rank, vec_id, score. Both sides: vec_id, vector."""
    space = staged(usable(rows, vec_id, vector, scale), "vectors")
    asked = staged(usable(queries, vec_id, vector, scale), "queries")
    blocks = max(1, -(-space.count() // VECTOR_ROWS))
    query_blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    there = space.withColumn("cb", block(blocks)).select(
        "vec_id", "v", "cb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb")
    )

    def met(questions: DataFrame, phase: str) -> DataFrame:
        sent = questions.withColumn("qb", block(query_blocks)).withColumn(
            "cb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        )

        def meet(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(q) and len(x):
                b = _Block(q, x, lists)
                for i, at, score in b.seen(k) if phase == "seen" else b.sufficient(k):
                    out.append(
                        pd.DataFrame(
                            {"query_id": b.query_ids[i], "vec_id": b.ids[at], "score": score}
                        )
                    )
            if not out:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
            return pd.concat(out, ignore_index=True)

        grouped = sent.groupBy("qb", "cb").cogroup(there.groupBy("qb", "cb"))
        return grouped.applyInPandas(meet, "query_id bigint, vec_id bigint, score bigint")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    seen = met(asked, "seen").withColumn("rank", F.row_number().over(best))
    # the k-th best sum; with fewer candidates than k nothing may be let go
    bounds = seen.groupBy("query_id").agg(F.min(F.when(F.col("rank") == k, F.col("score"))).alias("b"))
    low = F.coalesce(F.col("b").cast("double"), F.lit(float("-inf")))
    bounds = staged(bounds.select(F.col("query_id").alias("vec_id"), low.alias("bound")), "bounds")
    found = met(asked.join(bounds, "vec_id"), "sufficient")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def every_nth(rows: DataFrame, n: int = QUERY_EVERY, vec_id: str = "vec_id") -> DataFrame:
    """The stated queries: rows whose id is divisible by n."""
    return rows.filter(F.col(vec_id) % n == 0)


#: The result as DuckDB states it.
SQL = f"""
WITH f AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT))
    AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT)
      AS score
  FROM f q JOIN f c ON q.vec_id % {QUERY_EVERY} = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= {K}
"""
