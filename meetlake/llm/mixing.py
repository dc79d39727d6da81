"""Mixing sources to target weights (operator 6), in DataFrame functions only.

Sources share a budget of words by weight; no source gets more than `MAX_EPOCHS` times its
own size, and what is over goes to the others by weight. The level at which this settles
has a closed form: with sources ordered by the level at which each is full, running sums of
capacities and weights give the level after every one of them, and a source is full exactly
if its own level is not above the one that would hold without it.

Documents are taken by Efraimidis-Spirakis sampling: each has the key -ln(u) / w, with u a
uniform number from a hash of its id and w the quality weight of its text, and the smallest keys
come first. Complete epochs precede the fractional one: target div size is how often every
document is taken whole, the rest of the target is filled in key order, and the document in
which it ends is cut.

No source is sorted in one task: keys fall into buckets by exp(-key * mean weight), about as
many as the source has documents by `BUCKET_ROWS`; sums per bucket tell which buckets are
below and above the budget, and running sums are taken inside (source, bucket).

Defined results: a null text has size 0 and takes 0 words; the null source is a source like any other,
ordered last; repeated rows have the same key and are taken in turn; a null id is hashed
like the empty text; no documents give no rows; without any word all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetlake.llm.common import WORD, free_name
from meetlake.session import staged

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
BUCKET_ROWS = 2000
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """0.1 to 1.1: the share of a-z and space among the characters of a text, plus a tenth."""
    other = F.length(F.regexp_replace(text, "[a-z ]", ""))
    plain = F.length(text) - other
    share = F.when(F.length(text) > 0, plain / F.length(text)).otherwise(0.0)
    return F.coalesce(share, F.lit(0.0)) + F.lit(0.1)


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the seed and the id."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_weights(sources: DataFrame) -> DataFrame:
    """(source, source_size, weight): weights repeat over the sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    return sources.withColumn("weight", F.get(cycle, place % len(WEIGHTS)))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to (source, source_size, weight), one row per source.

    One row per source meets in these windows, never the documents.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    cap = F.col("source_size") * max_epochs
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum(cap).over(before), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = sources.withColumn("level", (total - full) / left).withColumn("cap", cap)
    rows = rows.withColumn("is_full", F.col("cap") / F.col("weight") <= F.col("level"))
    # the first source that is not full sets the level of all after it
    level = F.max(F.when(~F.col("is_full"), F.col("level"))).over(Window.partitionBy())
    target = F.when(F.col("is_full"), F.col("cap").cast("double")).otherwise(
        F.least(level * F.col("weight"), F.col("cap").cast("double"))
    )
    return rows.withColumn("target", target).drop("level", "cap", "is_full")


def taken(rows: DataFrame) -> DataFrame:
    """Adds source_size, target and taken to staged rows (source, doc_id, size, w, ...)."""
    per_source = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n"), F.avg("w").alias("mean_w")
    )
    goal = staged(targets(source_weights(per_source)), "mix-targets")
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    goal = goal.withColumn("epochs", epochs.cast("bigint")).withColumn(
        "rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint")
    )
    buckets = F.ceil(F.col("n") / BUCKET_ROWS)
    named = goal.withColumnRenamed("source", "of")
    keyed = rows.join(named, rows["source"].eqNullSafe(F.col("of"))).drop("of")
    key = -F.log(uniform(F.col("doc_id"))) / F.col("w")
    keyed = keyed.withColumn("key", key).withColumn(
        "bucket", F.floor((1 - F.exp(-F.col("key") * F.col("mean_w"))) * buckets)
    )
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        F.col("source").alias("s"),
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("start"),
    )
    meets = F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = keyed.join(starts, meets).withColumn(
        "ahead", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead")))
    return placed.withColumn("taken", F.col("epochs") * F.col("size") + part)


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), taken (words)."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        quality_weight(F.col(text)).alias("w"),
    )
    return taken(staged(rows, "mix")).select("doc_id", "size", "source_size", "target", "taken")


def repeated(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """The mix itself: documents as often as taken, with all their columns.

    A document taken for a part of an epoch stands once more with its text cut after that many
    words; one taken for no words is left out.
    """
    row, take = free_name(docs, "mix_row"), free_name(docs, "mix_taken")
    size = free_name(docs, "mix_size")
    held = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    rows = held.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        quality_weight(F.col(text)).alias("w"),
        F.col(row).alias("row"),
    )
    got = taken(staged(rows, "mix")).filter("taken > 0").select(
        F.col("row").alias(row), F.col("taken").alias(take), F.col("size").alias(size)
    )
    chosen = held.join(got, row)
    copies = F.sequence(F.lit(1), F.ceil(F.col(take) / F.col(size)).cast("int"))
    turn = free_name(chosen, "mix_turn")
    copied = chosen.withColumn(turn, F.explode(copies))
    words = F.least(F.col(size), F.col(take) - (F.col(turn) - 1) * F.col(size))
    some = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(some, 1, words.cast("int")), "")
    return copied.withColumn(
        text, F.when(words < F.col(size), cut).otherwise(F.col(text))
    ).select(*docs.columns)


#: The result as DuckDB states it.
SQL = rf"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    coalesce(CASE WHEN length(text) > 0 THEN
      (length(text) - length(regexp_replace(text, '[a-z ]', '', 'g'))) / length(text)
      ELSE 0.0 END, 0.0) + 0.1 AS w,
    -ln((CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)
      AS BIGINT) + 0.5) / 4503599627370496.0) AS e
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
sw AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
l AS (
  SELECT *, 3 * source_size AS cap,
    ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (
      ORDER BY 3 * source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sw),
t AS (
  SELECT source, source_size, CASE WHEN cap / weight <= level THEN CAST(cap AS DOUBLE)
    ELSE least((SELECT max(level) FROM l WHERE cap / weight > level) * weight,
      CAST(cap AS DOUBLE)) END AS target
  FROM l),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs
  FROM t),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.epochs,
    round(g.target - g.epochs * g.source_size)::BIGINT AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.e / d.w, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, rest - ahead)))::BIGINT AS taken
FROM r
"""
