"""Keyed writes: last row per key, upsert with per-column rules, ids for new rows.

Spark sees each upsert as one declarative plan. A batch whose size is known to be small
is broadcast and the stored table is not shuffled at all; any other batch meets it in a
full outer join on the key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetlake.session import estimated_bytes, staged

Rule = Callable[[Column, Column, Column], Column]
"""(stored value, incoming value, "row is stored") -> value of a row that is in the batch."""

BROADCAST_BYTES = 16 * 1024 * 1024
ID_BUCKETS = 4096


def replace(stored: Column, incoming: Column, is_stored: Column) -> Column:
    """The batch wins."""
    return incoming


def keep(stored: Column, incoming: Column, is_stored: Column) -> Column:
    """The stored value wins; the batch fills new rows."""
    return F.when(is_stored, stored).otherwise(incoming)


def fill(stored: Column, incoming: Column, is_stored: Column) -> Column:
    """The batch wins where it has a value."""
    return F.coalesce(incoming, stored)


@dataclass(frozen=True)
class Merge:
    """How a batch changes an entity table: its key, and what becomes of each column.

    The one statement of a keyed write, for `merged` frames and for a catalog's own MERGE.
    """

    table: str
    keys: tuple[str, ...]
    rules: dict[str, Rule]
    default: Rule = replace
    insert: bool = True

    def rule(self, column: str) -> Rule:
        return self.rules.get(column, self.default)

    def clauses(
        self, stored: DataFrame, given: DataFrame, target: str, source: str
    ) -> tuple[dict[str, Column], dict[str, Column]]:
        """Assignments of WHEN MATCHED and of WHEN NOT MATCHED; a column the batch lacks is null
        in it. `target` and `source` qualify the columns of both sides."""
        update, insert = {}, {}
        for column, kind in stored.dtypes:
            nothing = F.lit(None).cast(kind)
            old = F.col(f"{target}.{column}")
            new = F.col(f"{source}.{column}").cast(kind) if column in given.columns else nothing
            if column in self.keys:
                insert[column] = new
                continue
            update[column] = self.rule(column)(old, new, F.lit(True)).cast(kind)
            insert[column] = self.rule(column)(nothing, new, F.lit(False)).cast(kind)
        return update, insert


def is_small(frame: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = estimated_bytes(frame)
    return size is not None and size <= limit


def content_hash(rows: DataFrame, columns: list[str]) -> Column:
    """A number made of the values of columns, to order rows that are equal otherwise."""
    kinds = dict(rows.dtypes)
    plain = [c for c in columns if "map<" not in kinds[c] and "variant" not in kinds[c]]
    return F.xxhash64(*plain) if plain else F.lit(0)


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the given order (AGG-7), ties by content.

    An aggregation, so each task sends at most one row per key, however hot the key.
    """
    values = [c for c in rows.columns if c not in keys]
    turn = F.struct(*order, content_hash(rows, values).alias("_tie"))
    picked = F.max_by(F.struct(*values), turn).alias("_row")
    return rows.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*rows.columns)


def not_stored(
    incoming: DataFrame, stored: DataFrame, keys: list[str], small_batch: bool | None = None
) -> DataFrame:
    """Batch rows whose key is not stored (JON-9).

    For a small batch the stored keys are first cut down to those of the batch, which are
    no more than its rows, so the stored table is only scanned.
    """
    known = stored.select(*keys)
    if small_batch is None:
        small_batch = is_small(incoming)
    if small_batch:
        met = known.join(F.broadcast(incoming.select(*keys)), keys, "left_semi")
        known = F.broadcast(met)
    return incoming.join(known, keys, "left_anti")


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    rules: dict[str, Rule],
    default: Rule = replace,
    insert: bool = True,
    small_batch: bool | None = None,
    new_if: str | None = None,
) -> DataFrame:
    """Stored rows with a batch merged in on the key (JON-5).

    `incoming` holds each key once. Columns it lacks are null in it, so they want the
    rule `keep` or `fill`. `insert=False` drops batch rows without a stored row. `new_if`
    names a column of the batch that is set for rows known to be new, see `with_new_ids`;
    the stored keys are then not searched again for them.
    """
    values = [c for c in stored.columns if c not in keys]
    types = dict(stored.dtypes)
    given = set(incoming.columns)
    left = stored.select(
        *keys, *[F.col(c).alias(f"s_{c}") for c in values], F.lit(True).alias("is_stored")
    )
    right = incoming.select(
        *keys,
        *[
            (F.col(c) if c in given else F.lit(None)).cast(types[c]).alias(f"i_{c}")
            for c in values
        ],
        F.lit(True).alias("is_given"),
        (F.col(new_if).isNotNull() if new_if else F.lit(None)).alias("is_new"),
    )
    if small_batch is None:
        small_batch = is_small(incoming)

    def merged(rows):
        is_stored = F.coalesce(F.col("is_stored"), F.lit(False))
        is_given = F.coalesce(F.col("is_given"), F.lit(False))
        return rows.select(
            *keys,
            *[
                F.when(
                    is_given,
                    rules.get(c, default)(F.col(f"s_{c}"), F.col(f"i_{c}"), is_stored),
                )
                .otherwise(F.col(f"s_{c}"))
                .alias(c)
                for c in values
            ],
        ).select(*stored.columns)

    if not small_batch:
        return merged(left.join(right, keys, "full_outer" if insert else "left"))

    kept = merged(left.join(F.broadcast(right), keys, "left"))
    if not insert:
        return kept
    blanks = [F.lit(None).cast(types[c]).alias(f"s_{c}") for c in values]
    fresh = right.filter("is_new") if new_if else not_stored(right, stored, keys, True)
    return kept.unionByName(
        merged(fresh.select("*", *blanks, F.lit(False).alias("is_stored")))
    )


def with_new_ids(
    incoming: DataFrame,
    stored: DataFrame,
    keys: list[str],
    id_column: str = "id",
    top: int | None = None,
) -> DataFrame:
    """Batch with dense ids for its new keys, null for stored ones.

    New keys are numbered inside hash buckets, and each bucket starts where the ones
    before it end: no task sees more than its buckets, and the only thing broadcast is
    one row per bucket. The ids depend on the keys alone, so a retried task gives the
    same ones. The new keys are staged, as finding them goes over all stored keys.
    They go on from `top`; without it from the largest id in `stored`, which is then scanned.
    """
    fresh = staged(not_stored(incoming.select(*keys), stored, keys), "new-keys")
    fresh = fresh.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(ID_BUCKETS)).cast("int"))
    sizes = fresh.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # at most ID_BUCKETS rows meet in this window
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    known = F.lit(top) if top is not None else stored.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    numbered = (
        fresh.join(F.broadcast(starts), "_bucket")
        .withColumn("_rank", in_bucket)
        .select(*keys, (known + F.col("_start") + F.col("_rank")).cast("bigint").alias(id_column))
    )
    return incoming.drop(id_column).join(numbered, keys, "left")
