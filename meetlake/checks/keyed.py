"""Keyed writes, row ids and look-ups.

The stored side is a whole table; the batch is the same table with its key doubled, so
half of it meets stored rows and half of it is new.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meetlake.checks.stand_ins import stand_in, table, with_stand_ins
from meetlake.functions import text
from meetlake.operators import keyed
from meetlake.operators.lookup import academy_ids_by_name, lookup
from meetlake.plans.event_details import upsert_either
from meetlake.plans.profiles import unknown_athletes

_STORED = (
    "c_custkey + 1 AS id",
    "CAST(c_custkey AS STRING) AS external_id",
    "c_name AS name",
    "CAST(c_nationkey AS INT) AS wins",
    "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('A', CAST(c_custkey % 9 AS STRING)) END AS academy",
    "'stored' AS created",
    "concat('https://example.com/e/', CAST(c_custkey AS STRING)) AS url",
)
_BATCH = (
    "CAST(c_custkey * 2 AS STRING) AS external_id",
    "concat('new ', c_name) AS name",
    "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey % 50 AS INT) END AS wins",
    "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'B' END AS academy",
    "'batch' AS created",
)
_EITHER = (
    "CASE WHEN c_custkey % 5 = 0 THEN concat('x', CAST(c_custkey AS STRING)) "
    "ELSE CAST(c_custkey * 2 AS STRING) END AS external_id",
    "concat('new ', c_name) AS name",
    "CAST(c_custkey % 50 AS INT) AS wins",
    "'B' AS academy",
    "'batch' AS created",
    "CASE WHEN c_custkey % 5 = 0 THEN concat('https://example.com/e/', CAST(c_custkey AS STRING)) "
    "ELSE '' END AS url",
    "c_custkey AS seq",
)
_REGISTRATION = (
    "o_custkey AS athlete_id",
    "CAST(o_orderkey % 40 AS STRING) AS event_id",
    "o_orderpriority AS division",
    "o_orderstatus AS age_category",
    "'r' AS rank",
    "'w' AS weight_class",
    "o_totalprice AS actual_weight",
    "o_orderkey AS seq",
)
_KEY = ["external_id"]
_REG_KEY = ["athlete_id", "event_id", "division", "age_category", "rank", "weight_class"]


def _stored(spark, sf):
    return table(spark, sf, "customer").selectExpr(*_STORED)


def _batch(spark, sf):
    return table(spark, sf, "customer").selectExpr(*_BATCH)


def _kept_created():
    return {"id": keyed.keep, "created": keyed.keep}


def _upsert_full(spark, sf, small_batch):
    stored = _stored(spark, sf).drop("url")
    merged = keyed.upsert(
        stored, _batch(spark, sf), _KEY, _kept_created(), small_batch=small_batch
    )
    return merged.withColumn("was_stored", F.col("id").isNotNull()).drop("id")


def upsert_full(spark, sf):
    """DML-1, DML-2: the batch decides every column but id and creation mark."""
    return _upsert_full(spark, sf, False)


def upsert_small_batch(spark, sf):
    """The same by the plan for small batches, which does not shuffle the stored table."""
    return _upsert_full(spark, sf, True)


def upsert_identity(spark, sf):
    """DML-3: counters are kept, the academy only changes if the batch names one."""
    rules = _kept_created() | {
        "wins": lambda s, i, is_stored: F.when(is_stored, s).otherwise(F.lit(0)),
        "academy": lambda s, i, is_stored: F.coalesce(i, s, F.lit("")),
    }
    return keyed.upsert(_stored(spark, sf).drop("url", "id"), _batch(spark, sf), _KEY, rules)


def upsert_sparse(spark, sf):
    """DML-5: only what the batch knows is changed, and nothing is added."""
    return keyed.upsert(
        _stored(spark, sf).drop("url"),
        _batch(spark, sf).drop("created"),
        _KEY,
        {},
        default=keyed.fill,
        insert=False,
    )


def upsert_unknown(spark, sf):
    """JON-9: batch rows whose athlete is not stored."""
    return unknown_athletes(_batch(spark, sf), _stored(spark, sf))


def upsert_composite(spark, sf):
    """DML-4: last row per six-column key, merged into registrations of the same shape."""
    rows = table(spark, sf, "orders").selectExpr(*_REGISTRATION)
    stored = keyed.last_per_key(rows, _REG_KEY, ["seq"])
    moved = rows.withColumn("athlete_id", F.col("athlete_id") * 2)
    batch = keyed.last_per_key(moved, _REG_KEY, ["seq"])
    rules = {"seq": keyed.keep}
    return keyed.upsert(stored, batch, _REG_KEY, rules)


def upsert_or_key(spark, sf):
    """DML-6: match on external id or address, lowest stored id; the id text may change, but
    never to that of another stored row."""
    batch = table(spark, sf, "customer").selectExpr(*_EITHER)
    rules = {"created": keyed.keep}
    merged = upsert_either(_stored(spark, sf), batch, "external_id", "url", ["seq"], rules)
    top = table(spark, sf, "customer").agg(F.max("c_custkey") + 1).scalar()
    return merged.withColumn("stored_id", F.when(F.col("id") <= top, F.col("id"))).drop("id")


def new_ids(spark, sf):
    """Ids of a batch's new rows are dense above the stored ones."""
    ids = keyed.with_new_ids(_batch(spark, sf), _stored(spark, sf), _KEY)
    return ids.agg(
        F.count("*").alias("n_rows"),
        F.count("id").alias("n_new"),
        F.countDistinct("id").alias("n_distinct"),
        F.min("id").alias("lowest"),
        F.max("id").alias("highest"),
    )


def last_per_key(spark, sf):
    """AGG-7: last order per customer, and the last urgent one, in one aggregation."""
    order = F.struct("o_orderdate", "o_orderkey")
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.max_by("o_orderkey", order).alias("last_order"),
            F.max_by("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", order)).alias(
                "last_urgent"
            ),
        )
    )


def _named(spark, sf):
    names = F.when(F.col("p_size") % 5 == 0, "unknown club").when(F.col("p_size") % 5 == 1, None)
    rows = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") % 5 > 1, F.col("p_name")).otherwise(names).alias("academy_name")
    )
    clubs = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("x"), F.col("p_partkey")).alias("external_id"),
        F.col("p_name").alias("name"),
    )
    return rows, academy_ids_by_name(clubs)


def name_lookup(spark, sf):
    """JON-3: external id of the lowest row with the name."""
    return lookup(*_named(spark, sf), "academy_name")


def name_lookup_hot(spark, sf):
    """The same by the plan for large tables, with the names of most rows salted."""
    rows, names = _named(spark, sf)
    return lookup(
        rows, names, "academy_name", hot_rows=10, table_is_small=False, rows_are_small=False
    )


def athlete_row_ids(spark, sf):
    """JON-4: registrations get the stored athlete's row id; unknown ones have none."""
    athletes = stand_in(spark, sf, "athletes").select(
        "external_id", F.col("id").alias("athlete_id")
    )
    rows = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") * 2).cast("string").alias("external_id")
    )
    return lookup(rows, athletes, "external_id", "inner")


def fill_fields(spark, sf):
    """DML-8: a field left empty is filled from the second source."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.when(F.col("n_nationkey") % 3 > 0, F.col("n_name")).alias("n_name"),
    )
    first = F.when(F.col("c_mktsegment") == "BUILDING", "").when(
        F.col("c_mktsegment") != "MACHINERY", F.lower("c_mktsegment")
    )
    return customers.join(nations, "c_nationkey", "left").select(
        "c_custkey", text.first_filled(first, F.col("n_name")).alias("filled")
    )


QUERIES = {
    f.__name__: f
    for f in (
        upsert_full, upsert_small_batch, upsert_identity, upsert_sparse, upsert_unknown,
        upsert_composite, upsert_or_key, new_ids, last_per_key, name_lookup, name_lookup_hot,
        athlete_row_ids, fill_fields,
    )
}

_BASE = f"""
    WITH st AS (SELECT {', '.join(_STORED)} FROM customer),
        ba AS (SELECT {', '.join(_BATCH)} FROM customer)
"""
_FULL = f"""{_BASE}
    SELECT coalesce(ba.external_id, st.external_id) AS external_id,
        CASE WHEN ba.external_id IS NOT NULL THEN ba.name ELSE st.name END AS name,
        CASE WHEN ba.external_id IS NOT NULL THEN ba.wins ELSE st.wins END AS wins,
        CASE WHEN ba.external_id IS NOT NULL THEN ba.academy ELSE st.academy END AS academy,
        coalesce(st.created, ba.created) AS created, st.external_id IS NOT NULL AS was_stored
    FROM st FULL JOIN ba ON st.external_id = ba.external_id
"""
_PICK = """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'unknown club' WHEN 1 THEN NULL
    ELSE p_name END AS academy_name FROM part"""
_NAMES = f"""
    SELECT p_partkey, academy_name, found_academy_id FROM ({_PICK}) LEFT JOIN (
        SELECT p_name, concat('x', min(p_partkey)) AS found_academy_id FROM part GROUP BY p_name)
    ON academy_name = p_name
"""
_REG_KEYS = ", ".join(_REG_KEY)


def _last_registrations(factor: int) -> str:
    return f"""SELECT {_REG_KEYS}, arg_max(actual_weight, seq) AS actual_weight, max(seq) AS seq
        FROM (SELECT {', '.join(_REGISTRATION).replace('o_custkey AS', f'o_custkey * {factor} AS')}
            FROM orders) GROUP BY {_REG_KEYS}"""


SQL = {
    "upsert_full": _FULL,
    "upsert_small_batch": _FULL,
    "upsert_identity": f"""{_BASE}
        SELECT coalesce(ba.external_id, st.external_id) AS external_id,
            coalesce(ba.name, st.name) AS name,
            CASE WHEN st.external_id IS NOT NULL THEN st.wins ELSE 0 END AS wins,
            coalesce(ba.academy, st.academy, '') AS academy,
            coalesce(st.created, ba.created) AS created
        FROM st FULL JOIN ba ON st.external_id = ba.external_id""",
    "upsert_sparse": f"""{_BASE}
        SELECT st.id, st.external_id, coalesce(ba.name, st.name) AS name,
            coalesce(ba.wins, st.wins) AS wins, coalesce(ba.academy, st.academy) AS academy,
            st.created
        FROM st LEFT JOIN ba ON st.external_id = ba.external_id""",
    "upsert_unknown": f"""{_BASE}
        SELECT external_id FROM ba WHERE external_id NOT IN (SELECT external_id FROM st)""",
    "upsert_composite": f"""
        SELECT {_REG_KEYS}, coalesce(b.actual_weight, s.actual_weight) AS actual_weight,
            coalesce(s.seq, b.seq) AS seq
        FROM ({_last_registrations(1)}) s FULL JOIN ({_last_registrations(2)}) b
        USING ({_REG_KEYS})""",
    "upsert_or_key": f"""
        WITH st AS (SELECT {', '.join(_STORED)} FROM customer),
            ba AS (SELECT {', '.join(_EITHER)} FROM customer),
            found AS (SELECT ba.*, (SELECT min(id) FROM st WHERE st.external_id = ba.external_id
                OR (ba.url <> '' AND st.url = ba.url)) AS target FROM ba),
            aimed AS (SELECT * FROM found WHERE NOT EXISTS (SELECT 1 FROM st
                WHERE st.external_id = found.external_id AND st.id <> found.target)),
            hit AS (SELECT * FROM aimed WHERE target IS NOT NULL
                QUALIFY row_number() OVER (PARTITION BY target ORDER BY seq DESC) = 1)
        SELECT st.id AS stored_id, coalesce(hit.external_id, st.external_id) AS external_id,
            coalesce(hit.name, st.name) AS name, coalesce(hit.wins, st.wins) AS wins,
            coalesce(hit.academy, st.academy) AS academy, st.created,
            coalesce(hit.url, st.url) AS url
        FROM st LEFT JOIN hit ON hit.target = st.id
        UNION ALL
        SELECT NULL, external_id, name, wins, academy, created, url FROM aimed
        WHERE target IS NULL""",
    "new_ids": f"""{_BASE}
        SELECT count(*) AS n_rows, count(n) AS n_new, count(n) AS n_distinct,
            max(top) + 1 AS lowest, max(top) + count(n) AS highest
        FROM (SELECT (SELECT max(id) FROM st) AS top,
            CASE WHEN external_id NOT IN (SELECT external_id FROM st) THEN 1 END AS n FROM ba)""",
    "last_per_key": """
        SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
            arg_max(o_orderkey, (o_orderdate, o_orderkey))
                FILTER (WHERE o_orderpriority = '1-URGENT') AS last_urgent
        FROM orders GROUP BY o_custkey""",
    "name_lookup": _NAMES,
    "name_lookup_hot": _NAMES,
    "athlete_row_ids": with_stand_ins(
        """SELECT o_orderkey, external_id, id AS athlete_id FROM orders
        JOIN athletes ON external_id = CAST(o_custkey * 2 AS STRING)""",
        "athletes",
    ),
    "fill_fields": """
        SELECT c_custkey, coalesce(
            nullif(CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL
                ELSE lower(c_mktsegment) END, ''),
            CASE WHEN n_nationkey % 3 > 0 THEN n_name END, '') AS filled
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
}
