"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, base: str) -> str:
    """A column name the frame does not have yet, in any case."""
    taken = {c.lower() for c in frame.columns}
    while base.lower() in taken:
        base += "_"
    return base


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Fold 0 of `folds` by CRC-32 of the id as text; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def bounded_sample(rows: DataFrame, bound: int, total: int, *keys: str) -> DataFrame:
    """`bound` of `total` rows by the order of a hash of `keys`; all rows where there are fewer.

    Only for fitting. A filter on the hash leaves about twice the bound before the rows are
    ordered, so what is moved does not grow with the input.
    """
    order = F.xxhash64(*keys)
    if total > 2 * bound:
        rows = rows.filter(F.pmod(order, F.lit(1_000_003)) < 2 * bound * 1_000_003 // total)
    return rows.orderBy(order, *keys).limit(bound)
