"""Bounded samples, chosen by hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def first_of_groups(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first n rows of each group by ``order``, a hash.

    A group is first cut to n rows in each of SALTS parts: its last ranking sees a
    bounded number of rows, however many tasks and rows it has.
    """
    part = F.pmod(F.col(order), F.lit(SALTS))
    for keys in ([group, "_part"], [group]):
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
        rows = rows.withColumn("_part", part).withColumn("_number", number)
        rows = rows.filter(F.col("_number") <= n).drop("_part", "_number")
    return rows


def share_by_hash(rows: DataFrame, key: str, n: int, number: int) -> DataFrame:
    """About n of the ``number`` rows, all if there are no more: those whose hash of
    ``key``, which has each value once, is low. No row is sorted or moved, and the
    chance that one is taken does not depend on its place."""
    if number <= n:
        return rows
    bound = -(1 << 63) + (n << 64) // number
    return rows.filter(F.xxhash64(key) < F.lit(bound))
