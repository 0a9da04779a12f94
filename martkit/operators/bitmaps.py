"""Exact distinct counts that roll up: one stored aggregate answers every context over its keys.

A distinct count cannot be added up, a set can be united.  Keys get dense numbers (their places in one order), and the set of
a group is kept as bitmaps of fixed size, one per stretch of numbers, so no group is ever one large value: a group with a
third of all keys is as many rows as any other of its size.  Any coarser grouping is a union of bitmaps.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .keys import dealt
from .ordered import in_order, number_in_order


def distinct_sets(rows: DataFrame, key: str, by: Sequence[str], n: int | None = None) -> DataFrame:
    """``by``, bucket and bits: the keys of each group, stored.  Rows without a key have none to count.

    Rows are dealt by what they are grouped by, for as many rows as ``n`` says (by default they are counted): a task holds
    a bounded number of them, and no bitmap travels.
    """
    n = rows.count() if n is None else n
    pairs = dealt(rows.select(*by, F.col(key).alias("_key")).where("_key IS NOT NULL"), n, *by, "_key").distinct()
    keys = number_in_order(in_order(pairs.select("_key").distinct(), [F.col("_key").asc()]), "_place").select("_key", "_place")
    coded = pairs.join(keys, "_key").withColumn("bucket", F.bitmap_bucket_number("_place"))
    sets = dealt(coded, n, *by, "bucket").groupBy(*by, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("bits"))
    return stored(sets, "sets")


def distinct_counts(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many different keys each group of ``by`` holds; ``by`` are some of the keys of ``sets``, or none (one row)."""
    united = sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))
