"""Key relations between tables: orphans, duplicates, row counts per key.

Every operator counts rows per key before any join, so a key that repeats millions of times travels once.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


#: Rows that one task groups: what it holds does not grow with the table.
ROWS_PER_TASK = 150_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by keys to as many tasks as ``rows`` ask for."""
    return df.repartition(max(1, -(-rows // ROWS_PER_TASK)), *keys)


def in_parts(df: DataFrame, rows: int, key: str, name: str = "_part") -> DataFrame:
    """``df`` dealt to tasks by parts of its keys (column ``name``), a few for each task.

    Grouping by the part and anything else moves nothing more.  So rows are grouped behind the shuffle, where a task has a
    bounded number of them, and not ahead of it, where a task has as many as its file; and a busy value of another column
    is one sum per part before it travels again.
    """
    parts = 4 * max(1, -(-rows // ROWS_PER_TASK))
    return dealt(df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(parts))), rows, name)


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "rows_per_key") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  keep_null: bool = False) -> DataFrame:
    """Child key values without a parent, each with its number of rows (``key``, ``rows_per_key``).

    NULL keys are left out, or with ``keep_null`` count as orphans unless the parent has a NULL key too.
    """
    rows = child.select(F.col(column).alias("key"))
    known = parent.select(F.col(parent_column).alias("_known")).distinct()
    if keep_null:
        return key_counts(rows, ["key"]).join(known, F.col("key").eqNullSafe(F.col("_known")), "left_anti")
    return key_counts(rows.where(F.col("key").isNotNull()), ["key"]) \
        .join(known, F.col("key") == F.col("_known"), "left_anti")


def smallest_values(df: DataFrame, by: str, value: str, k: int) -> DataFrame:
    """The ``k`` smallest values per group as an array; ``(by, value)`` pairs must be distinct.

    Spark turns the rank filter into a group limit ahead of the shuffle, so each task passes on ``k`` rows per group.
    """
    rank = F.row_number().over(Window.partitionBy(by).orderBy(value))
    return df.select(by, value, rank.alias("_r")).where(F.col("_r") <= k) \
        .groupBy(by).agg(F.array_sort(F.collect_list(value)).alias("smallest"))


def smallest_overall(df: DataFrame, value: str, k: int) -> DataFrame:
    """One row: the ``k`` smallest of distinct values as an array.  Each task passes on ``k`` rows."""
    return df.select(value).orderBy(value).limit(k).agg(F.array_sort(F.collect_list(value)).alias("smallest"))


def most_frequent(counts: DataFrame, by: str, value: str, n: str, k: int) -> DataFrame:
    """Per group the ``k`` values of highest count, and exactly how many values and how much of the count are left.

    ``(by, value)`` pairs must be distinct.  ``listed`` is an array of (place, value, n), never longer than ``k``: the rank
    filter becomes a group limit ahead of the shuffle, and the totals are plain sums.
    """
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(n), F.asc_nulls_last(value)))
    top = counts.select(by, value, n, rank.alias("place")).where(F.col("place") <= k).groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct("place", F.col(value).alias("value"), F.col(n).alias("n")))).alias("listed"), F.sum(n).alias("_shown"))
    whole = counts.groupBy(by).agg(F.count("*").alias("_values"), F.sum(n).alias("_total"))
    return whole.join(top, by).select(by, "listed", (F.col("_values") - F.size("listed")).alias("others"), (F.col("_total") - F.col("_shown")).alias("rest"))


def comparable(df: DataFrame, long_text: Sequence[str] = ()) -> list[Column]:
    """All columns for grouping whole rows; long texts are replaced by their SHA-256, so they do not travel."""
    return [F.sha2(F.col(c), 256).alias(c) if c in long_text else F.col(c) for c in df.columns]


def row_copies(df: DataFrame, long_text: Sequence[str] = ()) -> DataFrame:
    """Distinct rows with the number of copies of each."""
    columns = comparable(df, long_text)
    return df.select(*columns).groupBy(*df.columns).agg(F.count("*").alias("copies"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_counts(df, keys).where(F.col("rows_per_key") > 1).select(*[F.col(k).alias(f"_k_{k}") for k in keys])


def copied_rows(df: DataFrame, key: Sequence[str] = (), long_text: Sequence[str] = (), again: DataFrame | None = None) -> DataFrame:
    """``row_copies`` over the rows that can have a copy at all.

    Copies share their key, so with a declared key only rows of repeated keys are compared in full: where keys are
    mostly unique, the shuffle of whole rows shrinks to a shuffle of keys.  ``again`` has the repeated keys if they are known.
    """
    if key:
        again = repeated_keys(df, key) if again is None else again.select(*[F.col(k).alias(f"_k_{k}") for k in key])
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
        df = df.join(again, reduce(lambda a, b: a & b, same), "left_semi")
    return row_copies(df, long_text)
