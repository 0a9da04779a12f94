"""Ordered computations (sequence, lead, rank, running total, tiles) without a hot group.

A window sends each of its groups, or everything when it has no groups, to a single task.  ``in_order`` deals rows by
ranges of the order instead, and what lies in several ranges is put together from a few rows per range.  ``rank_all`` cuts the
order into *cells*: totals per cell are small and can go through an ordinary window, and rows are only ever ordered inside
one cell.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored


def _before(total: str, window) -> Column:
    """Sum over the cells ahead of this one."""
    return F.coalesce(F.sum(total).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def in_order(df: DataFrame, order: Sequence[Column], at: str = "_at") -> DataFrame:
    """``df`` in one global order, as a table in the shared folder; ``at`` grows along it, across tasks too.

    Rows are dealt by ranges of ``order`` that Spark draws from a sample, so a key with a third of all rows lies in as many
    ranges as its rows ask for.  The table is written because a second execution could draw other ranges.
    """
    # Row numbers of a task start at 0; the task is in the bits above them.
    return stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ordered")


def number_in_order(table: DataFrame, name: str, at: str = "_at") -> DataFrame:
    """The place of every row, from 0, in the order of ``in_order``."""
    task = F.shiftright(at, _ROW_BITS)
    sizes = table.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))            # one row per task
    starts = sizes.select("_task", _before("_n", Window.orderBy("_task")).alias("_start"))
    placed = table.withColumn("_task", task).join(F.broadcast(starts), "_task")
    return placed.withColumn(name, F.col("_start") + F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).drop("_task", "_start")


def _by_range(table: DataFrame, keys: Sequence[str], at: str) -> tuple[DataFrame, DataFrame]:
    """``table`` with ``_task``, the range a row lies in, and the ends of keys that lie in several ranges.

    Only the first and the last key of a range can lie in another range as well, so there are at most two ends per range,
    few enough to be broadcast whatever the data.
    """
    rows = table.withColumn("_task", F.shiftright(at, _ROW_BITS))
    # Two row numbers a range are looked up: sorting rows for their first and last key would cost more than a second scan.
    ends = rows.groupBy("_task").agg(F.min(at).alias("_first"), F.max(at).alias("_last")).select(F.explode(F.array("_first", "_last")).alias("_end"))
    return rows, rows.join(F.broadcast(ends), F.col(at) == F.col("_end"), "left_semi").select("_task", *keys).distinct()


def number_in_key(table: DataFrame, keys: Sequence[str], name: str, at: str = "_at") -> DataFrame:
    """The place of every row, from 0, among the rows of its key; NULL is a key.

    ``table`` comes from ``in_order``, whose order begins with the keys.  Rows are numbered inside a pair of range and key,
    which is never more than a task wrote; what earlier ranges hold of the same key is added.
    """
    keys = list(keys)
    rows, ends = _by_range(table, keys, at)
    held = _same(rows.select("_task", *keys), F.broadcast(ends), ["_task", *keys]).groupBy("_task", *keys).agg(F.count("*").alias("_n"))
    ahead = held.select("_task", *keys, _before("_n", Window.partitionBy(*keys).orderBy("_task")).alias("_ahead")).where("_ahead > 0")
    inside = F.row_number().over(Window.partitionBy("_task", *keys).orderBy(at)) - 1
    out = _same(rows.withColumn("_inside", inside.cast("long")), F.broadcast(ahead), ["_task", *keys], how="left")
    return out.withColumn(name, F.col("_inside") + F.coalesce("_ahead", F.lit(0))).drop("_task", "_inside", "_ahead")


def next_in_key(table: DataFrame, keys: Sequence[str], value: str, name: str, at: str = "_at") -> DataFrame:
    """``value`` of the following row of the same key, NULL after the last; ``table`` as in ``number_in_key``."""
    keys = list(keys)
    rows, ends = _by_range(table, keys, at)
    held = _same(rows.select("_task", *keys, at, value), F.broadcast(ends), ["_task", *keys]).groupBy("_task", *keys).agg(F.min_by(value, at).alias("_n"))
    line = Window.partitionBy(*keys).orderBy("_task")
    after = held.select("_task", *keys, F.lead("_n").over(line).alias("_after"), F.lead(F.lit(True)).over(line).alias("_more")).where("_more")
    inside = Window.partitionBy("_task", *keys).orderBy(at)
    rows = rows.withColumns({"_next": F.lead(value).over(inside), "_last": F.lead(F.lit(True)).over(inside).isNull()})
    out = _same(rows, F.broadcast(after), ["_task", *keys], how="left")
    return out.withColumn(name, F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_next"))).drop("_task", "_next", "_last", "_after", "_more")


#: ``monotonically_increasing_id`` keeps the row in its lower bits and the task above them (a fixed value of Spark).
_ROW_BITS = 33


def _ordered_by_key(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    return in_order(df, [F.col(key).asc_nulls_first(), F.col(ts).asc_nulls_last(), F.col(tie).asc_nulls_last()])


def sequence_per_key(df: DataFrame, key: str, ts: str, tie: str, name: str) -> DataFrame:
    """Number the rows of each key by (ts, tie) from 1, NULL times last; NULL without a key.

    The rows are written once, in order (``in_order``): a range exchange, then one by range and key.
    """
    numbered = number_in_key(_ordered_by_key(df, key, ts, tie), [key], name)
    return numbered.withColumn(name, F.when(F.col(key).isNotNull(), F.col(name) + 1)).drop("_at")


def next_per_key(df: DataFrame, key: str, ts: str, tie: str, name: str) -> DataFrame:
    """The time of the following row of the same key (``LEAD(ts)``); NULL without a key.  Written once, as above."""
    linked = next_in_key(_ordered_by_key(df, key, ts, tie), [key], ts, name)
    return linked.withColumn(name, F.when(F.col(key).isNotNull(), F.col(name))).drop("_at")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``names``, NULL matching NULL."""
    renamed = right.withColumnsRenamed({n: f"{n}__r" for n in names})
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}__r")) for n in names])
    return left.join(renamed, on, how).drop(*[f"{n}__r" for n in names])


def rank_all(
    df: DataFrame,
    order: Sequence[Column],
    cell: dict[str, Column],
    cell_order: Sequence[Column],
    position: str = "position",
    running: dict[str, str] | None = None,
) -> DataFrame:
    """Position of every row in one global order, running sums along it, and the overall totals.

    ``cell`` names levels of ever finer cells; a NULL level is a cell of its own, and ``cell_order`` must place it where
    ``order`` places its rows.  Rows in ``order`` never step back in the levels
    taken together (a rounded-down value; or the value itself and then the head of the tie-break key, which splits a
    value shared by very many rows).  ``cell_order`` sorts the levels as ``order`` sorts rows.  Totals are added up
    level by level, so a task sees the cells inside one parent cell, or the rows of one finest cell.
    Adds ``position``, one column per entry of ``running`` (output name -> summed column), ``n_rows`` and
    ``total_<output name>``.
    """
    running, levels = running or {}, list(cell)
    sums = {"_c": None, **{f"_s_{n}": c for n, c in running.items()}}
    marked = df.select("*", *[c.alias(n) for n, c in cell.items()])
    finest = marked.groupBy(*levels).agg(
        *[(F.count("*") if c is None else F.sum(c)).alias(s) for s, c in sums.items()])
    whole = finest.agg(F.sum("_c").alias("n_rows"), *[F.sum(f"_s_{n}").alias(f"total_{n}") for n in running])
    ahead = finest.select(*levels)
    for i, level in enumerate(levels):
        known = levels[:i + 1]
        line = Window.partitionBy(*levels[:i]).orderBy(cell_order[i])
        step = finest.groupBy(*known).agg(*[F.sum(s).alias(s) for s in sums]) \
            .select(*known, *[_before(s, line).alias(f"{s}{level}") for s in sums])
        ahead = _same(ahead, step, known)
    # One row of totals travels to every task.
    ahead = ahead.select(*levels, *[reduce(add, [F.col(f"{s}{v}") for v in levels]).alias(f"_ahead{s}") for s in sums])
    inside = Window.partitionBy(*levels).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = _same(marked, ahead, levels).withColumn(position, F.row_number().over(inside).cast("long") + F.col("_ahead_c"))
    for n, c in running.items():
        out = out.withColumn(n, F.sum(c).over(upto) + F.col(f"_ahead_s_{n}"))
    return out.drop(*levels, *[f"_ahead{s}" for s in sums]).crossJoin(F.broadcast(whole))


def tile(position: Column, n_rows: Column, tiles: int) -> Column:
    """``NTILE(tiles)`` from a position: the first ``n_rows % tiles`` tiles hold one row more."""
    small = F.floor(n_rows / tiles)
    extra = n_rows % tiles
    big_rows = extra * (small + 1)
    p = position - 1
    return F.when(p < big_rows, F.floor(p / (small + 1))) \
        .otherwise(extra + F.floor(F.try_divide(p - big_rows, small))).cast("long") + 1
