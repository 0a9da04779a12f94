"""Exact quantiles without a hot group.

``percentile`` keeps every distinct value of a group in one buffer, and one group may hold a third of all rows.
Here equal values are counted first (map-side, spread over ``keys + value``), the counts are summed per *cell* of
the value axis, and only the cells that hold a wanted rank are looked into.  What they hold is stored, and narrowed round by
round: a cell of many different values is cut into ``PARTS`` between its smallest and its largest, of which again only those
with a wanted rank stay.  No task sees more than the cells of one key, the parts of one cell, or ``OPENED`` values.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

#: Parts a cell is cut into in a round, and different values that a window may see.
PARTS, OPENED = 1 << 14, 1 << 14


def log_cell(v: Column) -> Column:
    """Cells 0.1 % wide on either side of zero; monotone, and a few ten thousand at most for any range."""
    v = v.cast("double")
    return (F.signum(v) * F.floor(F.log1p(F.abs(v)) * 1000)).cast("long")


def linear_cell(width: float) -> Callable[[Column], Column]:
    """Cells of one width, for axes with known ends such as coordinates."""
    return lambda v: F.floor(v.cast("double") / F.lit(float(width))).cast("long")


def _rank(total: Column, p: float) -> tuple[Column, Column, Column]:
    """Lower rank, upper rank (both from 0) and the weight of the upper one."""
    position = (total - 1).cast("double") * F.lit(float(p))
    low = F.floor(position)
    return low.cast("long"), F.ceil(position).cast("long"), position - low


def _narrowed(inner: DataFrame, by: list[str], found: list[str], wanted: Column) -> DataFrame:
    """The values of the parts with a wanted rank.  Ends of a cell lie in different parts, so every cell gets smaller."""
    ends = inner.groupBy(*by, "_before").agg(F.min("_v").cast("double").alias("_low"), F.max("_v").cast("double").alias("_high"))
    width = F.try_divide(F.col("_v").cast("double") - F.col("_low"), F.col("_high") - F.col("_low"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*by, "_before"]])
    cut = inner.join(ends.withColumnsRenamed({c: f"_of_{c}" for c in [*by, "_before"]}), same) \
        .select(*by, *found, "_v", "_n", F.floor(F.coalesce(width, F.lit(0.0)) * PARTS).cast("long").alias("_part"))
    line = Window.partitionBy(*by, "_before").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = cut.groupBy(*by, *found, "_part").agg(F.sum("_n").alias("_c"))
    parts = parts.withColumn("_at", F.col("_before") + F.sum("_c").over(line) - F.col("_c"))
    parts = parts.withColumnsRenamed({"_before": "_cell", "_at": "_before"}).where(wanted).select(*by, "_cell", "_part", F.col("_before").alias("_at"))
    kept = parts.withColumnsRenamed({c: f"_of_{c}" for c in [*by, "_part"]}).withColumnRenamed("_cell", "_of__before")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*by, "_before", "_part"]])
    return cut.join(kept, same).select(*by, F.col("_at").alias("_before"), *found[1:], "_v", "_n")


def _most(inner: DataFrame, by: list[str]) -> int:
    """Different values of the fullest cell."""
    return inner.groupBy(*by, "_before").count().agg(F.max("count")).first()[0] or 0


def exact_quantiles(
    df: DataFrame,
    value: Column | str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    cell: Callable[[Column], Column] = log_cell,
    scale: dict[str, Callable[[Column], Column]] | None = None,
    few_groups: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """One row per ``by`` with a linearly interpolated quantile (double) per entry of ``probs``, and ``n``, ``max``.

    ``scale`` names an increasing function for some quantiles: they are interpolated, and returned, on that scale.
    ``few_groups`` says that ``by`` is empty or holds names given by the caller, so there are at most two wanted cells
    per quantile and name.  Then rows are counted per cell only, the wanted cells are sent to every task, and a second
    look at the input keeps the rows inside them: nearly nothing is shuffled.  Otherwise equal values are counted
    once and the count is used for both steps.
    ``weight`` names a column that says how often a row's value counts.
    NULL values are ignored; a group without values yields no row (no row at all when ``by`` is empty).
    """
    by = list(by)
    value = F.col(value) if isinstance(value, str) else value
    often = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    rows = df.select(*by, value.alias("_v"), often.alias("_n")).where(F.col("_v").isNotNull())
    counted = rows if few_groups else rows.groupBy(*by, "_v").agg(F.sum("_n").alias("_n"))
    counted = counted.withColumn("_cell", cell(F.col("_v")))
    per_key = Window.partitionBy(*by)
    upto = per_key.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = (
        counted.groupBy(*by, "_cell").agg(F.sum("_n").alias("_c"), F.max("_v").alias("_m"))
        .select(
            *by, "_cell", "_c",
            (F.sum("_c").over(upto) - F.col("_c")).alias("_before"),
            F.sum("_c").over(per_key).alias("_total"),
            F.max("_m").over(per_key).alias("_max"),
        )
    )
    ranks = {name: _rank(F.col("_total"), p) for name, p in probs.items()}

    def inside(r: Column, before: str, count: str) -> Column:
        return (F.col(before) <= r) & (r < F.col(before) + F.col(count))

    wanted = F.lit(False)
    for low, high, _ in ranks.values():
        wanted = wanted | inside(low, "_before", "_c") | inside(high, "_before", "_c")
    hits = cells.where(wanted).drop("_c")
    found = ["_before", "_total", "_max"]
    met = counted.join(F.broadcast(hits) if few_groups else hits, [*by, "_cell"])
    # ``_before``, the rows of the key below the cell, names the cell from here on.
    inner = stored(met.groupBy(*by, *found, "_v").agg(F.sum("_n").alias("_n")), "cells")
    most, last = _most(inner, by), None
    while most > OPENED and most != last:                # values that are one as doubles can't be told apart further
        inner = stored(_narrowed(inner, by, found, wanted), "cells")
        most, last = _most(inner, by), most

    in_cell = Window.partitionBy(*by, "_before").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = inner.withColumn(
        "_start", F.col("_before") + F.sum("_n").over(in_cell) - F.col("_n"))

    picks = [F.max("_total").alias("n"), F.max("_max").alias("max")]
    for name, (low, high, _) in ranks.items():
        picks.append(F.max(F.when(inside(low, "_start", "_n"), F.col("_v"))).cast("double").alias(f"_lo_{name}"))
        picks.append(F.max(F.when(inside(high, "_start", "_n"), F.col("_v"))).cast("double").alias(f"_hi_{name}"))
    picked = fine.groupBy(*by).agg(*picks)
    if not by:
        picked = picked.where(F.col("n").isNotNull())
    out = [*by, "n", "max"]
    for name, p in probs.items():
        weight = _rank(F.col("n"), p)[2]
        to = (scale or {}).get(name, lambda x: x)
        lo, hi = to(F.col(f"_lo_{name}")), to(F.col(f"_hi_{name}"))
        out.append((lo + (hi - lo) * weight).alias(name))
    return picked.select(*out)


def exact_median(df: DataFrame, value: Column | str, name: str, by: Sequence[str] = (),
                 cell: Callable[[Column], Column] = log_cell) -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by, cell).select(*by, name)
