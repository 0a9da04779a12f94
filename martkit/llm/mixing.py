"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a target in words.  Its documents are counted by exact length; whole passes are taken as often as the
target allows, and the rest of the budget is fitted by counts per length: an even share of each length first, then a
bounded knapsack by dynamic programming over what is left.  The documents of a length are chosen by a seeded hash of their
id.  Only counts per (source, length) meet; no document is ranked against more than the rows of its own hash cell.

Defined results: a null text has no words; a null source is a source of its own, last in order; a document without words
is never taken; rows that agree in id, source and length are interchangeable; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import ASCII_SPACE, whole_text, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
SEED = 20240229
CELLS = 4096
#: Least budget beyond which even shares are taken before the exact fit, and lengths times budget up to which they aren't.
WINDOW = 1 << 16
WHOLE = 1 << 28


def n_words(text: str = "text") -> Column:
    return F.expr(f"regexp_count(coalesce(`{text}`, ''), '[^\\\\x20\\\\x09-\\\\x0D]+')").cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """source, source_size and target of each source of ``sizes`` (source, size).

    The excess of sources that stop at ``most`` times their size goes to the others by weight.  In the end each source has
    the smaller of its stop and ``level * weight``.  Sources that stop are those with the smallest stop per weight, so the
    level is found along that order.
    """
    by_name, all_rows = W.orderBy(F.col("source").asc_nulls_last()), W.partitionBy(F.lit(1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    per = per.withColumn("stop", F.col("source_size") * float(most))
    order = W.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", rest / weights_left)
    open_ = F.col("stop") > F.col("level") * F.col("weight")
    level = F.min(F.when(open_, F.struct("rank", "level"))).over(all_rows)["level"]
    per = per.withColumn("rank", F.row_number().over(order)).withColumn("final", level)
    target = F.when(F.col("final").isNull(), F.col("stop")).otherwise(F.least(F.col("stop"), F.col("final") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take, so that the words come as near to the budget as can be, not above it.

    ``reach`` says for each sum which length reached it first.  Where lengths times budget are many (``WHOLE``), even shares
    bring the rest below a window of at least twice the longest length first, and the rest is fitted as near as can be.
    """
    order = np.argsort(-lengths)
    lengths, counts = lengths[order], counts[order]
    if len(lengths) and budget > 0:
        unit = int(np.gcd.reduce(lengths))
        lengths, budget = lengths // unit, budget // unit
        window = max(WINDOW, 2 * int(lengths[0]), budget if budget * len(lengths) <= WHOLE and budget <= 1 << 24 else 0)
    total = int((lengths * counts).sum())
    taken = np.zeros(len(lengths), np.int64)
    if budget >= total:
        taken[:] = counts
    elif budget > 0:
        if budget > window:
            taken = np.minimum(counts, ((counts * (budget - window // 2)) // total))
        left = budget - int((lengths * taken).sum())
        for i, n in enumerate(lengths):                  # the long ones first, while more than a window is left
            if left <= window:
                break
            more = min(int(counts[i] - taken[i]), max(0, left - window // 2) // int(n))
            taken[i] += more
            left -= more * int(n)
        reach = np.full(left + 1, -1, np.int32)
        reach[0] = len(lengths)
        copies: dict[int, np.ndarray] = {}
        for i, n in enumerate(lengths.tolist()):
            spare = min(int(counts[i] - taken[i]), (len(reach) - 1) // n)
            step = 1
            # Once each: 1, 2, 4, ... copies of a length make every number of copies up to ``spare``.
            used = np.zeros(len(reach), np.int32)
            while spare > 0 and reach[-1] < 0:
                k = min(step, spare)
                new = np.flatnonzero((reach[:len(reach) - k * n] >= 0) & (reach[k * n:] < 0)) + k * n
                reach[new] = i
                used[new] = used[new - k * n] + k
                spare -= k
                step *= 2
            copies[i] = used[reach == i]
            if reach[-1] >= 0:
                break
        at = int(np.flatnonzero(reach >= 0)[-1])
        where = {i: np.flatnonzero(reach == i) for i in copies}
        while at:
            i = int(reach[at])
            k = int(copies[i][np.searchsorted(where[i], at)])
            taken[i] += k
            at -= k * int(lengths[i])
    out = np.empty_like(taken)
    out[order] = taken
    return out


def _length_counts(counted: DataFrame, most: int) -> DataFrame:
    """passes (whole takes of every document) and extra (documents taken once more) per source and length."""
    def per_source(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows of a source follow one another, by length; a source's lengths are at most its longest document's words.
        held = []

        def done(pdf: pd.DataFrame) -> pd.DataFrame:
            total, target = int((pdf["size"] * pdf["n"]).sum()), float(pdf["target"].iloc[0])
            passes = min(int(target // total), int(most)) if total else 0
            budget = int(round(target)) - passes * total if passes < most else 0
            return pdf.assign(passes=passes, extra=fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), budget))[
                ["source", "size", "passes", "extra"]]
        for pdf in frames:
            name = pdf["source"].fillna("\0")
            for _, run in pdf.groupby((name != name.shift()).cumsum(), sort=False):
                first = run["source"].fillna("\0").iloc[0]
                if held and held[-1]["source"].fillna("\0").iloc[0] != first:
                    yield done(pd.concat(held, ignore_index=True))
                    held = []
                held.append(run)
        if held:
            yield done(pd.concat(held, ignore_index=True))
    sorted_ = counted.repartition("source").sortWithinPartitions("source", "size")
    return sorted_.mapInPandas(per_source, "source string, size long, passes long, extra long")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_PASSES,
                    seed: int = SEED, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target and taken (words the mix takes, repeats counted) of each row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(text).alias("size"))
    cell = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(CELLS)).cast("int")
    order = F.xxhash64("doc_id", F.lit(seed + 1))
    rows = written(rows.withColumn("cell", cell).withColumn("place", order), "sizes")
    cells = written(rows.groupBy("source", "size", "cell").agg(F.count("*").alias("n")), "cells")
    lengths = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = written(source_targets(lengths.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, most), "targets")
    same_source = F.col("source").eqNullSafe(F.col("s"))
    named = targets.withColumnRenamed("source", "s")
    counted = lengths.where("size > 0").join(named, same_source).select("source", "size", "n", "target")
    takes = written(_length_counts(counted, most), "takes")
    takes_of = takes.select(F.col("source").alias("s"), F.col("size").alias("z"), "passes", "extra")
    same = same_source & (F.col("size") == F.col("z"))
    # The cells before a cell hold ``before`` documents: it is taken whole, not at all, or in part.
    by_cell = W.partitionBy("source", "size").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    parts = cells.withColumn("before", F.coalesce(F.sum("n").over(by_cell), F.lit(0))).join(takes_of, same, "left")
    quota = F.greatest(F.lit(0), F.least(F.col("n"), F.coalesce("extra", F.lit(0)) - F.col("before")))
    parts = parts.drop("s", "z").join(named, same_source)
    parts = parts.select("s", F.col("size").alias("z"), F.col("cell").alias("c"), "n", "source_size", "target",
                         F.coalesce("passes", F.lit(0)).alias("passes"), quota.alias("quota"))
    rows = rows.join(parts, same & (F.col("cell") == F.col("c")))
    in_part = (F.col("quota") > 0) & (F.col("quota") < F.col("n"))
    rank = F.row_number().over(W.partitionBy("source", "size", "cell").orderBy("place", "doc_id"))
    cut = rows.where(in_part).withColumn("more", (rank <= F.col("quota")).cast("int"))
    whole = rows.where(~in_part).withColumn("more", (F.col("quota") > 0).cast("int"))
    return whole.unionByName(cut).select("doc_id", "size", "source", "source_size", "target", (F.col("size") * (F.col("passes") + F.col("more"))).alias("taken"))
