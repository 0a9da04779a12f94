"""Labelled rows for the two scorers: which rows may be learnt from, and the bounded sample that is."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False))


def training_labels(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, y and fold of the labelled rows to learn from; an id with several labels counts as the larger one."""
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
    rows = rows.groupBy(F.col(doc_id).alias("label_id")).agg(F.max(F.col(label)).cast("double").alias("y"))
    return rows.withColumn("fold", fold("label_id"))


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """All rows if there are at most ``most``, else about that many, chosen by a hash of the id."""
    share = min(1.0, most / max(1, rows.count()))
    return rows if share == 1.0 else rows.where(F.pmod(F.xxhash64("label_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1e6))
