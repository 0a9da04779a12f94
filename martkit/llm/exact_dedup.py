"""Exact deduplication by skew-safe combining.

1. Digests are counted.  A text whose digest occurs once has no copy, and its text is not moved: a filter of fixed size lets
   through rows with a repeated digest, and few others.
2. Texts with a repeated digest are combined where they lie, then per digest and salt, then per digest.  The text itself
   is a grouping key in each of these steps, so whole contents are compared, never digests alone.  A text that fills a
   third of all rows arrives as one row per task at the salts, and as one row per salt at the end.

Defined results: a null text is an empty text; a null document id is smaller than any other; of rows that agree in id and
text, one stays.  Two different texts under one digest raise an error instead of a wrong group.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import key_filter, whole_text, written

SALTS = 32


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def repeated_digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """The short digests (64 bits) that more than one row has."""
    h = docs.select(F.xxhash64(whole_text(text)).alias("h"))
    return written(h.groupBy("h").count().where("count > 1").select("h"), "repeated")


def duplicate_groups(docs: DataFrame, repeated: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per text that several rows have: digest, keep_id and group_size."""
    rows = docs.select(F.col(doc_id).alias("id"), whole_text(text).alias("body"), F.xxhash64(whole_text(text)).alias("h"),
                       F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    rows = rows.where(key_filter(repeated, "h")("h")).join(repeated, "h", "left_semi").withColumn("digest", _digest(F.col("body")))
    # The first grouping also combines within each task before anything moves.
    salted = rows.groupBy("digest", "salt", "body").agg(F.max("id").alias("id"), F.count("*").alias("n"))
    merged = salted.groupBy("digest", "body").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    clash = F.when(F.count("*") > 1, F.raise_error(F.lit("two different texts have one digest"))).cast("string")
    checked = merged.groupBy("digest").agg(clash.alias("clash"), F.max("keep_id").alias("keep_id"),
                                           F.max("group_size").alias("group_size"))
    return written(checked.where("clash is null and group_size > 1").drop("clash"), "groups")


def _marked(docs: DataFrame, groups: DataFrame, text: str, doc_id: str, *more: Column) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("id"), F.sha2(whole_text(text), 256).alias("sha"), *more)
    copied = F.col("digest").isNotNull()
    return rows.join(groups, F.unhex("sha") == groups.digest, "left").select(
        "id", "sha", F.when(copied, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"), *[c for c in ("row",) if more],
        (~copied | F.col("id").eqNullSafe(F.col("keep_id"))).alias("best"))


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    marked = _marked(docs, duplicate_groups(docs, repeated_digests(docs, text), text, doc_id), text, doc_id)
    plain = marked.where("group_size = 1 or not best").withColumnRenamed("best", "kept")
    # Rows with the winner's id, one or several: counted where they lie; one of all stays.
    part = F.spark_partition_id().alias("part")
    tops = marked.where("group_size > 1 and best").groupBy("id", "sha", "keep_id", "group_size", part).count()
    tops = written(tops, "tops")
    first = tops.groupBy(F.col("sha").alias("s")).agg(F.min("part").alias("first"))
    tops = tops.join(first, F.col("sha") == F.col("s")).select(
        "id", "sha", "keep_id", "group_size",
        F.explode(F.expr("transform(sequence(1, int(count)), i -> i = 1 and part = first)")).alias("kept"))
    out = plain.select("id", "sha", "keep_id", "group_size", "kept").unionByName(tops)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def without_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns."""
    repeated = repeated_digests(docs, text)
    groups = duplicate_groups(docs, repeated, text, doc_id)
    may_repeat = key_filter(repeated, "h")(F.xxhash64(whole_text(text)))
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    best = _marked(docs.where(may_repeat), groups, text, doc_id, row).where("best")
    tops = best.where("group_size > 1").groupBy("sha").agg(F.first("row").alias("row"))
    kept = best.where("group_size = 1").select("row").unionByName(tops.select("row"))
    return docs.where(~may_repeat).select(row).unionByName(kept).select("row.*")
