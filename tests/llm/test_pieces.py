"""A task takes a batch in pieces of bounded size, and rows stay out of Python where only texts decide."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martkit.llm import common
from martkit.llm.contamination import ItemBlock


def _long_texts(spark, rows=200):
    """A batch of 20 MB: rows of 100 kB in one task, with a null and an empty text."""
    body = F.when(F.col("id") == 3, None).when(F.col("id") == 4, "").otherwise(F.repeat(F.lit("word "), 20_000))
    return spark.range(rows).coalesce(1).select(F.col("id").alias("doc_id"), body.alias("text"), F.lit("x").alias("row"))


def test_rows_are_kept_piece_by_piece(spark):
    docs = _long_texts(spark)
    most = 2 * common.PIECE_BYTES
    kept = common.keep_rows(docs, "text", lambda texts: np.full(len(texts), sum(map(len, texts)) <= most))
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(200))
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()        # whole rows don't go to Python
    assert common.keep_rows(docs.where("doc_id < 0"), "text", lambda texts: np.zeros(len(texts), bool)).count() == 0


def test_batches_are_mapped_piece_by_piece(spark):
    def work(batch):
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([sum(len(t or b"") for t in batch.column(1).to_pylist())])], names=["n", "size"])
    calls = common.map_batches(_long_texts(spark).select("doc_id", F.col("text").cast("binary")), work, "n long, size long").collect()
    assert sum(r.n for r in calls) == 200 and sum(r.size for r in calls) == 198 * 100_000
    assert max(r.size for r in calls) <= 2 * common.PIECE_BYTES


def test_pieces_hold_every_row():
    batch = pa.RecordBatch.from_pydict({"n": list(range(50)), "text": [b"x" * 1_000_000 if i % 7 == 0 else b"" for i in range(50)]})
    found = list(common.pieces([batch, batch.slice(0, 0), batch.slice(10, 5)]))
    assert [n for p in found for n in p.column(0).to_pylist()] == [*range(50), *range(10, 15)]
    assert all(p.num_rows for p in found)


def test_map_of_few_items_is_small():
    block = ItemBlock([(1, b"one two three four five six seven")], 5, 0.8)
    assert sum(seen.nbytes for _, _, seen, _, _ in block.parts.values()) < 10_000
    assert block.found(b"zero one two three four five six seven eight") == [(0, 3)]
    assert block.found(b"one two three") == []
