"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of different shingles (powers of two).  Each partition has one sketch length:
an item's sketch is that many of its smallest shingle hashes.  The length follows from the partition's largest size and
the threshold: an item that is contained to ``least`` lacks at most ``(1 - least)`` of its shingles in the document, so one
of its ``floor((1 - least) * size) + 1`` smallest hashes is there.  So a document that holds none of an item's sketch can't
contain it, whatever the document's length, and no item is missed.  Documents too short for a partition skip it.  Candidates
are verified by comparing the shingles' words.

Items are the stated query set: they are taken in blocks of at most about ``BLOCK_WORDS`` words, each sent to all tasks,
and documents stream past each block; neither is shuffled.

Words are runs of letters and digits in lower case.  An item of fewer words than a shingle has one shingle: all its words.
Defined results: a null or empty text, of a document or an item, contains nothing and is contained in nothing; repeated
items and documents give a row each per different (id, text) of the item and per row of the documents.
"""
from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import keep_rows, map_batches, octets, plain_words, rolled

BLOCK_WORDS = 1_000_000
_MAP_BITS = 22


class ItemBlock:
    """Sketches and shingles of a block of items."""

    def __init__(self, items: list[tuple[object, bytes]], size: int, least: float) -> None:
        self.least, self.items, self.parts = least, [], {}
        classes = defaultdict(list)
        for item_id, text in items:
            words = plain_words(text)
            if not words:
                continue
            m = min(size, len(words))
            hashes = rolled(_hashes(words), m)
            shingles = {tuple(words[i:i + m]) for i in range(len(words) - m + 1)}
            own = np.unique(hashes)
            classes[m, len(own).bit_length()].append(len(self.items))
            self.items.append((item_id, shingles, own))
        for (m, bits), members in classes.items():
            largest = (1 << bits) - 1
            length = largest - int(np.ceil(least * largest - 1e-9)) + 1
            owners = defaultdict(list)
            for i in members:
                for h in self.items[i][2][:length].tolist():
                    owners[h].append(i)
            sketch = np.fromiter(sorted(owners), np.uint64, len(owners))
            # The map is as large as the sketch needs, so that about one place in a hundred is marked.
            shift = np.uint64(64 - min(_MAP_BITS, (len(sketch) * 64).bit_length()))
            seen = np.zeros(1 << 64 - int(shift), bool)
            seen[sketch >> shift] = True
            fewest = min(int(np.ceil(least * len(self.items[i][2]) - 1e-9)) for i in members)
            self.parts[m, bits] = (fewest, shift, seen, sketch, dict(owners))

    def found(self, text: bytes) -> list[tuple[int, int]]:
        """(item number, shared shingles) of each item the text contains to the threshold."""
        words = plain_words(text)
        if not words:
            return []
        hashes, by_size, out = _hashes(words), {}, []
        for (m, _), (fewest, shift, seen, sketch, owners) in self.parts.items():
            if m not in by_size:
                by_size[m] = rolled(hashes, m)
            h = by_size[m]
            if len(h) < fewest:
                continue
            hits = h[seen[h >> shift]]
            hits = np.unique(hits[np.isin(hits, sketch)])
            for i in sorted({i for x in hits.tolist() for i in owners[x]}):
                _, shingles, own = self.items[i]
                at = np.flatnonzero(np.isin(h, own))
                shared = len(shingles & {tuple(words[p:p + m]) for p in at.tolist()})
                if shared >= self.least * len(shingles) - 1e-9:
                    out.append((i, shared))
        return out


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def item_blocks(items: DataFrame, words: int, least: float, text: str, item_id: str):
    """The items, block after block, ready to be sent to the tasks."""
    rows = items.select(F.col(item_id).alias("id"), octets(text).alias("body")).distinct()
    total = rows.agg(F.sum(F.length("body") / 4 + 1)).first()[0] or 0
    blocks = int(total // (BLOCK_WORDS // 2)) + 1
    numbered = rows.withColumn("block", F.pmod(F.xxhash64("id", "body"), F.lit(blocks)))
    for b in range(blocks):
        part = [(r.id, bytes(r.body)) for r in numbered.where(F.col("block") == b).select("id", "body").collect()]
        yield rows.sparkSession.sparkContext.broadcast(ItemBlock(part, words, least))


def contained_items(docs: DataFrame, items: DataFrame, words: int = 5, least: float = 0.8, text: str = "text",
                    doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """A row for each document and item it contains: doc_id, item_id, item_shingles, shared_shingles, containment."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), octets(text).alias("body"))
    kind = {"doc_id": docs.schema[doc_id].dataType.simpleString(), "item_id": items.schema[item_id].dataType.simpleString()}
    schema = f"doc_id {kind['doc_id']}, item_id {kind['item_id']}, item_shingles long, shared_shingles long, containment double"
    id_type, out = to_arrow_type(items.schema[item_id].dataType), None
    for block in item_blocks(items, words, least, item_text, item_id):
        def work(batch: pa.RecordBatch, block=block) -> pa.RecordBatch:
            items, at, cells = block.value.items, [], []
            for row, t in enumerate(batch.column(1).to_pylist()):
                for i, shared in block.value.found(t):
                    at.append(row)
                    cells.append((items[i][0], len(items[i][1]), shared, shared / len(items[i][1])))
            ids, n, shared, share = zip(*cells) if cells else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(ids, id_type), pa.array(n, pa.int64()),
                 pa.array(shared, pa.int64()), pa.array(share, pa.float64())],
                names=["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"])
        found = map_batches(rows, work, schema)
        out = found if out is None else out.unionByName(found)
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, words: int = 5, least: float = 0.8, text: str = "text",
                         item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents that contain no item, with all their columns; nothing is shuffled."""
    for block in item_blocks(items, words, least, item_text, item_id):
        docs = keep_rows(docs, text, lambda texts, block=block: np.array([not block.value.found(t) for t in texts], bool))
    return docs
