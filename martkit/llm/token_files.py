"""Token ids in files of shuffled bit planes.

Texts are encoded with a tokenizer of the ``tokenizers`` library and written, in ascending order of their ids, as one stream
of 32-bit token ids.  A file holds blocks of ``BLOCK`` ids.  A block is transposed into planes, the ids' bytes (or bits) of one
weight each, and every plane is compressed on its own: high planes are all but constant.  An index at the file's end holds
the size of every plane of every block and the id and length of every document, so a reader decodes only the blocks it wants.

    blocks | index (zstandard) | index offset, index size (u64) | MAGIC | line feed

Documents are dealt to tasks by ranges of their ids, and a task writes one file after the other, each of whole documents and
about ``FILE_IDS`` ids; a row is a file, which Spark's text sink writes, so lost tasks are run again and only files of
finished tasks are seen.  Files are read back by Spark as well; where a file begins in the stream is the sum of the ids in
the files before it, by task, then by file.

Encoding makes use of what byte-level pre-tokenizers promise: a space in front of anything but white space, and one behind
anything but white space, begins a new word.  Texts are cut there, and the library encodes each different piece of a
task once.  Texts with a space that is between two white spaces, or with a special token, are encoded whole, and so are all
texts with any other kind of pre-tokenizer.  The ids are those of the whole text either way.

Defined results: a null text is empty; an empty text is the end id alone; documents without an id come first; equal ids are
ordered by the XXH64 of their texts; rows that repeat are written as often; an empty table gives no rows.
"""
from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..session import scratch_folder
from .common import whole_text, written

BLOCK = 1 << 16
#: A file ends with the document that passes so many ids.
FILE_IDS = 1 << 22
END_ID = 0
MAGIC = b"IDPLANE1"
_FOOT = struct.Struct("<QQ8s")
#: Bytes of text that are encoded at a time (one text at least), and pieces that a task remembers before it starts anew.
_BYTES, _REMEMBERED, _LONGEST = 8 << 20, 1_000_000, 64
#: White space in any reading of it (a superset is safe), and the mark put where texts are cut.
_SPACE, _MARK = "\x00-\x20\x7f\u0085  ᠎ -‏ -  -⁠　﻿", "\U0010ffff"


# ---------------------------------------------------------------- encoding
class Encoder:
    """Ids of whole texts, each different piece encoded once."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            made = json.load(f)
        split = made.get("pre_tokenizer") or {}
        self.in_pieces = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
                          and not made.get("normalizer") and not made.get("truncation"))
        self.special = [t["content"] for t in made.get("added_tokens", ())]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)                    # a character stands for a byte
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)
        self.used = 0

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pieces in some order, all their ids, and how many each has.

        Pieces that begin with a space and a letter may stand side by side in one text: many go to the library at a time.
        """
        order, flat, sizes, rest = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], []
        plain = []
        for p in pieces:
            (plain if len(p) > 1 and p[0] == " " and p[1].isalnum() else rest).append(p)
        groups = [plain[i:i + 500] for i in range(0, len(plain), 500)]
        for group, ids in zip(groups, self.whole(["".join(g) for g in groups])):
            found = np.array(ids, np.uint32)
            ends = np.cumsum([len(p.encode()) for p in group])
            read = np.cumsum(self.bytes_of[found])
            cuts = np.searchsorted(read, ends) + 1
            if cuts[-1] == len(read) and np.array_equal(read[cuts - 1], ends):
                order += group
                flat.append(found)
                sizes.append(np.diff(cuts, prepend=0))
            else:
                rest += group
        for p, ids in zip(rest, self.whole(rest)):
            order.append(p)
            flat.append(np.array(ids, np.uint32))
            sizes.append(np.array([len(ids)], np.int64))
        return order, np.concatenate(flat), np.concatenate(sizes)

    def _learn(self, pieces: list[str]) -> None:
        pieces, found, sizes = self._pieces(pieces)
        n = len(self.known)
        while n + len(pieces) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(found) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.starts[n:n + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.lengths[n:n + len(pieces)] = sizes
        self.flat[self.used:self.used + len(found)] = found
        self.used += len(found)
        self.known.update(zip(pieces, range(n, n + len(pieces))))

    def stream(self, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end_id``, and how many ids each text has with it."""
        texts = texts.cast(pa.large_string())
        apart = np.ones(len(texts), bool)
        if self.in_pieces:
            odd = pc.match_substring_regex(texts, f"[{_SPACE}] ([{_SPACE}]|\\z)")
            for mark in (_MARK, *self.special):
                odd = pc.or_(odd, pc.match_substring(texts, mark))
            apart = odd.to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.replace_substring(pc.if_else(pa.array(apart), pa.scalar("", pa.large_string()), texts), " ", _MARK + " "), _MARK)
        offsets = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        if len(self.known) > _REMEMBERED:
            self._forget()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # Long pieces are not remembered, nor is anything that follows from a text that is encoded whole.
        new = [p for p in different if p not in self.known and len(p) <= _LONGEST]
        if new:
            self._learn(new)
        place = np.array([self.known.get(p, -1) for p in different], np.int64)
        long = np.flatnonzero(place < 0)
        own = [np.array(ids, np.uint32) for ids in self.whole([different[i] for i in long] + [texts[int(i)].as_py() for i in np.flatnonzero(apart)])]
        flat = np.concatenate([self.flat[:self.used], np.array([end_id], np.uint32), *own])
        own_lengths = np.fromiter(map(len, own), np.int64, len(own))
        own_starts = self.used + 1 + np.cumsum(own_lengths) - own_lengths
        starts, lengths = self.starts[place], self.lengths[place]
        starts[long], lengths[long] = own_starts[:len(long)], own_lengths[:len(long)]
        piece = coded.indices.to_numpy()
        starts, lengths = starts[piece], lengths[piece]
        at = offsets[:-1][apart] - offsets[0]                # a text encoded whole stands as one empty piece here
        starts[at], lengths[at] = own_starts[len(long):], own_lengths[len(long):]
        ends = offsets[1:] - offsets[0]
        starts, lengths = np.insert(starts, ends, self.used), np.insert(lengths, ends, 1)
        upto = np.cumsum(lengths)
        ids = flat[np.repeat(starts - (upto - lengths), lengths) + np.arange(upto[-1] if len(upto) else 0)]
        last = upto[ends + np.arange(len(ends))] if len(ends) else np.zeros(0, np.int64)
        return ids, np.diff(last, prepend=0)


@lru_cache(maxsize=2)
def _encoder(tokenizer_file: str) -> Encoder:
    return Encoder(tokenizer_file)


# ---------------------------------------------------------------- files
def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The ids' bytes by weight (4 planes), or their bits by weight (32)."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [p.tobytes() for p in octets.T]
    return [np.packbits(p, bitorder="little").tobytes() for p in np.unpackbits(octets, axis=1, bitorder="little").T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        octets = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        each = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
        octets = np.packbits(np.stack(each, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


class FileBuilder:
    """One file: blocks are compressed as they fill up."""

    def __init__(self, task: int, number: int, bits: bool = False, block: int = BLOCK):
        self.about = {"task": task, "file": number, "bits": bits, "block": block}
        self.parts, self.sizes, self.held, self.n_held, self.n = [], [], [], 0, 0
        self.doc_ids, self.doc_lengths = [], []

    def add(self, ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.doc_lengths.append(lengths)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n += len(ids)
        self._flush(self.about["block"])

    def _flush(self, least: int) -> None:
        if self.n_held < least:
            return
        ids, block, pack = np.concatenate(self.held), self.about["block"], zstandard.ZstdCompressor(level=3)
        upto = len(ids) // block * block if least > 1 else len(ids)
        for at in range(0, upto, block):
            packed = [pack.compress(p) for p in to_planes(ids[at:min(at + block, upto)], self.about["bits"])]
            self.parts += packed
            self.sizes += map(len, packed)
        self.held, self.n_held = [ids[upto:]], len(ids) - upto

    def bytes(self) -> bytes:
        self._flush(1)
        about = json.dumps({**self.about, "ids": self.n, "documents": len(self.doc_ids), "planes": len(self.sizes)}).encode()
        null = np.array([i is None for i in self.doc_ids], np.uint8)
        index = zstandard.ZstdCompressor(level=3).compress(b"".join([
            struct.pack("<I", len(about)), about, np.array(self.sizes, "<u4").tobytes(), np.array([i or 0 for i in self.doc_ids], "<i8").tobytes(),
            null.tobytes(), np.concatenate([np.zeros(0, np.int64), *self.doc_lengths]).astype("<u8").tobytes()]))
        return b"".join([*self.parts, index, _FOOT.pack(sum(self.sizes), len(index), MAGIC)])


class IdFile:
    """A file read back: its index at once, its blocks when they are asked for."""

    def __init__(self, data: bytes | memoryview):
        self.data = memoryview(data)
        # The sink ends a row with a line feed.
        end = len(self.data) - (self.data[-1:] == b"\n" and self.data[-9:-1] == MAGIC)
        at, size, magic = _FOOT.unpack(self.data[end - _FOOT.size:end])
        if magic != MAGIC:
            raise ValueError("this is no file of id planes")
        index = zstandard.ZstdDecompressor().decompress(self.data[at:at + size])
        n = struct.unpack_from("<I", index)[0]
        about = json.loads(index[4:4 + n])
        self.task, self.file, self.n, self.block, self.per_block = about["task"], about["file"], about["ids"], about["block"], 32 if about["bits"] else 4
        at, m = 4 + n, about["documents"]
        sizes = np.frombuffer(index, "<u4", about["planes"], at).astype(np.int64)
        self.plane_ends = np.concatenate([[0], np.cumsum(sizes)])
        at += 4 * about["planes"]
        ids, null = np.frombuffer(index, "<i8", m, at), np.frombuffer(index, np.uint8, m, at + 8 * m)
        self.doc_ids = pa.array(ids, pa.int64(), mask=null.astype(bool))
        self.doc_lengths = np.frombuffer(index, "<u8", m, at + 9 * m).astype(np.int64)
        self.doc_starts = np.cumsum(self.doc_lengths) - self.doc_lengths

    def block_ids(self, k: int) -> np.ndarray:
        n, unpack, first = min(self.block, self.n - k * self.block), zstandard.ZstdDecompressor(), k * self.per_block
        spans = zip(self.plane_ends[first:first + self.per_block], self.plane_ends[first + 1:first + 1 + self.per_block])
        return from_planes([unpack.decompress(self.data[a:b]) for a, b in spans], n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids in [start, stop) of the file; only their blocks are decoded."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        found = np.concatenate([self.block_ids(k) for k in range(first, last + 1)])
        return found[start - first * self.block:stop - first * self.block]

    def checksums(self) -> np.ndarray:
        """CRC-32 of each document's ids as little-endian 32-bit numbers, one block in memory at a time."""
        sums, doc, left = np.zeros(len(self.doc_lengths), np.int64), 0, None
        for k in range(-(-self.n // self.block)):
            data, at = memoryview(self.block_ids(k).astype("<u4").tobytes()), 0
            while at < len(data):
                left = 4 * int(self.doc_lengths[doc]) if left is None else left
                part = data[at:at + left]
                sums[doc] = zlib.crc32(part, int(sums[doc]))
                at, left = at + len(part), left - len(part)
                if not left:
                    doc, left = doc + 1, None
        return sums


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends, at = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)), 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, bits: bool = False, text: str = "text", doc_id: str = "doc_id",
                      file_ids: int = FILE_IDS, block: int = BLOCK) -> None:
    """Files of the documents' ids under ``folder``, in ascending order of integer ids."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(text).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, number = _encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        builder = FileBuilder(task, number, bits, block)

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([builder.bytes()], pa.binary())], names=["content"])
        for batch in batches:
            for part in _parts(batch):
                ids, lengths = encoder.stream(part.column(1))
                doc_ids, upto, done, read = part.column(0).to_pylist(), np.cumsum(lengths), 0, 0
                while done < len(doc_ids):
                    # Up to the document that passes the limit.
                    stop = min(int(np.searchsorted(upto, read + file_ids - builder.n)) + 1, len(doc_ids))
                    builder.add(ids[read:upto[stop - 1]], doc_ids[done:stop], lengths[done:stop])
                    done, read = stop, int(upto[stop - 1])
                    if builder.n >= file_ids:
                        yield full()
                        number += 1
                        builder = FileBuilder(task, number, bits, block)
        if builder.n:
            yield full()
    files = rows.mapInArrow(run, "content binary").select(F.col("content").cast("string"))
    files.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(folder)


def _documents(content: memoryview) -> pa.RecordBatch:
    names = ["task", "file", "doc_id", "offset", "n_tokens", "ids_crc32"]
    if len(content) <= _FOOT.size:                           # a task without documents
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 6, names=names)
    f = IdFile(content)
    m = len(f.doc_ids)
    return pa.RecordBatch.from_arrays([pa.array(np.full(m, f.task)), pa.array(np.full(m, f.file)), f.doc_ids, pa.array(f.doc_starts),
                                       pa.array(f.doc_lengths), pa.array(f.checksums())], names=names)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """task, file, doc_id, offset (in the file), n_tokens and ids_crc32 of every document, from the files alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield _documents(memoryview(content.as_buffer()))
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(run, "task long, file long, doc_id long, offset long, n_tokens long, ids_crc32 long")


def tokenised(docs: DataFrame, tokenizer_file: str, bits: bool = False, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the documents' ids, read the files back: doc_id, start (ids before the document), n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = f"{scratch_folder(spark)}/ids-{uuid.uuid4().hex}"
    write_token_files(docs, folder, tokenizer_file, bits, file_ids=file_ids)
    found = written(read_token_files(spark, folder), "read")
    files = found.groupBy("task", "file").agg(F.sum("n_tokens").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))      # noqa: E731
    tasks = files.groupBy("task").agg(F.sum("n").alias("n")).select("task", before(W.orderBy("task")).alias("_task"))
    files = files.select("task", "file", before(W.partitionBy("task").orderBy("file")).alias("_file")).join(F.broadcast(tasks), "task")
    return found.join(files, ["task", "file"]).select("doc_id", (F.col("_task") + F.col("_file") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
