"""Helpers shared by the operators: tables written to the shared folder, Arrow batches, words."""
from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_folder

ASCII_SPACE = r"[\x20\x09-\x0D]+"
#: Everything in ASCII that is no letter and no digit becomes a space.
_NO_WORD = bytes(32 if i < 128 and not re.match(rb"[0-9A-Za-z]", bytes([i])) else i for i in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: A task turns about so much of an Arrow batch into Python objects and results at a time.
PIECE_BYTES = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, and outlives the executors that computed it."""
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def octets(name: str = "text") -> Column:
    """The text's UTF-8, with null as empty."""
    return whole_text(name).cast("binary")


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of the batches, in slices of about ``PIECE_BYTES``, of a row at least."""
    for batch in batches:
        step = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield work(batch)
    return df.mapInArrow(run, schema)


def keep_rows(docs: DataFrame, text: str, decide: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows for which ``decide`` says so, with all their columns, whatever these are called.

    Only texts go to Python.  Rows are filtered where they are: nothing is shuffled or joined.
    """
    @F.arrow_udf("boolean")
    def keep(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        return pa.array(np.concatenate([np.zeros(0, bool), *[decide(p.column(0).to_pylist()) for p in pieces([batch])]]), pa.bool_())
    return docs.where(keep(octets(text)))


#: Bits of a filter: 8 MB.  With more than some ten million keys it lets most rows pass, which costs time, not rows.
FILTER_BITS = 26


def key_filter(keys: DataFrame, name: str, bits: int = FILTER_BITS) -> Callable[[Column], Column]:
    """A Bloom filter of the 64-bit hashes in a column: says of a hash that it may be there, or surely is not.

    Rows that surely are not need no join, so they need not be shuffled.  The filter's size is fixed.
    """
    # Two places from two parts of the hash.
    shifts, mask = (64 - bits, 64 - 2 * bits), (1 << bits) - 1
    places = F.array(*[F.shiftrightunsigned(name, s).bitwiseAND(F.lit(mask).cast("long")) for s in shifts])
    wide = keys.select(F.explode(places).alias("at")).select(F.shiftrightunsigned("at", 6).alias("word"), F.expr("shiftleft(1L, int(at & 63))").alias("bit"))
    found = wide.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()       # at most 2 ** (bits - 6) rows
    words = np.zeros(1 << bits - 6, np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    shared = keys.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def may_be(hashes: pa.Array) -> pa.Array:
        x = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
        out = np.ones(len(x), bool)
        for s in shifts:
            at = (x >> np.uint64(s)) & np.uint64(mask)
            out &= (shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return pa.array(out, pa.bool_())
    return may_be


def plain_words(text: bytes) -> list[bytes]:
    """Runs of letters and digits, lower-cased as Unicode does; punctuation that sticks to a word doesn't matter."""
    return text.decode("utf-8", "replace").lower().encode("utf-8", "replace").translate(_NO_WORD).split()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (multiply and shift)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` successive word hashes; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _MIX + hashes[i:i + n]
    return mixed(out)
