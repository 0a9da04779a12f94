"""SimHash near-duplicate detection with pigeonhole blocks.

``fingerprints`` counts, for each bit, the shingle hashes in which it is set.  ``linked_components`` finds every pair of
fingerprints at ``distance`` or fewer differing bits: of ``distance + 2`` blocks at least two are equal in such a pair, so
fingerprints are joined on each choice of two blocks, and the distance is verified.  Equal fingerprints are one node, so
copies are not expanded.  A busy key (more than ``BUSY`` fingerprints) is split again: its members are joined on choices
of small blocks of the remaining bits, all but ``distance`` of which are equal in a close pair; what such a key leaves
open is a few bits, so no group can exceed ``2 ** (free bits)`` fingerprints, whatever the data.

``without_near_duplicates`` serves the pipeline: shingles of five words, similarity 0.8.  Sets whose fingerprints are close
are found by the blocks above and linked first, once their shared shingles are verified.  At that similarity a seventh of
all bits may differ, too many for blocks of a fingerprint, so an exact check follows for the sets not linked yet: they are
joined on their rarest shingles, of which similar sets share at least one, and verified likewise.  Equal sets are one node,
named by 64 bits.

Defined results: a null text is an empty text; a text without words has fingerprint zero; a null document id is greater
than any other and belongs to its component, whose id is null only if all ids in it are.
"""
from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import key_filter, map_batches, octets, pieces, plain_words, rolled, written

BUSY = 64
SEED = 42


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` ASCII-lower-cased words, one space between them; of all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1:])), np.uint64, len(words) - size + 1)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """For each bit of a row of 64-bit words, the rows in which it is set.  Long texts are counted in pieces."""
    rows = hashes.reshape(len(hashes), -1)
    total = np.zeros(rows.shape[1] * 64, np.int64)
    for at in range(0, len(rows), 255):
        octet = np.ascontiguousarray(rows[at:at + 255]).view(np.uint8)
        total += np.unpackbits(octet, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return total


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """A bit is set if it is set in over half the rows."""
    if not len(hashes):
        return np.zeros(hashes.shape[1] if hashes.ndim > 1 else 1, np.uint64)
    return np.packbits(2 * bit_counts(hashes) > len(hashes), bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and fp (64 bits as a long) of each row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), octets(text).alias("body"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(shingle_hashes(t, words))[0] for t in batch.column(1).to_pylist()]
        fp = pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), fp], names=["doc_id", "fp"])
    return map_batches(rows, work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _choices(bits: range, blocks: int, chosen: int) -> list[int]:
    """Masks of each choice of ``chosen`` of ``blocks`` equal parts of the bits."""
    edges = [bits.start + len(bits) * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in itertools.combinations(parts, chosen)]


def _keyed(df: DataFrame, name: str, masks: Column) -> DataFrame:
    return df.select("*", F.posexplode(masks).alias(f"{name}_no", "mask")).withColumn(
        name, F.col("fp").bitwiseAND(F.col("mask")))


def _join(keyed: DataFrame, on: list[str], distance: int) -> DataFrame:
    a, b = keyed.select(*on, F.col("fp").alias("a")), keyed.select(*on, F.col("fp").alias("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return a.join(b, on).where(near).select("a", "b")


def close_pairs(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Every pair (a, b), a below b, of the different values in ``fps.fp`` with at most ``distance`` differing bits."""
    blocks = distance + 2
    masks = _choices(range(64), blocks, 2)
    keyed = _keyed(fps.select("fp"), "key", F.array(*[F.lit(_signed(m)).cast("long") for m in masks]))
    busy = keyed.groupBy("key_no", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = written(keyed.join(busy, ["key_no", "key"]).select("key_no", "key", "n", "fp"), "keys")
    on = ["key_no", "key"]
    pairs = _join(keyed.where(F.col("n") <= BUSY), on, distance)
    # The bits a key leaves open, in small blocks of which all but ``distance`` are equal in a close pair.
    fine = []
    for m in masks:
        free = [i for i in range(64) if not m >> i & 1]
        small = distance + 6
        parts = [sum(1 << i for i in free[len(free) * k // small:len(free) * (k + 1) // small]) for k in range(small)]
        fine.append(F.array(*[F.lit(_signed(sum(c))).cast("long") for c in itertools.combinations(parts, 6)]))
    hot = keyed.where(F.col("n") > BUSY)
    hot = _keyed(hot, "sub", F.element_at(F.array(*fine), F.col("key_no") + 1)).drop("mask")
    return pairs.unionByName(_join(hot, [*on, "sub_no", "sub"], distance)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that can be reached) of each node in the edges (a, b).

    Large-star and small-star steps in turn until nothing changes; each step is written to the shared folder.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def star(edges: DataFrame, large: bool) -> DataFrame:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = near.join(least, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        return (moved if large else moved.unionByName(own)).where("u <> v").distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state(edges)
    while True:
        edges = written(star(written(star(edges, True), "large"), False), "small")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def linked_components(docs: DataFrame, words: int = 3, distance: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that can be reached) of each row."""
    rows = written(fingerprints(docs, words, text, doc_id), "fingerprints")
    values = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "values")
    roots = components(close_pairs(values, distance))
    linked = values.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = linked.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


# ---------------------------------------------------------------- five words, similarity 0.8
COUNT_BITS = 22             #: cells in which shingles are counted (16 MB); they order the shingles and decide nothing
COUNT_BLOCKS = 64           #: parts of the cells, summed by a task each
DISTANCE = 2                #: differing bits of fingerprints that are compared first
SALTS = 16                  #: tasks among which the rows of one group are dealt
SLACK = 1e-6                #: for the rounding of products; the last check of a pair has none


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The different shingles of a text, as sorted 64-bit hashes; of all words if they are fewer."""
    words = plain_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.unique(rolled(h, min(size, len(h))))


def _set_name(own: np.ndarray) -> int | None:
    """64 bits that name a set of shingles; None if it is empty."""
    return _signed(xxhash.xxh3_64_intdigest(own.tobytes())) if len(own) else None


def _packed(counts: np.ndarray) -> bytes:
    """Counts are small, so all but the lowest bytes compress to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _count_batch(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int32()), pa.array([_packed(c) for c in blocks.values()], pa.binary())], names=["block", "counts"])


def _cell_counts(rows: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all rows fall in each cell (the upper bits of the hash), 2 ** 32 - 1 at most.

    A task sends its counts as a few compressed blocks, which are summed block by block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.uint32)

        def add(held: list[np.ndarray]) -> None:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            total[at.astype(np.int64)] += n.astype(np.uint32)
        for batch in pieces(batches):
            held, n = [np.empty(0, np.uint64)], 0
            for text in batch.column(1).to_pylist():
                held.append(shingle_set(text, words) >> np.uint64(64 - COUNT_BITS))
                n += len(held[-1])
                if n > 1_000_000:
                    add(held)
                    held, n = [np.empty(0, np.uint64)], 0
            add(held)
        yield _count_batch(dict(enumerate(np.split(total, COUNT_BLOCKS))))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = _unpacked(counts).astype(np.uint64)
                blocks[block] = blocks[block] + found if block in blocks else found
        yield _count_batch({k: np.minimum(c, (1 << 32) - 1) for k, c in blocks.items()})
    parts = rows.mapInArrow(run, "block int, counts binary").repartition(COUNT_BLOCKS, "block").mapInArrow(summed, "block int, counts binary")
    out = np.zeros((COUNT_BLOCKS, (1 << COUNT_BITS) // COUNT_BLOCKS), np.uint32)
    for row in parts.collect():                     # COUNT_BLOCKS rows of fixed size
        out[row["block"]] = _unpacked(bytes(row["counts"]))
    return out.reshape(-1)


def _parity(own: np.ndarray) -> bytes:
    """A bit per cell of the set, about as many cells as shingles: whether an odd number of shingles lies in it."""
    cells = 1 << max(6, (len(own) - 1).bit_length())
    return np.packbits(np.bincount((own & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1, bitorder="little").tobytes()


def _differing(a: bytes, b: bytes) -> int:
    """Sets with these parities differ in at least so many shingles.  The longer one is folded to the length of the other."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _prefixes(rows: DataFrame, words: int, least: float) -> DataFrame:
    """For each row: the name of its set (node), the set's size n, a score, its rarest shingles (prefix), parity and fingerprint.

    All sets are in one order: by the count of the shingle's cell, then by hash.  Two sets of similarity ``least`` have
    a shingle in common among the first ``n - ceil(least n) + 1`` of each.  The score is higher the more common the
    shingles are, so in a group of copies it is highest in the middle.  A set that the task has had before has none of prefix, parity and
    fingerprint.
    """
    counts = rows.sparkSession.sparkContext.broadcast(_cell_counts(rows, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches):
            node, n, score, prefix, parity, fp = [], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, words)
                name, size = _set_name(own), len(own)
                first = name is not None and name not in seen
                node.append(name)
                n.append(size)
                common = counts.value[own >> np.uint64(64 - COUNT_BITS)] if first else None
                score.append(float(common.mean()) if first else None)
                parity.append(_parity(own) if first else None)
                fp.append(_signed(int(fingerprint(own)[0])) if first else None)
                if first:
                    seen.add(name)
                    length = size - math.ceil(least * size - SLACK) + 1
                    prefix.append(own[np.argsort(common, kind="stable")[:length]].view(np.int64))
                else:
                    prefix.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, pa.int64()), pa.array(n, pa.int32()), pa.array(score, pa.float32()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(parity, pa.binary()), pa.array(fp, pa.int64())],
                names=["key", "node", "n", "score", "prefix", "parity", "fp"])
    return rows.mapInArrow(run, "key string, node long, n int, score float, prefix array<long>, parity binary, fp long")


def _close_sets(prefixes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs of sets with at most ``distance`` differing bits in their fingerprints, as the blocks find them.

    A fingerprint is stood for by the smallest of its sets: the others are paired with that one, and those of close
    fingerprints with each other, so copies are not expanded.
    """
    sets = prefixes.where("fp is not null").select("node", "fp").distinct()
    values = written(sets.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")), "values")
    # A fingerprint's first set meets the others in several tasks.
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int").alias("salt")
    several = values.where("n > 1").select("fp", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    same = sets.select("node", "fp", salt).join(several, ["fp", "salt"]).select(F.col("node").alias("x"), F.col("first").alias("y"))
    a, b = (values.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")) for c in "ab")
    near = close_pairs(values, distance).join(a, "a").join(b, "b").select(F.col("first_a").alias("x"), F.col("first_b").alias("y"))
    return same.unionByName(near).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _not_linked(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose sets have different roots."""
    for c in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left") \
            .withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    return pairs.where("root_a <> root_b").select("a", "b")


def _may_be_alike(least: float, n_a, p_a, n_b, p_b, low=np.minimum, high=np.maximum):
    """Whether sets of these sizes can be alike whose first common shingle is at these places."""
    return (low(n_a, n_b) >= least * high(n_a, n_b) - SLACK) & (low(n_a - p_a, n_b - p_b) >= least / (1 + least) * (n_a + n_b) - SLACK)


def _shared_shingles(prefixes: DataFrame) -> DataFrame:
    """token, node, n and p (place) of the prefix shingles that different sets share, each with the set of highest score (pivot)."""
    each = prefixes.where("prefix is not null").select("node", "n", "score", F.posexplode("prefix").alias("p", "token"))
    of_token = W.partitionBy("token")
    each = each.select("*", F.max(F.struct("score", "node", "n", "p")).over(of_token).alias("pivot"),
                       F.min("node").over(of_token).alias("low"), F.max("node").over(of_token).alias("high"))
    return each.where("low <> high").select("token", "node", "n", "p", F.col("pivot.node").alias("pivot"),
                                            F.col("pivot.n").alias("pivot_n"), F.col("pivot.p").alias("pivot_p"))


def _pairs_of_roots(cells: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Every pair of sets that share a prefix shingle, may be alike and have different roots."""
    cells = cells.select("token", "node", "n", "p").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_token = W.partitionBy("token")
    cells = cells.select("*", F.min("root").over(of_token).alias("low"), F.max("root").over(of_token).alias("high")).where("low <> high")
    cells = cells.select("token", "root", "node", "n", "p").repartition("token").sortWithinPartitions("token", "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = root = None
        held, size, before = np.empty((3, 64), np.int64), 0, 0      # node, n and p; ``before`` are of the roots before
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            out, made = [], 0
            for t, r, node, n, p in zip(*[c.tolist() for c in cols]):
                if t != token:
                    token, root, size, before = t, r, 0, 0
                elif r != root:
                    root, before = r, size
                if before:
                    others = held[:, :before]
                    found = others[0, _may_be_alike(least, others[1], others[2], n, p)]
                    out.append(np.stack([np.minimum(found, node), np.maximum(found, node)]))
                    made += len(found)
                    if made > 100_000:
                        yield _pair_batch(out)
                        out, made = [], 0
                if size == held.shape[1]:
                    held = np.concatenate([held, np.empty_like(held)], axis=1)
                held[:, size] = node, n, p
                size += 1
            yield _pair_batch(out)
    return cells.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def _pair_batch(parts: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate([np.empty((2, 0), np.int64), *parts], axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], names=["a", "b"])


def _close(pairs: DataFrame, prefixes: DataFrame, least: float) -> DataFrame:
    """The pairs whose parities leave the similarity possible.  No pair that has it is lost: parities differ only where sets do."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = prefixes.where("parity is not null").select("node", "n", "parity").join(nodes, "node", "left_semi") \
        .groupBy("node").agg(F.max("n").alias("n"), F.max("parity").alias("parity"))
    known = written(known, "parities")
    a, b = (known.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"parity_{x}")) for x in "ab")
    share = (1 - least) / (1 + least)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_a, n_b, p_a, p_b = (batch.column(i).to_pylist() for i in range(2, 6))
        keep = [_differing(x, y) <= share * (m + n) + SLACK for m, n, x, y in zip(n_a, n_b, p_a, p_b)]
        return pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)], names=["a", "b"])
    met = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "parity_a", "parity_b")
    return written(map_batches(met, work, "a long, b long"), "close")


def _alike(pairs: DataFrame, rows: DataFrame, prefixes: DataFrame, words: int, least: float) -> DataFrame:
    """The pairs whose sets have the similarity; the sets are made again for those only that their parities don't rule out."""
    pairs = _close(pairs, prefixes, least)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = prefixes.select("key", "node").join(nodes, "node").groupBy("node").agg(F.min("key").alias("key"))
    wanted = written(wanted.withColumn("h", F.xxhash64("key")), "wanted")
    sets = rows.where(key_filter(wanted, "h")(F.xxhash64("key"))).join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array([_set_name(s) for s in own], pa.int64()), pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64()))],
                                          names=["node", "own"])
    sets = written(map_batches(sets, hashed, "node long, own array<long>"), "sets")
    a, b = (sets.select(F.col("node").alias(x), F.col("own").alias(f"own_{x}")) for x in "ab")
    shared = F.size(F.array_intersect("own_a", "own_b"))
    alike = shared >= least * (F.size("own_a") + F.size("own_b") - shared)
    return written(pairs.join(a, "a").join(b, "b").where(alike).select("a", "b"), "alike")


def without_near_duplicates(docs: DataFrame, words: int = 5, least: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows but those that are near copies of others; of each group the row with the smallest id stays.

    A row is known by its id and a hash of its text, so rows that agree in both stay or go together.
    """
    key = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.hex(F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
    rows = docs.select(key.alias("key"), octets(text).alias("body"))
    prefixes = written(_prefixes(rows, words, least), "prefixes")
    cells = written(_shared_shingles(prefixes), "cells")
    # First the sets of close fingerprints.
    close = written(_close_sets(prefixes), "close_sets")
    edges = _alike(close, rows, prefixes, words, least)
    roots = written(components(edges), "roots")
    # Then each set with the pivots of its shingles, which links most of a group; then all pairs not yet linked.
    to_pivot = _may_be_alike(least, *(F.col(c) for c in ("n", "p", "pivot_n", "pivot_p")), F.least, F.greatest)
    pivots = cells.where((F.col("node") != F.col("pivot")) & to_pivot).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    pivots = written(_not_linked(pivots.distinct(), roots).join(close, ["a", "b"], "left_anti"), "tried")
    edges = edges.unionByName(_alike(pivots, rows, prefixes, words, least))
    tried = close.unionByName(pivots)
    roots = written(components(edges), "roots")
    others = written(_pairs_of_roots(cells, roots, least).join(tried, ["a", "b"], "left_anti"), "others")
    if not others.isEmpty():
        edges = edges.unionByName(_alike(others, rows, prefixes, words, least))
        roots = written(components(edges), "roots")
    # Rows of one set are one node.
    named = prefixes.where("node is not null").select("key", "node").distinct()
    named = named.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    number = F.substring_index("key", ":", 1).try_cast("decimal(38,9)")
    first = named.groupBy("root").agg(F.min_by("key", F.struct(number.isNull(), number, F.col("key"))).alias("stays"), F.count("*").alias("n")).where("n > 1")
    # Each group's row meets its own rows in several tasks.
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt")
    first = first.select("root", "stays", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    goes = named.select("key", "root", salt).join(first, ["root", "salt"]).where("key <> stays").select(F.col("key").alias("node"), F.xxhash64("key").alias("h"))
    goes = written(goes, "goes")
    packed = docs.select(key.alias("key"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    may_go = key_filter(goes, "h")(F.xxhash64("key"))
    # Rows that may go are joined; the others stay where they are.
    kept = packed.where(may_go).join(goes, F.col("key") == F.col("node"), "left_anti")
    return packed.where(~may_go).unionByName(kept.select("key", "row")).select("row.*")
