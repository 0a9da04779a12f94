"""CSV records of large files, read by many tasks although quoted values may hold line breaks.

A line of the text source is a record of its own unless a quote is open when it begins or ends.  What a line does to that
state depends on the line alone: it may keep it, turn it over, or set it.  So each byte range (block) first tells what its
lines do to the state together; these are put in sequence over the blocks of a file, one row per block; and then each block
knows its first true record start and cuts its lines into records.  Only the pieces of records that lie in several blocks
meet in a shuffle.

The records are those of Spark's own reader with ``multiLine``: a quote counts where a field begins, doubled quotes are
characters, a file's first record is its header, and empty lines are no records.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import stored

_FIELD = r'(?:"(?:[^"]|"")*"[^,"]*|[^",][^,]*|)'
#: A line that begins outside of quotes ends there, or one that begins inside of them ends outside.
_STAYS_OUT, _GETS_OUT = rf"^{_FIELD}(?:,{_FIELD})*$", rf'^(?:[^"]|"")*"[^,"]*(?:,{_FIELD})*$'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _effects(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether a quote is open behind each line, if none was before it, and if one was."""
    quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
    closed, opened = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    some = lines.filter(pa.array(quoted))
    closed[quoted] = ~pc.match_substring_regex(some, _STAYS_OUT).to_numpy(zero_copy_only=False)
    opened[quoted] = ~pc.match_substring_regex(some, _GETS_OUT).to_numpy(zero_copy_only=False)
    return closed, opened


def _behind(closed: np.ndarray, opened: np.ndarray, start: bool) -> np.ndarray:
    """The state behind each line: what the last line that sets it says, turned over by the lines since."""
    sets, turned = closed == opened, np.cumsum(closed & ~opened)
    last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), -1))
    known = last >= 0
    base, since = np.where(known, closed[last], start), turned - np.where(known, turned[last], 0)
    return base ^ (since % 2 == 1)


def _runs(batch: pa.RecordBatch, by: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of one block each; a task reads its blocks one after the other."""
    keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in by]
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(change)
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield tuple(k[a] for k in keys), batch.slice(int(a), int(b - a))


#: Pieces of records that lie in several blocks: the end, a block in the midst, the beginning.
_END, _MIDST, _BEGINNING = range(3)


class _Cutter:
    """Cuts the lines of one block into records, and the pieces of records that go on in other blocks."""

    def __init__(self, block: int, inside: bool):
        self.inside = self.from_ahead = inside      # the lines held began in a block ahead
        self.first = block == 0                     # the next record is the file's first, its header
        self.held: list[str] = []
        self.records: list[str] = []
        self.pieces: list[dict] = []

    def add(self, lines: pa.Array, effects: tuple[np.ndarray, np.ndarray]) -> pa.Array:
        """Takes lines; returns those that are records of their own."""
        behind = _behind(*effects, self.inside)
        before = np.concatenate([[self.inside], behind[:-1]])
        own = ~before & ~behind
        if self.first and own[0]:
            own[0] = self.first = False
            rest = np.flatnonzero(~own)[1:]
        else:
            rest = np.flatnonzero(~own)
        for i in rest:
            self.held.append(lines[int(i)].as_py())
            if not behind[i]:
                self._complete()
        self.inside = bool(behind[-1])
        return lines.filter(pa.array(own))

    def _complete(self) -> None:
        if self.from_ahead:
            self._piece(_END)
        elif self.first:
            self.first = False
        else:
            self.records.append("\n".join(self.held))
        self.held, self.from_ahead = [], False

    def _piece(self, kind: int) -> None:
        self.pieces.append({"kind": kind, "first": self.first and not self.from_ahead, "record": "\n".join(self.held)})

    def close(self) -> list[dict]:
        if self.held:
            self._piece(_MIDST if self.from_ahead else _BEGINNING)
        return self.pieces


_BLOCKS = "file string, block long, start boolean, end boolean"


def _block_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, for either state it may begin with: the state it ends with.  No text is held, whatever the state means."""
    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * 2, pa.string()), pa.array([int(at[1])] * 2, pa.int64()), pa.array([False, True]), pa.array(ends)],
                                          names=["file", "block", "start", "end"])
    ends, at = [], None
    for batch in batches:
        for key, part in _runs(batch, ("file", "block")):
            if key != at:
                if ends:
                    yield rows()
                ends, at = [False, True], key
            effects = _effects(part.column("value"))
            ends = [bool(_behind(*effects, state)[-1]) for state in ends]
    if ends:
        yield rows()


def _states(blocks: DataFrame) -> DataFrame:
    """file, block and whether a quote is open where the block's first line begins."""
    ends = blocks.groupBy("file", "block").agg(F.bool_or(F.col("end") & ~F.col("start")).alias("closed"), F.bool_or(F.col("end") & F.col("start")).alias("opened"))
    line = Window.partitionBy("file").orderBy("block")           # one row per block
    ahead = line.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("closed") & ~F.col("opened")).cast("int")
    ends = ends.withColumn("turned", F.sum(turns).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.max(F.when(F.col("closed") == F.col("opened"), F.struct("block", "closed", "turned"))).over(ahead)
    ends = ends.withColumns({"last": last, "before": F.coalesce(F.max("turned").over(ahead), F.lit(0))})
    since = (F.col("before") - F.coalesce("last.turned", F.lit(0))) % 2 == 1
    return ends.select("file", "block", (F.coalesce("last.closed", F.lit(False)) != since).alias("inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter, at = None, None
    for batch in batches:
        for key, part in _runs(batch, ("file", "block")):
            if key != at:
                inside = part.column("inside")[0].as_py()
                if inside is None:
                    raise RuntimeError("the file was split in another way than before; read it again")
                cutter, at = _Cutter(key[1], inside), key
            own = cutter.add(part.column("value"), _effects(part.column("value")))
            yield pa.RecordBatch.from_arrays([own], names=["record"])
            yield pa.RecordBatch.from_arrays([pa.array(cutter.records, pa.string())], names=["record"])
            cutter.records = []


_PIECES = "file string, block long, kind int, first boolean, record string"


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of records at the edges of blocks whose first state is known; the records inside are left to ``_cut``."""
    def rows() -> pa.RecordBatch:
        pieces = cutter.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]] * len(pieces), pa.string()), pa.array([int(at[1])] * len(pieces), pa.int64()), pa.array([p["kind"] for p in pieces], pa.int32()),
             pa.array([p["first"] for p in pieces], pa.bool_()), pa.array([p["record"] for p in pieces], pa.string())], names=["file", "block", "kind", "first", "record"])
    cutter, at = None, None
    for batch in batches:
        for key, part in _runs(batch, ("file", "block")):
            if key != at:
                if cutter:
                    yield rows()
                cutter, at = _Cutter(key[1], part.column("inside")[0].as_py()), key
            cutter.add(part.column("value"), _effects(part.column("value")))
            cutter.records = []
    if cutter:
        yield rows()


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as text (column ``record``), without the files' headers; as many tasks as byte ranges.

    The files are read twice: at once to learn how blocks begin, and when the records are asked for; where records lie in
    several blocks, once more for their pieces.  Blocks are known by where Spark splits the files; should that change in
    between, the second pass fails, it never gives wrong records.
    """
    lines = _lines(spark, path)
    blocks = stored(lines.mapInArrow(_block_effects, _BLOCKS), "blocks")
    # A row per block of input: some 100 bytes for each 128 MB.
    states = F.broadcast(_states(blocks))
    whole = lines.join(states, ["file", "block"], "left").select("value", "file", "block", "inside").mapInArrow(_cut, "record string")
    known = blocks.join(states, ["file", "block"]).where("start = inside")
    shared = known.where("inside OR end").select("file", "block", "inside")
    if shared.isEmpty():
        return _plain(whole)
    parts = lines.join(F.broadcast(shared), ["file", "block"]).select("value", "file", "block", "inside").mapInArrow(_edges, _PIECES)
    # In a file, a beginning is followed by the pieces up to the next beginning; a block has two pieces at most.
    number = F.sum((F.col("kind") == _BEGINNING).cast("int")).over(
        Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = parts.withColumn("n", number).groupBy("file", "n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))), lambda p: p["record"]), "\n").alias("record"),
        F.bool_or("first").alias("first")).where("NOT first").select("record")
    return _plain(whole.unionByName(joined))


def _plain(records: DataFrame) -> DataFrame:
    return records.select(F.regexp_replace("record", r"\r$", "").alias("record")).where("record <> ''")


def read_split_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The files' columns as text, in the order of their header."""
    names = ", ".join(f"c{i} string" for i in range(len(columns)))
    row = F.from_csv("record", F.lit(names), {"escape": '"', "maxCharsPerColumn": "-1"})
    return split_records(spark, path).select(row.alias("row")).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)])
